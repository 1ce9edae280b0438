"""Connected components of a distributed edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common

#: At most so many nodes are broadcast at a time, and only nodes with more edges than LIGHT. So few edges (FEW) are one task's work anyway.
HUBS, LIGHT, FEW = 10_000, 1_000, 20_000


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """The edges (a, b) with m, the smallest b of each a.

    A node that holds a large share of all edges (the centre of a group of copies) never meets them in one task: the smallest b comes from
    partial minima, and nodes of more than total / HUBS edges get it from a broadcast table, which so has fewer than HUBS rows.
    """
    if total <= FEW:
        return edges.join(edges.groupBy("a").agg(F.min("b").alias("m")), "a")
    least = common.written(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("b").alias("d")), "least")
    hubs = least.where(F.col("d") > max(LIGHT, total // HUBS)).select("a", F.col("m").alias("hub"))
    split = edges.join(F.broadcast(hubs), "a", "left")
    light = split.where("hub is null").select("a", "b").join(least.select("a", "m").hint("merge"), "a").select("a", "b", "m")
    return light.unionByName(split.where("hub is not null").select("a", "b", F.col("hub").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of each node of the edges (a, b), of any type with an order; comp is the component's smallest node.

    Each step only sums up or joins by node, keeps at most as many edges as there were, and is written to the shared folder.
    """
    def sealed(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        out = common.written(df.distinct().observe(seen, F.count("a").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), "edges")
        return out, (seen.get["n"], seen.get["x"])

    spent: list = []
    now, mark = sealed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while mark[0]:
        with common.recorded(spent):
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            large = _with_least(both, 2 * mark[0]).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            large = large.distinct() if mark[0] <= FEW else common.written(large.distinct(), "large")
            small = _with_least(large, mark[0]).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            small = small.select("e.a", "e.b").where("a <> b")
        old, (now, after) = now, sealed(small)
        common.forget(old)
        common.drop(spent)
        if after == mark:
            break
        mark = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
