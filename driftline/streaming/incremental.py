"""Keeping tables current along a numbered stream of diffs: plans, apply-once folds, state and its compaction."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.sources import fs

SPAN_S = 3_600
COMPACT = 10


def sequence_range(applied: int, current: int, most: int | None = None) -> range:
    """Sequences to apply: from the one after ``applied`` to ``current``, at most so many."""
    last = current if most is None else min(current, applied + most)
    return range(applied + 1, last + 1)


def batches(spans: Iterable[tuple[int, int, int]], span: int = SPAN_S) -> list[list[int]]:
    """(sequence, least ts, largest ts) in order to batches: one is closed by the diff that makes it reach ``span`` seconds."""
    out: list[list[int]] = []
    open_, lo, hi = [], None, None
    for seq, a, b in spans:
        open_.append(seq)
        lo, hi = a if lo is None else min(lo, a), b if hi is None else max(hi, b)
        if hi - lo >= span:
            out.append(open_)
            open_, lo, hi = [], None, None
    return [*out, open_] if open_ else out


def batch_plan(changes: DataFrame, span: int = SPAN_S) -> DataFrame:
    """seq, batch (from 0), lo, hi of the diffs in ``changes`` (seq, secs). The fold depends on order: it runs over one small row a diff."""
    per = changes.groupBy("seq").agg(F.min("secs").alias("lo"), F.max("secs").alias("hi")).orderBy("seq")
    rows = [tuple(r) for r in per.collect()]
    batch_of = {s: i for i, b in enumerate(batches(rows, span)) for s in b}
    return changes.sparkSession.createDataFrame([(s, batch_of[s], a, b) for s, a, b in rows], "seq long, batch int, lo long, hi long")


def consecutive(fetched: Iterable[int], first: int) -> list[int]:
    """The unbroken run of sequences from ``first``: what can be committed if a later one failed."""
    have, out = set(fetched), []
    while first in have:
        out.append(first)
        first += 1
    return out


def fold(base: DataFrame, staged: DataFrame, stamp: int, keys: list[str], n: str = "n", applied: int | None = None) -> DataFrame:
    """``base`` and the staged rows (with ``seq``) after ``stamp`` and up to ``applied``, added up by key: staging that was applied already changes nothing."""
    new = staged.where(F.col("seq") > stamp)
    if applied is not None:
        new = new.where(F.col("seq") <= applied)
    return base.select(*keys, n).unionByName(new.select(*keys, n)).groupBy(*keys).agg(F.sum(n).alias(n))


def touched_years(staged: DataFrame, stamp: int) -> DataFrame:
    return staged.where(F.col("seq") > stamp).select("year").distinct()


def merge_years(base: DataFrame, staged: DataFrame, stamp: int, applied: int) -> DataFrame:
    """year, cell, day, count of the years that staging touches; other years need no rewrite."""
    new = staged.where((F.col("seq") > stamp) & (F.col("seq") <= applied))
    old = base.join(F.broadcast(new.select("year").distinct()), "year", "left_semi")  # as many rows as there are years
    cols = ["year", "cell", "day", "count"]
    return old.select(*cols).unionByName(new.select(*cols)).groupBy("year", "cell", "day").agg(F.sum("count").alias("count"))


def rewrite_years(rows: DataFrame, path: str) -> None:
    """Replaces the partitions that ``rows`` has and leaves the others alone. Not safe against a stop in between: runs write new folders instead (plans/runner)."""
    rows.repartitionByRange("year", "cell", "day").sortWithinPartitions("year", "cell", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year").parquet(path)


def next_state(state: DataFrame, deleted: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overlay (node, cell) and tombstones (node) after a batch of changes (node, ord, visible, cell): the last change of a node counts."""
    last = changes.groupBy("node").agg(F.max_by(F.struct("visible", "cell"), "ord").alias("_l")).select("node", "_l.visible", "_l.cell")
    put, gone = last.where(F.col("visible") & F.col("cell").isNotNull()).select("node", "cell"), last.where(~F.col("visible")).select("node")
    moved = last.where(~F.col("visible") | F.col("cell").isNotNull()).select("node")
    return state.join(moved, "node", "left_anti").select("node", "cell").unionByName(put), deleted.join(put.select("node"), "node", "left_anti").select("node").unionByName(gone).distinct()


def compaction_due(base: int, overlay: int, deleted: int, ratio: int = COMPACT) -> bool:
    return overlay + deleted >= max(1, base // ratio)


class Ledger:
    """Which sequence each dataset and partition has applied: a small JSON file, replaced in one step for all entries of a run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.entries: dict[str, int] = json.loads(fs.read_text(spark, path)) if fs.exists(spark, path) else {}

    def applied(self, dataset: str, partition: str = "") -> int:
        return self.entries.get(f"{dataset}/{partition}", 0)

    def known(self, dataset: str, partition: str = "") -> bool:
        return f"{dataset}/{partition}" in self.entries

    def partitions(self, dataset: str) -> dict[str, int]:
        """Partition to applied sequence of a dataset that is kept by partition."""
        return {k.removeprefix(f"{dataset}/"): v for k, v in self.entries.items() if k.startswith(f"{dataset}/") and k != f"{dataset}/"}

    def commit(self, dataset: str, seq: int, partition: str = "") -> None:
        self.move({f"{dataset}/{partition}": seq})

    def move(self, moves: dict[str, int]) -> None:
        """Moves entries (``dataset/partition``), all or none."""
        for k, seq in moves.items():
            if seq < self.entries.get(k, 0):
                raise ValueError(f"a ledger does not go back: {k}")
        new = self.entries | moves
        fs.replace(self.spark, self.path, json.dumps(new, sort_keys=True))
        self.entries = new


class Lock:
    """One writer at a time: a file that only one run can create, removed when it ends. A run that breaks off leaves it; it is taken over after ``stale_s``."""

    def __init__(self, spark: SparkSession, path: str, stale_s: float = 24 * 3_600):
        self.spark, self.path, self.stale_s = spark, path, stale_s

    def __enter__(self):
        owner = f"{self.spark.sparkContext.applicationId} {uuid.uuid4().hex}"
        if not fs.create_new(self.spark, self.path, owner):
            if fs.age_s(self.spark, self.path) < self.stale_s:
                raise RuntimeError(f"another run holds {self.path}")
            fs.replace(self.spark, self.path, owner)
        return self

    def __exit__(self, *_):
        fs.delete(self.spark, self.path)


def run_stream(spark: SparkSession, source: str, schema, checkpoint: str, apply: Callable[[DataFrame, int], None], files: int | None = None) -> None:
    """Feeds new Parquet diffs of a folder to ``apply(batch, batch_id)``, at most ``files`` at once, until none is left."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    query = reader.parquet(source).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
