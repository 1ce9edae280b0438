"""The change cube (cell, day) -> count, and the positions it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions import time

AS_OF_DAYS = 365


def positions(nodes: DataFrame) -> DataFrame:
    """node, day, cell: the last version of a day wins. nodes: id, version, day, cell (null: no coordinates)."""
    return nodes.where("cell is not null").groupBy(F.col("id").alias("node"), "day").agg(F.max_by("cell", "version").alias("cell"))


def last_positions(history: DataFrame) -> DataFrame:
    """node, cell: the latest day's."""
    return history.groupBy("node").agg(F.max_by("cell", "day").alias("cell"))


def node_events(nodes: DataFrame) -> DataFrame:
    """cell, day of each node version that counts: at its coordinates; a deletion without them at the last known cell."""
    before = F.last("cell", ignorenulls=True).over(Window.partitionBy("id").orderBy("version").rowsBetween(Window.unboundedPreceding, -1))
    return nodes.withColumn("cell", F.coalesce("cell", F.when(~F.col("visible"), before))).where("cell is not null").select("cell", "day")


def as_of(left: DataFrame, right: DataFrame, key: str, when: str, value: str, bucket: int = AS_OF_DAYS) -> DataFrame:
    """Inner as-of join, backward and inclusive: ``left`` with ``value`` of the last ``right`` row of the key not after ``when``.

    Linear, whatever a key's share: both sides lie in one table in order of time, where a running last value passes from right rows to left
    ones. A key is dealt by buckets of time, and each bucket that has left rows starts with the last value of the buckets before it.
    """
    at = F.floor(F.col(when) / bucket).cast("long").alias("_b")
    of = right.schema[value].dataType
    mine = left.where(F.col(key).isNotNull() & F.col(when).isNotNull())
    rows = mine.select(F.col(key).alias("_k"), at, F.col(when).cast("long").alias("_w"), F.lit(2).alias("_o"), F.lit(None).cast(of).alias("_v"), F.struct(*left.columns).alias("_row"))
    empty = F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")
    given = right.where(F.col(key).isNotNull() & F.col(when).isNotNull() & F.col(value).isNotNull())
    values = given.select(F.col(key).alias("_k"), at, F.col(when).cast("long").alias("_w"), F.lit(1).alias("_o"), F.col(value).alias("_v"), empty)
    ends = given.groupBy(F.col(key).alias("_k"), at).agg(F.max_by(value, when).alias("_e"))
    asked = mine.select(F.col(key).alias("_k"), at).distinct().select("_k", "_b", F.lit(None).cast(of).alias("_e"))
    before = Window.partitionBy("_k").orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    carried = ends.unionByName(asked).groupBy("_k", "_b").agg(F.max("_e").alias("_e")).withColumn("_v", F.last("_e", ignorenulls=True).over(before)).where("_v is not null")
    carried = carried.select("_k", "_b", (F.col("_b") * bucket).alias("_w"), F.lit(0).alias("_o"), "_v", empty)
    so_far = Window.partitionBy("_k", "_b").orderBy("_w", "_o").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(values).unionByName(carried).withColumn("_v", F.last("_v", ignorenulls=True).over(so_far))
    return found.where("_o = 2 and _v is not null").select("_row.*", F.col("_v").alias(value))


def way_events(ways: DataFrame, history: DataFrame) -> DataFrame:
    """cell, day: each distinct cell once a way version. A deletion counts at the cells of the latest visible version, taken at that
    version's day, on the deletion's day. ways: id, version, visible, day, refs. Refs without position are dropped."""
    seen = Window.partitionBy("id").orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    shape = F.when(F.col("visible"), F.struct("version", "day", "refs"))
    use = ways.where(~F.col("visible") | (F.size("refs") > 0)).withColumn("shape", F.last(shape, ignorenulls=True).over(seen)).where("shape is not null")
    refs = use.select("id", "version", F.col("day").alias("on"), F.col("shape.day").alias("day"), F.explode(F.array_distinct("shape.refs")).alias("node"))
    return as_of(refs, history, "node", "day", "cell").select("id", "version", "on", "cell").distinct().select("cell", F.col("on").alias("day"))


def counted(events: DataFrame) -> DataFrame:
    """cell, day, count."""
    return events.groupBy("cell", "day").agg(F.count(F.lit(1)).alias("count"))


def merged(*parts: DataFrame) -> DataFrame:
    """Counts of several cubes added up."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("cell", "day").agg(F.sum("count").alias("count"))


def by_year(cube: DataFrame) -> DataFrame:
    return cube.withColumn("year", time.year_of_day("day"))


def spatial_centre(cube: DataFrame, centres: DataFrame) -> DataFrame:
    """lat, lon: mean of the cells' centres (cell, lat, lon), weighted by count."""
    cells = cube.groupBy("cell").agg(F.sum("count").alias("count")).join(centres, "cell")
    total = F.sum("count")
    return cells.agg((F.sum(F.col("lat") * F.col("count")) / total).alias("lat"), (F.sum(F.col("lon") * F.col("count")) / total).alias("lon"))


def date_range(cube: DataFrame) -> DataFrame:
    return cube.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def post_positions(ids: DataFrame, base: DataFrame, overlay: DataFrame, deleted: DataFrame) -> DataFrame:
    """node, cell after a batch: overlay, else none if deleted, else base."""
    got = ids.join(overlay.select("node", F.col("cell").alias("_o")), "node", "left").join(deleted.select("node", F.lit(True).alias("_d")), "node", "left").join(base.select("node", F.col("cell").alias("_b")), "node", "left")
    return got.select(*ids.columns, F.when(F.col("_o").isNotNull(), F.col("_o")).when(F.col("_d"), None).otherwise(F.col("_b")).alias("cell"))


def pre_positions(ids: DataFrame, base: DataFrame, overlay: DataFrame) -> DataFrame:
    """node, cell before a batch: overlay, else base; tombstones are ignored."""
    got = ids.join(overlay.select("node", F.col("cell").alias("_o")), "node", "left").join(base.select("node", F.col("cell").alias("_b")), "node", "left")
    return got.select(*ids.columns, F.coalesce("_o", "_b").alias("cell"))


def compacted(base: DataFrame, overlay: DataFrame, deleted: DataFrame) -> DataFrame:
    """node, cell: base less tombstones and what the overlay has, and the overlay."""
    kept = base.join(deleted.select("node"), "node", "left_anti").join(overlay.select("node"), "node", "left_anti")
    return kept.select("node", "cell").unionByName(overlay.select("node", "cell"))


def sequential_prior(changes: DataFrame, base: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """changes (node, ord, visible, cell) with ``prior``: the cell known right before. A delete clears what the batch has set, so then the base counts again."""
    start = Window.partitionBy("node").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    marked = changes.withColumn("_seg", F.coalesce(F.sum(F.when(F.col("visible"), 0).otherwise(1)).over(start), F.lit(0)))
    inside = Window.partitionBy("node", "_seg").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("_own", F.last(F.when(F.col("visible"), F.col("cell")), ignorenulls=True).over(inside))
    marked = marked.join(base.select("node", F.col("cell").alias("_b")), "node", "left")
    held = F.lit(None).cast("long")
    if overlay is not None:
        marked = marked.join(overlay.select("node", F.col("cell").alias("_o")), "node", "left")
        held = F.when(F.col("_seg") == 0, F.col("_o"))
    return marked.select(*changes.columns, F.coalesce("_own", held, "_b").alias("prior"))
