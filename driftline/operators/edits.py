"""Object versions: classification, predicates and the counts that the screens start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import geo


def change(visible: str = "visible", version: str = "version") -> Column:
    """deleted, created or modified."""
    return F.when(~F.col(visible), "deleted").when(F.col(version) == 1, "created").otherwise("modified")


def without_creates(versions: DataFrame) -> DataFrame:
    return versions.where(~(F.col("visible") & (F.col("version") == 1)))


def located(versions: DataFrame) -> DataFrame:
    return versions.where(geo.valid_location(F.col("lat"), F.col("lon")))


def with_nodes(ways: DataFrame) -> DataFrame:
    """Visible ways need a node; deleted ones pass."""
    return ways.where(~F.col("visible") | (F.size("refs") > 0))


def checked_keys(tags: Column, longest: int = 255) -> Column:
    """The tags, or an error if a key is longer than ``longest`` bytes."""
    return F.when(F.exists(tags, lambda t: F.octet_length(t["k"]) > longest), F.raise_error(F.lit(f"tag key over {longest} bytes"))).otherwise(tags)


def checked_tags(tags: Column, most: int = 65_535) -> Column:
    """The tags, or an error if an object has more than ``most``."""
    return F.when(F.size(tags) > most, F.raise_error(F.lit(f"more than {most} tags"))).otherwise(tags)


def minute_counts(versions: DataFrame) -> DataFrame:
    """uid, minute, n: modified and deleted objects of all three kinds."""
    return without_creates(versions).groupBy("uid", "minute").agg(F.count(F.lit(1)).alias("n"))


def cell_counts(nodes: DataFrame, way_cells: DataFrame) -> DataFrame:
    """uid, minute, cell, n: a node counts in its cell, a way version once in each distinct cell; relations and unlocated nodes don't.

    nodes: uid, minute, cell, visible, version. way_cells: also way, one row for each node of the version.
    """
    own = without_creates(nodes).where("cell is not null").select("uid", "minute", "cell")
    ways = without_creates(way_cells).where("cell is not null").select("way", "version", "uid", "minute", "cell").distinct()
    return own.unionByName(ways.select("uid", "minute", "cell")).groupBy("uid", "minute", "cell").agg(F.count(F.lit(1)).alias("n"))


def key_counts(versions: DataFrame) -> DataFrame:
    """uid, minute, key, n: objects that carry the key, each key once an object. tags: array of struct(k, v)."""
    keys = F.array_distinct(F.transform(checked_keys(F.col("tags")), lambda t: t["k"]))
    return without_creates(versions).select("uid", "minute", F.explode(keys).alias("key")).groupBy("uid", "minute", "key").agg(F.count(F.lit(1)).alias("n"))
