"""What a viewer asks of the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import time
from driftline.schemas import CHANGE_COUNTERS

ZOOM = 12


def check_query(start: str, end: str, zoom: int | None = None, least: int = ZOOM) -> None:
    """Dates must be there and in order, and the map near enough."""
    if not start or not end:
        raise ValueError("start and end date are needed")
    if dt.date.fromisoformat(start) > dt.date.fromisoformat(end):
        raise ValueError("start is after end")
    if zoom is not None and zoom < least:
        raise ValueError(f"zoom in to {least} or closer")


def years(cube: DataFrame) -> DataFrame:
    return cube.select("year").distinct().orderBy("year")


def in_box(cube: DataFrame, cells: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Rows of the cells in the days. Years prune partitions, ranges of cell and day prune row groups, and the exact set is a semi-join.

    ``cells`` (cell) comes from a box on a map; its smallest and largest are read first (one row).
    """
    lo, hi = cells.agg(F.min("cell"), F.max("cell")).first()
    out = cube
    if "year" in cube.columns:
        out = out.where(F.col("year").between(int(time.day_key(first_day)[:4]), int(time.day_key(last_day)[:4])))
    if lo is None:
        return out.where(F.lit(False))
    return out.where(F.col("cell").between(lo, hi) & F.col("day").between(first_day, last_day)).join(cells.select("cell").distinct(), "cell", "left_semi")


def rolled_up(rows: DataFrame) -> DataFrame:
    """cell, day, count by cell, by day and in total, in one pass (grouping sets)."""
    return rows.groupingSets([["cell"], ["day"], []], "cell", "day").agg(F.sum("count").alias("count"))


def by_cell(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cell").agg(F.sum("count").alias("count"))


def by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day").agg(F.sum("count").alias("count"))


def busiest_days(cube: DataFrame, n: int = 20) -> DataFrame:
    return by_day(cube).orderBy(F.desc("count"), "day").limit(n)


def gap_filled(days: DataFrame, first_day: int, last_day: int, log: bool = False) -> DataFrame:
    """Every day of the range with its count; 0 where there's none, on a log scale null."""
    spark = days.sparkSession
    all_days = spark.range(first_day, last_day + 1).select(F.col("id").cast("int").alias("day"))
    count = F.coalesce("count", F.lit(0).cast("long"))
    return all_days.join(days, "day", "left").select("day", (F.nullif(count, F.lit(0)) if log else count).alias("count"))


def by_username(ranking: DataFrame, name: str) -> DataFrame:
    return ranking.where(F.col("username") == name)


def timeline(history: DataFrame, uids: list[int]) -> DataFrame:
    """Days of some users: the range goes down to the scan, then the exact set."""
    if not uids:
        return history.where(F.lit(False))
    return history.where(F.col("uid").between(min(uids), max(uids)) & F.col("uid").isin(uids))


def profile_days(history: DataFrame) -> DataFrame:
    """day, count, flags."""
    return history.groupBy("change_date").agg(F.sum("count").alias("count"), F.bit_or("suspect_flag").alias("flags"))


def total_edits(ranking: DataFrame) -> DataFrame:
    """The six node and way counters added up."""
    six = [c for c in CHANGE_COUNTERS if not c.startswith("relation")]
    return ranking.withColumn("total_edits", sum((F.col(c) for c in six[1:]), F.col(six[0])))


def latest(suspects: DataFrame, n: int = 100) -> DataFrame:
    return suspects.orderBy(F.desc("change_date"), F.asc_nulls_last("uid")).limit(n)


def filtered(suspects: DataFrame, *, date: str = "", country: str = "", user: str = "", keys: str = "", uid: str = "", least: dict[str, float] | None = None, ranking: tuple[float | None, float | None] = (None, None)) -> DataFrame:
    """Suspects by column; what is blank filters nothing. country NONE: no country. Texts are found anywhere, whatever their case."""
    out = suspects
    if date.strip():
        out = out.where(F.col("change_date") == time.epoch_day(date.strip()))
    if code := country.strip().upper():
        out = out.where(F.size("countries") == 0 if code == "NONE" else F.array_contains(F.transform("countries", F.upper), code))
    if user.strip():
        out = out.where(F.lower("username").contains(user.strip().lower()))
    if keys.strip():
        out = out.where(F.lower(F.array_join("changed_keys", ", ")).contains(keys.strip().lower()))
    if uid.strip():
        out = out.where(F.col("uid") == int(uid))
    for c, v in (least or {}).items():
        if v is not None:
            out = out.where(F.coalesce(F.col(c), F.lit(0)) >= v)
    if ranking[0] is not None:
        out = out.where(F.col("ranking_at_day") >= ranking[0])
    if ranking[1] is not None:
        out = out.where(F.col("ranking_at_day") <= ranking[1])
    return out


def query_parquet(spark: SparkSession, path: str, schema, condition=None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Filtered read of a Parquet path; a path that isn't there has no rows."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    out = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    out = out.where(condition) if condition is not None else out
    out = out.select(*columns) if columns else out
    return out.limit(limit) if limit is not None else out
