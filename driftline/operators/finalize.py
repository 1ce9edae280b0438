"""Bringing a run together: history, ranking and the table of suspects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import geo, text
from driftline.operators import activity

DAY = ["uid", "change_date"]


def folded(history: DataFrame) -> DataFrame:
    """One row a user's day: counts added, flags united."""
    return history.groupBy(*DAY).agg(F.sum("count").alias("count"), F.bit_or("suspect_flag").alias("suspect_flag"))


def history_merge(base: DataFrame, delta: DataFrame) -> DataFrame:
    """uid, change_date, count, suspect_flag, from_base: counts of both added, flags of the base carried."""
    b = base.select(*DAY, "count", "suspect_flag", F.lit(True).alias("from_base"))
    d = delta.select(*DAY, "count", F.lit(0).alias("suspect_flag"), F.lit(False).alias("from_base"))
    return b.unionByName(d).groupBy(*DAY).agg(F.sum("count").alias("count"), F.bit_or("suspect_flag").alias("suspect_flag"), F.max("from_base").alias("from_base"))


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def flagged(history: DataFrame, ranking: DataFrame, burst: DataFrame, moves: DataFrame, spread: DataFrame, coverage: DataFrame, language: DataFrame, previous: DataFrame | None = None, low: int = activity.LOW) -> DataFrame:
    """The history joined with everything known of its days, and its new flag.

    Flags only grow. The low-rank bit is set on days that the base did not have; move columns and the ranking stay as they were first exported.
    """
    on = lambda df: df.withColumnRenamed("day", "change_date")
    rows = history.join(ranking.select("uid", "username", "ranking"), "uid", "left")
    rows = rows.join(on(burst).select(*DAY, "max_edits_per_hour", F.col("flag").alias("_f1")), DAY, "left")
    rows = rows.join(on(moves).select(*DAY, F.col("far_move_count").alias("_mc"), F.col("max_move_meters").alias("_mm"), F.col("flag").alias("_f2")), DAY, "left")
    rows = rows.join(on(spread).select(*DAY, "spread_km2", F.col("flag").alias("_f3")), DAY, "left")
    rows = rows.join(on(coverage).select(*DAY, "changed_keys", F.col("flag").alias("_f4")), DAY, "left")
    rows = rows.join(on(language).select(*DAY, "name_lang_events", F.col("flag").alias("_f5")), DAY, "left")
    if previous is None:
        rows = rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("_pc", "long"), ("_pm", "long"), ("_pr", "int"))), F.lit(None).cast("boolean").alias("_was"))
    else:
        rows = rows.join(previous.select(*DAY, F.col("far_move_count").alias("_pc"), F.col("max_move_meters").alias("_pm"), F.col("ranking_at_day").alias("_pr"), F.lit(True).alias("_was")), DAY, "left")
    new = _flag("_f1").bitwiseOR(_flag("_f2")).bitwiseOR(_flag("_f3")).bitwiseOR(_flag("_f4")).bitwiseOR(_flag("_f5"))
    poor = F.when(~F.col("from_base") & (F.coalesce("ranking", F.lit(0)) < low), text.LOW_RANK).otherwise(0)
    rows = rows.withColumn("suspect_flag", F.col("suspect_flag").bitwiseOR(new).bitwiseOR(poor))
    then = lambda old, now: F.when(F.col("_was"), F.col(old)).otherwise(F.coalesce(now, F.lit(0)))
    return rows.withColumn("far_move_count", then("_pc", F.col("_mc"))).withColumn("max_move_meters", then("_pm", F.col("_mm"))).withColumn("ranking_at_day", then("_pr", F.col("ranking")).cast("int"))


def history_of(rows: DataFrame) -> DataFrame:
    return rows.select(*DAY, "count", "suspect_flag")


def suspects(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """The 13 columns of days with a flag. countries: uid, change_date, countries."""
    none = F.array().cast("array<string>")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.where("suspect_flag <> 0").join(countries, DAY, "left").select(
        "uid", activity.shown_name(F.col("username"), F.col("uid")).alias("username"), "change_date", "suspect_flag", F.col("count").alias("changes"), zero("max_edits_per_hour"),
        F.coalesce("spread_km2", F.lit(0.0)).cast("float").alias("peak_spread_km2"), F.coalesce("changed_keys", none).alias("changed_keys"), F.coalesce("countries", none).alias("countries"),
        F.col("far_move_count").cast("long").alias("far_move_count"), F.col("max_move_meters").cast("long").alias("max_move_meters"), "ranking_at_day", zero("name_lang_events"),
    )


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("change_date"), "uid")


def country_of(points: DataFrame, index: DataFrame, names: DataFrame, leaf: str = "leaf", levels: tuple[int, int] = (0, 13)) -> DataFrame:
    """``points`` with ``iso`` of the cell that holds each leaf, null without one.

    index: s2_cell (signed), country_id. Cells are disjoint, so at most one ancestor of a leaf is in it: an equi-join on the
    exploded ancestors, not a range join. Only ancestors that the index has come back to the points.
    """
    ups = F.array(*(geo.s2_ancestor(F.col(leaf), k) for k in range(levels[0], levels[1] + 1)))
    places = points.select(leaf).where(F.col(leaf).isNotNull()).distinct()
    hit = places.select(leaf, F.explode(ups).alias("s2_cell")).join(index, "s2_cell").join(names.where("country_id <> 0 and iso is not null"), "country_id").select(leaf, "iso")
    return points.join(hit, leaf, "left")


def area_vote(parts: DataFrame) -> DataFrame:
    """cell, iso: of the countries that share a cell the one with the largest area; on a tie the smaller code. parts: cell, iso, area."""
    sums = parts.groupBy("cell", "iso").agg(F.sum("area").alias("area")).where("area > 0")
    return sums.groupBy("cell").agg(F.min(F.struct((-F.col("area")).alias("a"), F.coalesce("iso", F.lit("")).alias("iso"))).alias("_w")).select("cell", F.nullif("_w.iso", F.lit("")).alias("iso"))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, lo: str, hi: str, keep: list[str], width: int) -> DataFrame:
    """``points`` left-joined with the interval (inclusive, disjoint) that holds ``at``, by buckets of ``width``: an equi-join with a range."""
    cut = intervals.select(F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), *keep, F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))).alias("_w"))
    fits = (F.floor(F.col(at) / width) == F.col("_w")) & (F.col(at) >= F.col("_lo")) & (F.col(at) <= F.col("_hi"))
    return points.join(cut, fits, "left").drop("_lo", "_hi", "_w")


def countries_of_days(cells: DataFrame, places: DataFrame, days: DataFrame) -> DataFrame:
    """uid, change_date, countries (sorted, distinct) of the cells that users touched on the given days. cells: uid, minute, cell; places: cell, iso."""
    at = cells.select("uid", F.expr("cast(minute div 1440 as int)").alias("change_date"), "cell").distinct().join(days.select(*DAY), DAY, "left_semi")
    return at.join(places.where("iso is not null"), "cell").groupBy(*DAY).agg(F.array_sort(F.collect_set("iso")).alias("countries"))
