"""Six anomaly screens. Thresholds are arguments with the usual values; all comparisons are as strict as they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions import geo, names, text, time
from driftline.operators.windows import BUCKET, SPAN, bucketed, trailing_sum

BURST_OVER = 500
MOVE_OVER_M = 500.0
SPREAD_EDITS, SPREAD_CELLS, SPREAD_KM2 = 20, 3, 20.0
COVER_OBJECTS, COVER_SHARE = 100, 0.90
LANGUAGE_EVENTS = 1


def burst_days(minutes: DataFrame, over: int = BURST_OVER) -> DataFrame:
    """uid, day, max_edits_per_hour, flag of days with a trailing hour over the limit. The day is that of the minute that fired."""
    fired = trailing_sum(minutes).where(F.col("hour") > over)
    return fired.groupBy("uid", time.day_of_minute().alias("day")).agg(F.max("hour").alias("max_edits_per_hour")).withColumn("flag", F.lit(text.BURST))


def far_moves(steps: DataFrame, over: float = MOVE_OVER_M) -> DataFrame:
    """uid, minute, meters of visible later versions that moved further. steps: uid, minute, visible, version, lat, lon, lat0, lon0 (where it was)."""
    known = geo.valid_location(F.col("lat"), F.col("lon")) & F.col("lat0").isNotNull() & F.col("lon0").isNotNull()
    meters = geo.haversine_m(F.col("lat0"), F.col("lon0"), F.col("lat"), F.col("lon"))
    return steps.where(F.col("visible") & (F.col("version") > 1) & known).select("uid", "minute", meters.alias("m")).where(F.col("m") > over).select("uid", "minute", F.floor("m").alias("meters"))


def move_days(moves: DataFrame) -> DataFrame:
    """uid, day, far_move_count, max_move_meters, flag."""
    got = moves.groupBy("uid", time.day_of_minute().alias("day")).agg(F.count(F.lit(1)).alias("far_move_count"), F.max("meters").alias("max_move_meters"))
    return got.withColumn("flag", F.lit(text.MOVE))


def spread_minutes(cells: DataFrame, minutes: DataFrame, km2: float, edits: int = SPREAD_EDITS, distinct: int = SPREAD_CELLS, budget: float = SPREAD_KM2, span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """uid, minute, edits, cells, spread_km2, flagged on the union of both minute grids; users in one table only are left out.

    A cell counts from each of its minutes until it falls out of the window or shows up again; so distinct cells are a running sum of
    +1 and -1, with no sets to be held.
    """
    who = cells.select("uid").distinct().join(minutes.select("uid").distinct(), "uid", "left_semi")
    at = bucketed(cells.join(who, "uid", "left_semi").select("uid", "minute", "cell").distinct(), "minute", span, bucket)
    again = F.lead("minute").over(Window.partitionBy("uid", "bucket", "cell").orderBy("minute"))
    at = at.withColumn("_end", F.least(F.col("minute") + span, F.coalesce(again, F.col("minute") + span)))
    none = F.lit(0).cast("long")
    steps = at.select("uid", "bucket", "minute", F.lit(1).cast("long").alias("d"), none.alias("n"), (~F.col("halo")).alias("grid"))
    steps = steps.unionByName(at.select("uid", "bucket", F.col("_end").alias("minute"), F.lit(-1).cast("long").alias("d"), none.alias("n"), F.lit(False).alias("grid")))
    edit = bucketed(minutes.join(who, "uid", "left_semi"), "minute", span, bucket)
    steps = steps.unionByName(edit.select("uid", "bucket", "minute", none.alias("d"), F.col("n").cast("long").alias("n"), (~F.col("halo")).alias("grid")))
    one = steps.groupBy("uid", "bucket", "minute").agg(F.sum("d").alias("d"), F.sum("n").alias("n"), F.max("grid").alias("grid"))
    w = Window.partitionBy("uid", "bucket").orderBy("minute")
    one = one.withColumn("cells", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("edits", F.sum("n").over(w.rangeBetween(-(span - 1), 0)))
    flagged = (F.col("edits") >= edits) & (F.col("cells") >= distinct) & (F.col("spread_km2") >= budget)
    return one.where("grid").select("uid", "minute", "edits", "cells", (F.col("cells") * km2).alias("spread_km2")).withColumn("flagged", flagged)


def spread_days(cells: DataFrame, minutes: DataFrame, km2: float, **limits) -> DataFrame:
    """uid, day, spread_km2 (the day's peak over flagged minutes), flag."""
    fired = spread_minutes(cells, minutes, km2, **limits).where("flagged")
    return fired.groupBy("uid", time.day_of_minute().alias("day")).agg(F.max("spread_km2").alias("spread_km2")).withColumn("flag", F.lit(text.SPREAD))


def coverage_minutes(keys: DataFrame, minutes: DataFrame, objects: int = COVER_OBJECTS, share: float = COVER_SHARE, span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """uid, minute, total, key, n of keys with more than ``share`` of a trailing hour's objects, on the union of both grids.

    A key may qualify at a minute without a row of its own, as the total shrinks. Minutes below the gate go before keys are joined
    to the minutes of their own and the next ``span``-bucket.
    """
    who = keys.select("uid").distinct().join(minutes.select("uid").distinct(), "uid", "left_semi")
    keys, minutes = keys.join(who, "uid", "left_semi"), minutes.join(who, "uid", "left_semi")
    grid = minutes.select("uid", "minute", "n").unionByName(keys.select("uid", "minute", F.lit(0).cast("long").alias("n"))).groupBy("uid", "minute").agg(F.sum("n").alias("n"))
    grid = trailing_sum(grid, span=span, bucket=bucket).where(F.col("hour") >= objects).select("uid", "minute", F.col("hour").alias("total"), F.expr(f"minute div {span}").alias("h"))
    near = keys.select("uid", F.col("minute").alias("m0"), "key", F.col("n").alias("kn"), F.explode(F.expr(f"array(minute div {span}, minute div {span} + 1)")).alias("h"))
    met = grid.join(near, ["uid", "h"]).where((F.col("minute") >= F.col("m0")) & (F.col("minute") < F.col("m0") + span))
    sums = met.groupBy("uid", "minute", "total", "key").agg(F.sum("kn").alias("n"))
    return sums.where(F.col("n") > share * F.col("total"))


def coverage_days(keys: DataFrame, minutes: DataFrame, **limits) -> DataFrame:
    """uid, day, changed_keys (sorted, an unknown key last), flag."""
    found = F.array_sort(F.transform(F.collect_set(F.struct("key")), lambda x: x["key"]))
    got = coverage_minutes(keys, minutes, **limits).groupBy("uid", time.day_of_minute().alias("day")).agg(found.alias("changed_keys"))
    return got.withColumn("flag", F.lit(text.COVERAGE))


def language_events(versions: DataFrame, prior: DataFrame | None = None, form: Callable[[Column], Column] = names.as_bytes) -> DataFrame:
    """uid, day, event, lang of each version whose name tags look misused. versions: type, id, version, visible, uid, day, tags.

    What a version is held against are the object's remembered tags: of the version before, or of ``prior`` (type, id, tags); a deletion clears them.
    Typos are told by the edit distance of what ``form`` makes of two names, their bytes.
    """
    empty = F.array().cast("array<struct<k:string,v:string>>")
    w = Window.partitionBy("type", "id").orderBy("version")
    now = F.when(F.col("visible"), names.tracked_tags(F.col("tags"))).otherwise(empty)
    rows = versions.withColumn("_now", now).withColumn("_prev", F.lag("_now").over(w))
    if prior is not None:
        rows = rows.join(prior.select("type", "id", F.col("tags").alias("_p")), ["type", "id"], "left").withColumn("_prev", F.coalesce("_prev", "_p"))
    rows = rows.withColumn("_prev", F.coalesce("_prev", empty)).where(F.col("visible") & (F.col("version") > 1))
    return rows.withColumn("_e", names.language_event(F.col("_prev"), F.col("tags"), form)).where("_e is not null").select("uid", "day", "_e.event", "_e.lang")


def last_tags(versions: DataFrame) -> DataFrame:
    """type, id, tags: what is remembered after the last version of each object; deleted ones and those without such tags are absent."""
    last = versions.groupBy("type", "id").agg(F.max_by(F.struct("visible", "tags"), "version").alias("_l"))
    return last.where("_l.visible").select("type", "id", names.tracked_tags(F.col("_l.tags")).alias("tags")).where(F.size("tags") > 0)


def checked_lang(lang: Column, longest: int = 255) -> Column:
    """The language code, or an error if it is longer than ``longest`` bytes."""
    return F.when(F.octet_length(lang) > longest, F.raise_error(F.lit(f"language code over {longest} bytes"))).otherwise(lang)


def language_counts(events: DataFrame) -> DataFrame:
    """uid, day, lang, n."""
    return events.withColumn("lang", checked_lang(F.col("lang"))).groupBy("uid", "day", "lang").agg(F.count(F.lit(1)).alias("n"))


def language_days(counts: DataFrame, least: int = LANGUAGE_EVENTS) -> DataFrame:
    """uid, day, name_lang_events, primary_lang (most events, the first by name on a tie), primary_count, flag."""
    got = counts.where(F.col("n") >= least).groupBy("uid", "day", "lang").agg(F.sum("n").alias("n")).groupBy("uid", "day").agg(F.sum("n").alias("name_lang_events"), F.max("n").alias("primary_count"), F.min(F.struct(-F.col("n"), F.col("lang").alias("lang"))).alias("_m"))
    return got.select("uid", "day", "name_lang_events", F.col("_m.lang").alias("primary_lang"), "primary_count", F.lit(text.LANGUAGE).alias("flag"))
