"""Activity of each user: per day, in total, and ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.edits import change
from driftline.schemas import ASPECTS, CHANGE_COUNTERS, COUNTERS, KINDS, TAG_KEYS

#: Most points of each aspect: node, way, relation, and each tag (fixed values).
CAPS = dict.fromkeys(ASPECTS, 4) | {"node": 20, "way": 20, "relation": 12}
LOW = 5


def user_days(versions: DataFrame) -> DataFrame:
    """uid, day, username (the first of the day that is not empty) and 21 counters, in one aggregation.

    versions: uid, username, day, ord, kind (0..2), visible, version, tags.
    """
    rows = versions.withColumn("_c", change())
    created = (F.col("_c") == "created").cast("int")
    has = lambda key: F.exists("tags", lambda t: t["k"] == key)
    counts: list[Column] = []
    for i, k in enumerate(KINDS):
        counts += [F.count(F.when((F.col("kind") == i) & (F.col("_c") == c), 1)).alias(f"{k}_{c}") for c in ("created", "modified", "deleted")]
    counts += [F.count(F.when((created == 1) & has(key), 1)).alias(f"tag_{key}") for key in TAG_KEYS]
    name = F.min_by("username", F.when(F.col("username") != "", F.col("ord")))
    return rows.groupBy("uid", "day").agg(F.coalesce(name, F.lit("")).alias("username"), *counts)


def day_total() -> Column:
    """The nine change counters; tags don't count."""
    return sum((F.col(c) for c in CHANGE_COUNTERS[1:]), F.col(CHANGE_COUNTERS[0]))


def history(days: DataFrame) -> DataFrame:
    """uid, change_date, count, suspect_flag 0; rows of one user's day are folded."""
    return days.groupBy("uid", F.col("day").alias("change_date")).agg(F.sum(day_total()).alias("count")).withColumn("suspect_flag", F.lit(0))


def shown_name(name: Column, uid: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("<"), uid.cast("string"), F.lit(">")))


def totals(days: DataFrame) -> DataFrame:
    """uid, username (the latest that is not empty, else <uid>), first_seen_day and the 21 sums."""
    latest = F.max_by("username", F.when(F.col("username") != "", F.col("day")))
    got = days.groupBy("uid").agg(latest.alias("_n"), F.min("day").alias("first_seen_day"), *(F.sum(c).alias(c) for c in COUNTERS))
    return got.select("uid", shown_name(F.col("_n"), F.col("uid")).alias("username"), "first_seen_day", *COUNTERS)


def merged_totals(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Full outer of two tables of totals: sums, the earlier first day, the delta's name unless it has none."""
    b = base.select("uid", F.col("username").alias("_bn"), F.col("first_seen_day").alias("_bf"), *(F.col(c).alias(f"_b{c}") for c in COUNTERS))
    none = F.concat(F.lit("<"), F.col("uid").cast("string"), F.lit(">"))
    name = F.when(F.col("username").isNull() | (F.col("username") == "") | (F.col("username") == none), F.coalesce("_bn", "username")).otherwise(F.col("username"))
    sums = (((F.coalesce(c, F.lit(0)) + F.coalesce(f"_b{c}", F.lit(0))).alias(c)) for c in COUNTERS)
    return b.join(delta, "uid", "full_outer").select("uid", name.alias("username"), F.least("_bf", "first_seen_day").alias("first_seen_day"), *sums)


def aspect_rows(users: DataFrame) -> DataFrame:
    """uid, aspect, total: what is ranked are created objects."""
    pairs = [F.struct(F.lit(a).alias("aspect"), F.col(a if a.startswith("tag_") else f"{a}_created").alias("total")) for a in ASPECTS]
    return users.select("uid", F.explode(F.array(*pairs)).alias("_p")).select("uid", "_p.aspect", "_p.total")


def percentiles(rows: DataFrame) -> DataFrame:
    """uid, aspect, total, pct: 100 * (users below) / (active - 1) among the active ones; a sole one has 100.

    Users with equal totals share their percentile, so only distinct totals are put in order: one window row for each, not for each user.
    """
    levels = rows.where("total > 0").groupBy("aspect", "total").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("aspect")
    below = F.coalesce(F.sum("n").over(w.orderBy("total").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    levels = levels.withColumn("_below", below).withColumn("_active", F.sum("n").over(w))
    pct = F.when(F.col("_active") == 1, 100.0).otherwise(100.0 * F.col("_below") / F.nullif(F.col("_active") - 1, F.lit(0)))
    ranked = levels.select("aspect", "total", pct.alias("pct"))
    return rows.join(ranked, ["aspect", "total"], "left").select("uid", "aspect", "total", F.coalesce("pct", F.lit(0.0)).alias("pct"))


def score() -> Column:
    """0..100 from the ``<aspect>_pct`` columns."""
    points = sum((F.col(f"{a}_pct") * CAPS[a] / 100 for a in ASPECTS[1:]), F.col(f"{ASPECTS[0]}_pct") * CAPS[ASPECTS[0]] / 100)
    return F.greatest(F.lit(0), F.least(F.lit(100), F.round(points).cast("int")))


def ranking(users: DataFrame) -> DataFrame:
    """The totals with ``ranking`` and a percentile for each aspect."""
    wide = percentiles(aspect_rows(users)).groupBy("uid").agg(*(F.max(F.when(F.col("aspect") == a, F.col("pct"))).alias(f"{a}_pct") for a in ASPECTS))
    return users.join(wide, "uid").withColumn("ranking", score())


def ranking_stats(users: DataFrame) -> DataFrame:
    """aspect, active, most."""
    return aspect_rows(users).groupBy("aspect").agg(F.count(F.when(F.col("total") > 0, 1)).alias("active"), F.max("total").alias("most"))
