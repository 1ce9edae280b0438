"""The driver's tables seen as edit histories, in Spark and in the SQL of the checks. Both say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import time
from driftline.schemas import TAG_KEYS

KM2 = 10.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, uid, username, secs, minute, day, kind, visible, version, key, k, cell, value from events."""
    secs = time.seconds("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    df = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("uid"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"), secs.alias("secs"), (F.col("event_id") % 3).cast("int").alias("kind"),
        (F.col("event_type") != "error").alias("visible"), F.when(F.col("event_type") == "signup", 1).otherwise(2).alias("version"), F.col("event_type").alias("key"), k.alias("k"), (k % 20).cast("long").alias("cell"), "value",
    )
    return df.select("*", time.minute_of_seconds("secs").alias("minute"), time.day_of_seconds("secs").alias("day"))


EDITS = """edits AS (
  SELECT *, secs // 60 AS minute, CAST(secs // 86400 AS INTEGER) AS day FROM (
    SELECT event_id AS id, user_id AS uid, 'user' || user_id AS username, CAST(floor(epoch(ts)) AS BIGINT) AS secs, CAST(event_id % 3 AS INTEGER) AS kind, event_type <> 'error' AS visible,
      CASE WHEN event_type = 'signup' THEN 1 ELSE 2 END AS version, event_type AS key, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS cell, value
    FROM events))"""
MINUTES = "minutes AS (SELECT uid, minute, count(*) AS n FROM edits WHERE NOT (visible AND version = 1) GROUP BY uid, minute)"
CELLS = "cells AS (SELECT uid, minute, cell, count(*) AS n FROM edits WHERE NOT (visible AND version = 1) AND kind < 2 GROUP BY uid, minute, cell)"
KEYS = "keys AS (SELECT uid, minute, key, count(*) AS n FROM edits WHERE NOT (visible AND version = 1) GROUP BY uid, minute, key)"


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node versions (id, version, visible, day, cell) from lineitem; returned lines have no coordinates and are deletions."""
    order = F.struct("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey")
    deleted = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), order.alias("version"), (~deleted).alias("visible"), F.unix_date(F.col("l_shipdate").cast("date")).alias("day"), F.when(~deleted, F.col("l_suppkey")).alias("cell"))


NODES = """nodes AS (
  SELECT l_partkey AS id, (l_orderkey, l_linenumber, l_shipdate, l_suppkey) AS version, l_returnflag <> 'R' AS visible, CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS day,
    CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS cell FROM lineitem)"""
HISTORY = "history AS (SELECT id AS node, day, arg_max(cell, version) AS cell FROM nodes WHERE cell IS NOT NULL GROUP BY id, day)"


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """way versions (id, version, visible, day, refs): an order is a version of the way that its customer draws; failed ones are deletions."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("version"), (F.col("o_orderstatus") != "P").alias("visible"), F.unix_date(F.col("o_orderdate").cast("date")).alias("day"))
    refs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_partkey").alias("refs"))
    return o.join(refs, "o_orderkey", "left").select("id", "version", "visible", "day", F.coalesce("refs", F.array().cast("array<bigint>")).alias("refs"))


WAYS = """ways AS (
  SELECT o_custkey AS id, o_orderkey AS version, o_orderstatus <> 'P' AS visible, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS day, coalesce(refs, []) AS refs
  FROM orders LEFT JOIN (SELECT l_orderkey, list(DISTINCT l_partkey) AS refs FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, username, day, ord, kind, visible, version, tags from orders."""
    keys = F.array(*(F.lit(k) for k in TAG_KEYS))
    name = F.when(F.col("o_custkey") % 11 == 0, "").otherwise(F.concat(F.lit("c"), (F.col("o_custkey") % 97).cast("string")))
    key = F.get(keys, (F.col("o_orderkey") % 12).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("uid"), name.alias("username"), F.unix_date(F.col("o_orderdate").cast("date")).alias("day"), F.col("o_orderkey").alias("ord"), (F.col("o_orderkey") % 3).cast("int").alias("kind"), (F.col("o_orderstatus") != "P").alias("visible"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), 1).otherwise(2).alias("version"), F.array(F.struct(key.alias("k"), F.lit("yes").alias("v"))).alias("tags"),
    )


VERSIONS = """versions AS (
  SELECT o_custkey AS uid, CASE WHEN o_custkey % 11 = 0 THEN '' ELSE 'c' || (o_custkey % 97) END AS username, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS day, o_orderkey AS ord, o_orderkey % 3 AS kind, o_orderstatus <> 'P' AS visible,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 ELSE 2 END AS version,
    __KEYS__[o_orderkey % 12 + 1] AS key FROM orders)""".replace("__KEYS__", str(list(TAG_KEYS)))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node moves (uid, minute, visible, version, lat, lon, lat0, lon0) from events: an object a user, in order of time, those without one last."""
    from pyspark.sql import Window

    at = edits(spark, sf_dir).select("uid", "minute", "secs", "id", "visible", "version", F.when(F.col("visible"), F.col("value") / 10).alias("lat"), F.when(F.col("visible"), F.col("k").cast("double")).alias("lon"))
    w = Window.partitionBy("uid").orderBy(F.asc_nulls_last("secs"), F.asc_nulls_last("id")).rowsBetween(Window.unboundedPreceding, -1)
    return at.select("*", F.last("lat", ignorenulls=True).over(w).alias("lat0"), F.last("lon", ignorenulls=True).over(w).alias("lon0"))


STEPS = """steps AS (
  SELECT *, last_value(lat IGNORE NULLS) OVER w AS lat0, last_value(lon IGNORE NULLS) OVER w AS lon0 FROM (
    SELECT uid, minute, secs, id, visible, version, CASE WHEN visible THEN value / 10 END AS lat, CASE WHEN visible THEN CAST(k AS DOUBLE) END AS lon FROM edits)
  WINDOW w AS (PARTITION BY uid ORDER BY secs, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
moves AS (
  SELECT uid, minute, CAST(floor(m) AS BIGINT) AS meters FROM (
    SELECT uid, minute, 2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)) AS m FROM (
      SELECT uid, minute, least(1.0, greatest(0.0, pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2))) AS a
      FROM steps WHERE visible AND version > 1 AND lat IS NOT NULL AND lat0 IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180))
  WHERE m > 5000000)"""
FAR = 5_000_000.0


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """object versions with name tags (type, id, version, visible, uid, day, tags) from documents: a source is an object, each document a version."""
    text = F.coalesce("text", F.lit(""))
    first, second = F.regexp_extract(text, r"^[\x20\t-\r]*([^\x20\t-\r]+)", 1), F.regexp_extract(text, r"^[\x20\t-\r]*[^\x20\t-\r]+[\x20\t-\r]+([^\x20\t-\r]+)", 1)
    tag = lambda k, v: F.struct(k.alias("k"), v.alias("v"))
    n = F.col("doc_id")
    name = tag(F.lit("name"), first)
    own = tag(F.concat(F.lit("name:"), F.col("lang")), F.when(n % 5 == 0, first).otherwise(second))
    wiki = tag(F.concat(F.lit("wikipedia:"), F.col("lang")), (n % 3).cast("string"))
    tags = F.when(n % 7 == 0, F.array(own, wiki)).when(n % 4 == 0, F.array(name, own)).otherwise(F.array(name, own, wiki))
    return table(spark, sf_dir, "documents").select(F.lit("node").alias("type"), F.col("source").alias("id"), (n + 1).alias("version"), (n % 13 != 0).alias("visible"), (n % 20).alias("uid"), (n % 30).cast("int").alias("day"), tags.alias("tags"))


TAGGED = r"""tagged AS (
  SELECT source AS id, doc_id + 1 AS version, doc_id % 13 <> 0 AS visible, doc_id % 20 AS uid, CAST(doc_id % 30 AS INTEGER) AS day, lang,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE w0 END AS name, CASE WHEN doc_id % 5 = 0 THEN w0 ELSE w1 END AS own, CASE WHEN doc_id % 4 = 0 AND doc_id % 7 <> 0 THEN NULL ELSE CAST(doc_id % 3 AS VARCHAR) END AS wiki
  FROM (SELECT *, regexp_extract(coalesce(text, ''), '^[\x20\t-\r]*([^\x20\t-\r]+)', 1) AS w0, regexp_extract(coalesce(text, ''), '^[\x20\t-\r]*[^\x20\t-\r]+[\x20\t-\r]+([^\x20\t-\r]+)', 1) AS w1 FROM documents)),
before AS (
  SELECT *, lag(visible) OVER w AS pvis, lag(lang) OVER w AS plang, lag(name) OVER w AS pname, lag(own) OVER w AS pown, lag(wiki) OVER w AS pwiki FROM tagged WINDOW w AS (PARTITION BY id ORDER BY version)),
events_ AS (
  SELECT uid, day, CASE
      WHEN pvis AND pwiki IS NOT NULL AND wiki = pwiki AND lang <> plang THEN plang
      WHEN pvis AND plang <> lang THEN plang
      WHEN pvis AND name <> '' AND pname <> name AND own <> pname AND levenshtein(CAST(encode(pname) AS VARCHAR), CAST(encode(name) AS VARCHAR)) > 2 THEN lang
      WHEN name <> '' AND own = name AND NOT coalesce(pvis AND plang = lang AND pown = name, false) THEN lang
      WHEN pvis AND pname IS NOT NULL AND name IS NULL THEN lang END AS lang
  FROM before WHERE visible AND version > 1),
langs AS (SELECT uid, day, lang, count(*) AS n FROM events_ WHERE lang IS NOT NULL GROUP BY uid, day, lang)"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, iso: a cell is a supplier, its country the nation."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("cell"), F.upper(F.substring("n_name", 1, 3)).alias("iso"))


PLACES = "places AS (SELECT s_suppkey AS cell, upper(substr(n_name, 1, 3)) AS iso FROM supplier JOIN nation ON s_nationkey = n_nationkey)"


def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, lat, lon by rule from the supplier's key."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell"), ((F.col("s_suppkey") * 37) % 180 - 90).cast("double").alias("lat"), ((F.col("s_suppkey") * 53) % 360 - 180).cast("double").alias("lon"))


CENTRES = "centres AS (SELECT s_suppkey AS cell, CAST((s_suppkey * 37) % 180 - 90 AS DOUBLE) AS lat, CAST((s_suppkey * 53) % 360 - 180 AS DOUBLE) AS lon FROM supplier)"


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, year, cell, day, count: each month of shipping is a staged diff."""
    date = F.col("l_shipdate").cast("date")
    seq = (F.year(date) * 12 + F.month(date)).cast("long")
    return table(spark, sf_dir, "lineitem").groupBy(seq.alias("seq"), F.year(date).alias("year"), F.col("l_suppkey").alias("cell"), F.unix_date(date).alias("day")).agg(F.count(F.lit(1)).alias("count"))


STAGED = """staged AS (
  SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS seq, CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey AS cell, CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS INTEGER) AS day, count(*) AS count
  FROM lineitem GROUP BY ALL)"""
