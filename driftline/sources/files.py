"""Reading state files, change documents, staged tables, indexes and manifests."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.schemas import VERSIONS, assert_schema


def versions(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("node", "way", "relation")) -> DataFrame:
    """Object versions from Parquet, only of some kinds (pushed down to the scan)."""
    df = assert_schema(spark.read.parquet(path), T.StructType([f for f in VERSIONS.fields if f.name not in ("seq", "ts")]))
    return df if len(kinds) == 3 else df.where(F.col("type").isin(*kinds))


_TAG = T.ArrayType(T.StructType([T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())]))
_BASE = [T.StructField(n, t) for n, t in (("_id", T.LongType()), ("_version", T.IntegerType()), ("_timestamp", T.StringType()), ("_uid", T.LongType()), ("_user", T.StringType()), ("_lat", T.DoubleType()), ("_lon", T.DoubleType()))]
_ELEMENT = T.ArrayType(T.StructType([*_BASE, T.StructField("tag", _TAG), T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", T.LongType())]))), T.StructField("member", T.ArrayType(T.StructType([T.StructField("_ref", T.LongType())])))]))
_ACTION = T.ArrayType(T.StructType([T.StructField(k, _ELEMENT) for k in ("node", "way", "relation")]))
CHANGE_SCHEMA = T.StructType([T.StructField(a, _ACTION) for a in ("create", "modify", "delete")])


def change_documents(spark: SparkSession, path: str) -> DataFrame:
    """Versions from change documents (XML, also gzipped): elements under <delete> are invisible. ``seq`` is the number in the file's name."""
    raw = spark.read.format("xml").option("rowTag", "osmChange").schema(CHANGE_SCHEMA).load(path).withColumn("_path", F.input_file_name())
    seq = F.regexp_extract("_path", r"(\d+)\.osc(?:\.gz)?$", 1)
    out = None
    for action in ("create", "modify", "delete"):
        for kind in ("node", "way", "relation"):
            e = raw.select("_path", F.explode(action).alias("a")).select("_path", F.explode(f"a.{kind}").alias("e"))
            tags = F.transform(F.coalesce("e.tag", F.array().cast(_TAG)), lambda t: F.struct(t["_k"].alias("k"), t["_v"].alias("v")))
            refs = F.transform(F.coalesce("e.nd", F.array().cast(T.ArrayType(T.StructType([T.StructField("_ref", T.LongType())])))), lambda r: r["_ref"])
            one = e.select(
                F.lit(kind).alias("type"), F.col("e._id").alias("id"), F.col("e._version").alias("version"), F.lit(action != "delete").alias("visible"), F.to_timestamp("e._timestamp").alias("ts"),
                F.col("e._uid").alias("uid"), F.coalesce("e._user", F.lit("")).alias("user"), F.col("e._lat").alias("lat"), F.col("e._lon").alias("lon"), tags.alias("tags"), refs.alias("refs"), F.nullif(seq, F.lit("")).cast("long").alias("seq"),
            )
            out = one if out is None else out.unionByName(one)
    return out


def staged(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All staged tables below ``root``, with ``seq`` from the folder seq_<n> that a file is in."""
    raw = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    return raw.withColumn("seq", F.regexp_extract(F.col("_metadata.file_path"), r"seq_(\d+)", 1).cast("long"))


def parse_state(text: str) -> dict[str, str]:
    """key=value lines; # and blank lines are skipped. sequenceNumber and timestamp must be there."""
    out: dict[str, str] = {}
    for line in text.splitlines():
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        key, eq, value = line.partition("=")
        if eq:
            out[key.strip()] = value.strip()
    if not out.get("sequenceNumber", "").isdigit():
        raise ValueError("state without sequenceNumber")
    if not out.get("timestamp"):
        raise ValueError("state without timestamp")
    out["timestamp"] = re.sub(r"\\(.)", r"\1", out["timestamp"])
    return out


def sidecar(snapshot: str) -> str:
    """The state file beside a snapshot."""
    return re.sub(r"(\.osh)?(\.osm)?\.pbf$", "", snapshot) + ".state.txt"


def diff_path(seq: int) -> str:
    """Three folders of three digits: 1234567 is 001/234/567.osc.gz."""
    n = f"{seq:09d}"
    return f"{n[:3]}/{n[3:6]}/{n[6:]}.osc.gz"


def diff_sequence(name: str) -> int:
    m = re.search(r"(\d+)\.osc(?:\.gz)?$", name)
    if not m:
        raise ValueError(f"no sequence in {name}")
    return int(m[1])


def country_index(spark: SparkSession, cells: str, names: str) -> tuple[DataFrame, DataFrame]:
    """(s2_cell, country_id, level) with signed cells, and (country_id, iso)."""
    index = spark.read.parquet(cells)
    wide = F.col("s2_cell").cast("decimal(20,0)")
    signed = F.when(wide >= F.lit(str(1 << 63)).cast("decimal(20,0)"), wide - F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(wide).cast("long")
    text = "\n".join(r[0] for r in spark.read.text(names).collect())
    iso = [(int(k), v) for k, v in json.loads(text).items()]
    return index.select(signed.alias("s2_cell"), F.col("country_id").cast("int").alias("country_id"), F.col("level").cast("int").alias("level")), spark.createDataFrame(iso, "country_id int, iso string")


def manifest_source(text: str) -> dict:
    """The source block of a manifest; {} without one."""
    try:
        return json.loads(text).get("source") or {}
    except (ValueError, AttributeError):
        return {}


def merge_diffs(diffs: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Diffs (with ``seq``) as one table in order of sequence, and (lo, hi) of its timestamps."""
    out = diffs[0]
    for d in diffs[1:]:
        out = out.unionByName(d)
    return out.orderBy("seq"), out.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))


def column_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
