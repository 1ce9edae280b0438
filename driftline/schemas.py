"""Fixed schemas and the guard that holds a DataFrame against one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TAGS = T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())]))


_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(), "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "ARRAY<STRING>": T.ArrayType(T.StringType())}


def of(text: str) -> T.StructType:
    """A schema from "name TYPE, ..." without a session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in text.split(", "))])


VERSIONS = T.StructType([*of("type STRING, id BIGINT, version INT, visible BOOLEAN, ts TIMESTAMP, uid BIGINT, user STRING, lat DOUBLE, lon DOUBLE"), T.StructField("tags", _TAGS), T.StructField("refs", T.ArrayType(T.LongType())), T.StructField("seq", T.LongType())])
KINDS = ("node", "way", "relation")
#: The twelve tag keys that are counted on created objects (fixed values).
TAG_KEYS = ("amenity", "boundary", "building", "highway", "landuse", "leisure", "name", "natural", "place", "railway", "sport", "waterway")
CHANGE_COUNTERS = tuple(f"{k}_{c}" for k in KINDS for c in ("created", "modified", "deleted"))
TAG_COUNTERS = tuple(f"tag_{k}" for k in TAG_KEYS)
COUNTERS = CHANGE_COUNTERS + TAG_COUNTERS
ASPECTS = (*KINDS, *TAG_COUNTERS)
CUBE = of("h3_cell BIGINT, change_date INT, count BIGINT")
HISTORY = of("uid BIGINT, change_date INT, count BIGINT, suspect_flag INT")
RANKING = of("uid BIGINT, username STRING, first_seen_day INT, ranking INT, " + ", ".join(f"{c} BIGINT" for c in COUNTERS) + ", " + ", ".join(f"{a}_pct DOUBLE" for a in ASPECTS))
SUSPECTS = of("uid BIGINT, username STRING, change_date INT, suspect_flag INT, changes BIGINT, max_edits_per_hour BIGINT, peak_spread_km2 FLOAT, changed_keys ARRAY<STRING>, countries ARRAY<STRING>, far_move_count BIGINT, max_move_meters BIGINT, ranking_at_day INT, name_lang_events BIGINT")
MINUTES = of("uid BIGINT, minute BIGINT, n BIGINT")
CELLS = of("uid BIGINT, minute BIGINT, cell BIGINT, n BIGINT")
KEYS = of("uid BIGINT, minute BIGINT, key STRING, n BIGINT")
LANGS = of("uid BIGINT, day INT, lang STRING, n BIGINT")


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` itself if it has the expected columns with their types; a missing or differing one raises."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in expected.fields:
        if f.name not in have:
            raise ValueError(f"missing column: {f.name}")
        if have[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return df
