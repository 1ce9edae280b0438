"""Tables that are written once and read several times, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from driftline.sources import fs

_OWN: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession, what: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``; it goes when the program ends. Only a local session may do without the setting."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="driftline-")
        spark.conf.set("spark.checkpoint.dir", found)
    path = f"{found}/driftline-scratch/{what}-{uuid.uuid4().hex}"
    _OWN.append((spark, path))
    return path


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table, read again: computed once, and it outlives lost executors."""
    path = folder(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _sweep() -> None:
    for spark, path in _OWN:
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            fs.delete(spark, path)
