"""Trailing windows over minutes, in buckets of time so that one busy user is spread over many tasks.

A window reaches SPAN - 1 minutes back. Each row goes to its bucket and, where it's near the end, also as a halo to the
next one; every bucket then is complete in itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN = 60
BUCKET = 7 * 1440


def bucketed(rows: DataFrame, minute: str = "minute", span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """``rows`` with ``bucket`` and ``halo``: copies near a bucket's end stand in the next bucket too."""
    b = F.expr(f"cast(floor({minute} / {bucket}) as bigint)")
    late = F.pmod(F.col(minute), F.lit(bucket)) > bucket - span
    copies = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_b", b).withColumn("_c", F.explode(copies)).withColumn("bucket", F.col("_b") + F.col("_c")).withColumn("halo", F.col("_c") == 1).drop("_b", "_c")


def trailing_sum(rows: DataFrame, by: str = "uid", minute: str = "minute", n: str = "n", span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """(by, minute, n) with one row a minute: adds ``hour``, the sum of n over (minute - span, minute]."""
    w = Window.partitionBy(by, "bucket").orderBy(minute).rangeBetween(-(span - 1), 0)
    return bucketed(rows, minute, span, bucket).withColumn("hour", F.sum(n).over(w)).where(~F.col("halo")).drop("bucket", "halo")
