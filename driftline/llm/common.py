"""Shared pieces: tables written to the cluster's shared folder, Arrow batch helpers, table loading."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

_OWN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local one is set, but only if there is no other machine."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="driftline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():  # the session has ended
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def drop(tables: list[tuple[SparkSession, str]]) -> None:
    """Removes scratch tables that nothing reads any more, and empties the list."""
    while tables:
        one = tables.pop()
        if one in _OWN:
            _OWN.remove(one)
            _drop(*one)


def forget(*tables: DataFrame) -> None:
    """Removes tables that ``written`` gave, once all that was made of them is written too."""
    drop([t._scratch for t in tables])


@contextlib.contextmanager
def recorded(into: list[tuple[SparkSession, str]]) -> Iterator[None]:
    """Lists the tables written meanwhile, for ``drop``."""
    before = len(_OWN)
    try:
        yield
    finally:
        into += _OWN[before:]


@atexit.register
def _sweep() -> None:
    drop(list(_OWN))


@contextlib.contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run meanwhile go when it has ended: its result is in the shared folder then."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/driftline/{what}-{uuid.uuid4().hex}"
    _OWN.append((spark, path))
    with _tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = (spark, path)
    return out


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``most`` bytes of ``column`` (or a single row)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        at = total = 0
        for i, n in enumerate(sizes.tolist()):
            if i > at and total + n > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n
        if at < batch.num_rows:
            yield batch.slice(at)


def balanced(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column`` (or a single row): larger ones are cut and smaller ones joined."""
    held: list[pa.RecordBatch] = []
    total = 0
    for b in by_bytes(batches, column, most):
        n = pa.compute.sum(pa.compute.binary_length(b.column(b.schema.get_field_index(column)))).as_py() or 0
        if held and total + n > most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
        held.append(b)
        total += n
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
