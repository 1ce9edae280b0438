"""Files of any file system that Spark can reach, by Hadoop's own classes: paths on local disks, HDFS and object stores alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is it a folder, size) of what is in a folder; nothing if it isn't there."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_tail(spark: SparkSession, path: str, n: int) -> bytes:
    """The last ``n`` bytes of a file."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        stream.seek(max(0, fs.getFileStatus(p).getLen() - n))
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


class Writer:
    """A text file that comes into place in one step when it is closed without an error."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __enter__(self):
        self.fs, self.part = _at(self.spark, f"{self.path}.part")
        self.stream = self.fs.create(self.part, True)
        return self

    def write(self, text: str) -> None:
        self.stream.write(bytearray(text.encode("utf-8")))

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is not None:
            self.fs.delete(self.part, False)
            return
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        target = self.fs.makeQualified(jvm.org.apache.hadoop.fs.Path(self.path))
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(self.fs.makeQualified(self.part), target, over)
        # on local disks Hadoop keeps a checksum beside; without it others may edit the file
        self.fs.delete(jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.crc"), False)


def replace(spark: SparkSession, path: str, text: str) -> None:
    with Writer(spark, path) as f:
        f.write(text)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file that must not be there yet; False if it is."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception as e:  # py4j wraps what Java throws
        if "AlreadyExists" in str(e):
            return False
        raise
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    return True


def age_s(spark: SparkSession, path: str) -> float:
    """Seconds since a file was last written."""
    import time

    fs, p = _at(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000
