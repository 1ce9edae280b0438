"""A data source for history files in the PBF format: ``spark.read.format("history_pbf").load(path)``.

The file is cut at its blobs: the driver reads only their headers, and each task decodes some of them. Entities can be chosen with
the option ``kinds`` (node,way,relation); blobs are decoded with zlib and a small reader of protocol buffers.
"""

from __future__ import annotations

import datetime as dt
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "type string, id long, version int, visible boolean, ts timestamp, uid long, user string, lat double, lon double, tags array<struct<k:string,v:string>>, refs array<long>"
BLOBS = 16


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = buf[at]
        at += 1
        out |= (b & 127) << shift
        if b < 128:
            return out, at
        shift += 7


def fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message."""
    at = 0
    while at < len(buf):
        key, at = _varint(buf, at)
        if key & 7 == 0:
            value, at = _varint(buf, at)
        elif key & 7 == 2:
            n, at = _varint(buf, at)
            value, at = buf[at : at + n], at + n
        elif key & 7 == 1:
            value, at = buf[at : at + 8], at + 8
        else:
            value, at = buf[at : at + 4], at + 4
        yield key >> 3, value


def packed(buf: bytes) -> list[int]:
    out, at = [], 0
    while at < len(buf):
        v, at = _varint(buf, at)
        out.append(v)
    return out


def signed(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def _int32(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def running(values: list[int]) -> list[int]:
    """Values of zigzag differences."""
    out, total = [], 0
    for v in values:
        total += signed(v)
        out.append(total)
    return out


def blobs(f) -> Iterator[tuple[str, int, int]]:
    """(type, offset, size) of each blob of an open file."""
    while head := f.read(4):
        header = dict(fields(f.read(struct.unpack(">I", head)[0])))
        size = header[3]
        yield header[1].decode(), f.tell(), size
        f.seek(size, 1)


def unpacked(blob: bytes) -> bytes:
    got = dict(fields(blob))
    return got[1] if 1 in got else zlib.decompress(got[3])


class _Block:
    def __init__(self, raw: bytes):
        self.groups, self.strings, self.grain, self.lat0, self.lon0, self.date = [], [], 100, 0, 0, 1000
        for n, v in fields(raw):
            if n == 1:
                self.strings = [s.decode() for k, s in fields(v) if k == 1]
            elif n == 2:
                self.groups.append(v)
            elif n == 17:
                self.grain = v
            elif n == 19:
                self.lat0 = _int32(v)
            elif n == 20:
                self.lon0 = _int32(v)
            elif n == 18:
                self.date = v

    def place(self, lat: int, lon: int) -> tuple[float, float]:
        return (self.lat0 + self.grain * lat) / 1e9, (self.lon0 + self.grain * lon) / 1e9

    def time(self, t: int) -> dt.datetime:
        return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=t * self.date)

    def info(self, raw: bytes) -> tuple:
        got = dict(fields(raw))
        return got.get(1, 1), bool(got.get(6, 1)), self.time(_int32(got.get(2, 0))), _int32(got.get(4, 0)), self.strings[got.get(5, 0)] if self.strings else ""

    def rows(self, kinds: set[str]) -> Iterator[tuple]:
        for group in self.groups:
            for n, v in fields(group):
                if n == 2 and "node" in kinds:
                    yield from self.dense(v)
                elif n in (1, 3, 4) and (kind := {1: "node", 3: "way", 4: "relation"}[n]) in kinds:
                    yield self.single(kind, v)

    def single(self, kind: str, raw: bytes) -> tuple:
        got = dict(fields(raw))
        tags = [(self.strings[k], self.strings[v]) for k, v in zip(packed(got.get(2, b"")), packed(got.get(3, b"")), strict=True)]
        version, visible, ts, uid, user = self.info(got.get(4, b""))
        if kind == "node":
            lat, lon = self.place(signed(got.get(8, 0)), signed(got.get(9, 0))) if visible else (None, None)
            return kind, signed(got[1]), version, visible, ts, uid, user, lat, lon, tags, []
        refs = running(packed(got.get(8, b""))) if kind == "way" else []
        return kind, _int32(got[1]), version, visible, ts, uid, user, None, None, tags, refs

    def dense(self, raw: bytes) -> Iterator[tuple]:
        got = dict(fields(raw))
        ids, lats, lons, keys = running(packed(got[1])), running(packed(got[8])), running(packed(got[9])), packed(got.get(10, b""))
        info = dict(fields(got.get(5, b"")))
        n = len(ids)
        versions = packed(info.get(1, b"")) or [1] * n
        times, uids, users = (running(packed(info.get(k, b""))) or [0] * n for k in (2, 4, 5))
        seen = packed(info.get(6, b"")) or [1] * n
        at = 0
        for i in range(n):
            tags = []
            while at < len(keys) and keys[at]:
                tags.append((self.strings[keys[at]], self.strings[keys[at + 1]]))
                at += 2
            at += 1
            visible = bool(seen[i])
            lat, lon = self.place(lats[i], lons[i]) if visible else (None, None)
            yield "node", ids[i], versions[i], visible, self.time(times[i]), uids[i], self.strings[users[i]] if self.strings else "", lat, lon, tags, []


class _Part(InputPartition):
    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = spans


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].removeprefix("file://")
        self.kinds = set(options.get("kinds", "node,way,relation").split(","))

    def partitions(self):
        with open(self.path, "rb") as f:
            spans = [(at, n) for kind, at, n in blobs(f) if kind == "OSMData"]
        return [_Part(spans[i : i + BLOBS]) for i in range(0, len(spans), BLOBS)] or [_Part([])]

    def read(self, partition):
        with open(self.path, "rb") as f:
            for at, n in partition.spans:
                f.seek(at)
                yield from _Block(unpacked(f.read(n))).rows(self.kinds)


class HistoryPbf(DataSource):
    """Object versions of a history file on a folder that all executors see."""

    @classmethod
    def name(cls) -> str:
        return "history_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def register(spark) -> None:
    spark.dataSource.register(HistoryPbf)
