"""Exact dedup by Patricia tries.

1. Where a partition is read, rows are grouped by their whole normalised bytes, so a text that makes up a third of all
   rows leaves each partition once. The group's row with the smallest id carries the text; this is written once.
2. These owners go, by length and content hash, to partitions that insert the whole byte strings into a compressed radix
   trie. A terminal node holds the smallest identifier and its groups. When the trie outgrows its memory, its largest
   subtree goes to a file of the task and is worked through afterwards.
   (That file is the task's own: a task that is run again writes it again, and no other task reads it.)
3. Each row gets its answer by the small number of its local group (never by its text or hash: no hot key).

Null texts count as empty. Rows that repeat an id are rows of their own; only one row of a class is kept, the first with the
smallest id. Null ids come last; a class of null ids alone keeps one row. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_GAPS = re.compile(rb"[ \t-\r]{2,}|[\t-\r]")
LOCAL_BYTES = 48 << 20
TRIE_BYTES = 192 << 20


def normalise(text: bytes) -> bytes:
    return _GAPS.sub(b" ", text)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class RadixTrie:
    """Compressed radix trie of byte strings. ``insert`` gives the number of the string's terminal node."""

    def __init__(self):
        self.root: list = [b"", {}, -1]  # label, children by first byte, terminal
        self.n = self.held = 0

    def insert(self, s: bytes) -> int:
        node, at = self.root, 0
        while at < len(s):
            child = node[1].get(s[at])
            if child is None:
                node[1][s[at]] = [s[at:], {}, self.n]
                self.held += len(s) - at + 300
                self.n += 1
                return self.n - 1
            label = child[0]
            if s.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = common_prefix(label, s[at : at + len(label)])
            upper = [label[:k], {label[k]: child}, -1]
            child[0] = label[k:]
            node[1][s[at]] = upper
            self.held += 300
            node, at = upper, at + k
        if node[2] < 0:
            node[2] = self.n
            self.n += 1
        return node[2]

    def branch(self) -> int:
        """How many bytes all strings share: where the subtrees part."""
        node, at = self.root, 0
        while node[2] < 0 and len(node[1]) == 1:
            node = next(iter(node[1].values()))
            at += len(node[0])
        return at


def smaller(a, b) -> bool:
    return a is not None and (b is None or a < b)


class Owners:
    """Classes of equal strings: adds (text, group, id, rows) and gives (group, smallest id, rows of the class, first group with it)."""

    def __init__(self, budget: int = TRIE_BYTES):
        self.budget, self.depth = budget, -1
        self.trie, self.classes, self.texts = RadixTrie(), [], []
        self.spilled: dict[int, object] = {}

    def _part(self, s: bytes) -> int:
        return s[self.depth] if len(s) > self.depth else -1

    def add(self, s: bytes, group: int, i, n: int) -> None:
        if self.spilled and (file := self.spilled.get(self._part(s))) is not None:
            pickle.dump((s, group, i, n), file)
            return
        t = self.trie.insert(s)
        if t == len(self.classes):
            self.classes.append([i, n, group, [group]])
            self.texts.append(s)
            self.trie.held += len(s)
        else:
            c = self.classes[t]
            if smaller(i, c[0]):
                c[0], c[2] = i, group
            c[1] += n
            c[3].append(group)
        if self.trie.held > self.budget and len(self.classes) > 1:
            self._spill()

    def _spill(self) -> None:
        """The largest subtree goes to a file; what comes later for it follows."""
        if self.depth < 0:
            self.depth = self.trie.branch()
        sizes: dict[int, int] = {}
        for s in self.texts:
            sizes[p] = sizes.get(p := self._part(s), 0) + len(s)
        big = max(sizes, key=sizes.get)
        file = self.spilled[big] = tempfile.TemporaryFile()
        kept, self.trie = [], RadixTrie()
        for s, c in zip(self.texts, self.classes, strict=True):
            if self._part(s) == big:
                pickle.dump((s, c[2], c[0], c[1] if len(c[3]) == 1 else (c[1], c[3])), file)
            else:
                self.trie.insert(s)
                self.trie.held += len(s)
                kept.append((s, c))
        self.texts, self.classes = [s for s, _ in kept], [c for _, c in kept]

    def results(self) -> Iterator[tuple]:
        for i, n, first, groups in self.classes:
            for g in groups:
                yield g, i, n, g == first
        self.trie, self.classes, self.texts = RadixTrie(), [], []
        for file in self.spilled.values():
            file.seek(0)
            rest = Owners(self.budget)
            while True:
                try:
                    s, group, i, n = pickle.load(file)
                except EOFError:
                    break
                if isinstance(n, tuple):
                    rest.add(s, group, i, n[0])
                    c = rest.find(s)
                    if c is not None:
                        c[3] += [g for g in n[1] if g != group]
                    else:  # it went on to a file at once
                        for g in n[1]:
                            if g != group:
                                rest.add(s, g, i, 0)
                else:
                    rest.add(s, group, i, n)
            file.close()
            yield from rest.results()

    def find(self, s: bytes):
        if self.spilled and self._part(s) in self.spilled:
            return None
        return self.classes[self.trie.insert(s)]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: bool = False) -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256 of each row; with ``hashes`` also text_hash, which tells rows of one id apart (xxhash64 of the text as it is)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        names = ["id", "grp", "own", "n", "sha", "text", "h"]
        groups: dict[bytes, tuple[list, list]] = {}
        held = made = 0
        kinds = None

        def flush():
            nonlocal made
            cols: list[list] = [[] for _ in names]
            for text, (ids, marks) in groups.items():
                least = min((i for i in ids if i is not None), default=None)
                owner = ids.index(least)
                sha = hashlib.sha256(text).hexdigest()
                for k, (i, h) in enumerate(zip(ids, marks, strict=True)):
                    for c, v in zip(cols, (i, base + made, k == owner, len(ids) if k == owner else 0, sha if k == owner else None, text if k == owner else None, h), strict=True):
                        c.append(v)
                made += 1
                if len(cols[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
                    cols = [[] for _ in names]
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
            groups.clear()

        for b in batches:
            kinds = [b.column(0).type, pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary(), pa.int64()]
            for i, t, h in zip(b.column(0).to_pylist(), pa.compute.fill_null(b.column(1), "").cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                s = normalise(t)
                if s not in groups:
                    groups[s] = ([], [])
                    held += len(s) + 300
                groups[s][0].append(i)
                groups[s][1].append(h)
                held += 16
                if held > LOCAL_BYTES:
                    yield from flush()
                    held = 0
        if groups:
            yield from flush()

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, id_type = Owners(), None
        for b in batches:
            id_type = b.column(1).type
            for row in zip(b.column(3).to_pylist(), b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found.add(*row)
        rows: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), id_type, pa.int64(), pa.bool_()], strict=True)], ["grp", "keep_id", "group_size", "first"])

        for r in found.results():
            rows.append(r)
            if len(rows) >= 50_000:
                yield batch()
                rows = []
        if rows:
            yield batch()

    rows = common.written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")).mapInArrow(local, f"id {kind}, grp long, own boolean, n long, sha string, text binary, h long"), "exact")
    own = rows.where("own").select("grp", "id", "n", "text")
    classes = own.repartition(F.length("text"), F.xxhash64("text")).select("grp", "id", "n", "text").mapInArrow(owners, f"grp long, keep_id {kind}, group_size long, first boolean")
    classes = classes.join(rows.where("own").select("grp", "sha"), "grp")
    mark = [F.col("h").alias("text_hash")] * hashes
    return rows.select("id", "grp", "own", "h").join(classes, "grp").select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("own") & F.col("first")).alias("kept"), F.col("sha").alias("text_sha256"), *mark)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(common.table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
