"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the characters cuts each text where the content says so; so documents that share a passage share
its chunks.

1. Every text is cut, and its chunks' digests (128 bits) are counted over all documents: numbers only.
2. Chunks that occur more than once are gathered by digest, each encoded once, and written with its ids. A table of BITS bits over the
   shared digests (fixed size; a chance hit only gathers a chunk in vain) tells the scan which chunks to send.
3. Each document gets the ids of its shared chunks (a join by a hash of its whole text, which tells equal texts' lists apart from nothing
   else) and encodes only the others itself. Tokens next to a cut can differ from those of the whole text: each join is
   re-encoded between a safe boundary of the left chunk and one of the right chunk, and widened until the ids at both outer edges
   agree with what the chunks had; then the ids are those of the whole text exactly.

``report`` counts what is encoded and what is reused. Null texts count as empty; ids may be null or repeat; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common

WINDOW = 32
MEAN = 512
LEAST, MOST = 128, 8192
CACHE_CHARS = 16 << 20
BITS = 1 << 24
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _PRIME, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(WINDOW)[::-1].copy()


def rolling(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2^64 of each window of WINDOW characters."""
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    out = np.zeros(len(mixed) - WINDOW + 1, np.uint64)
    for j in range(WINDOW):
        out += mixed[j : j + len(out)] * _POW[j]
    out ^= out >> np.uint64(31)
    return out


def cuts(text: str) -> list[int]:
    """Ends of the chunks of ``text``."""
    n = len(text)
    if n <= LEAST:
        return [n]
    h = rolling(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    ends, last = [], 0
    for e in (np.flatnonzero((h & np.uint64(MEAN - 1)) == 0) + WINDOW).tolist():
        while e - last > MOST:
            last += MOST
            ends.append(last)
        if e - last >= LEAST and n - e >= LEAST:
            ends.append(e)
            last = e
    while n - last > MOST:
        last += MOST
        ends.append(last)
    return [*ends, n]


def chunks(text: str) -> list[str]:
    ends = cuts(text) if text else []
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def digest(chunk: str) -> bytes:
    return xxhash.xxh3_128_digest(chunk.encode("utf-8", "surrogatepass"))


def id_type(coder: bpe.Bpe) -> str:
    """Two bytes an id where the vocabulary allows."""
    return "<u2" if len(coder.names) <= 1 << 16 else "<u4"


def bit(d: bytes) -> int:
    """The place of a digest in the table of bits: Spark's xxhash64 modulo BITS."""
    return xxhash.xxh64_intdigest(d, 42) % BITS


def _safe_right(text: str, k: int) -> int:
    """The k-th safe boundary of ``text``, or -1."""
    at = 0
    for _ in range(k):
        m = bpe.SAFE.search(text, at + 1)
        if m is None:
            return -1
        at = m.start()
    return at


def _safe_left(text: str, k: int) -> int:
    """The k-th safe boundary from the end, or -1."""
    at = len(text)
    for _ in range(k):
        while True:
            at = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at))
            if at <= 0:
                return -1
            if not text[at - 1].isspace():
                break
    return at


class ChunkCoder:
    """Encodes texts by chunks, with a cache bounded by characters."""

    def __init__(self, path: str, cache_chars: int = CACHE_CHARS):
        self.bpe = bpe.load(path)
        self.cache: OrderedDict[str, list[int]] = OrderedDict()
        self.left = cache_chars
        self.given: dict[bytes, bytes] = {}
        self.hits = self.misses = 0

    def chunk(self, text: str) -> list[int]:
        """Ids of a chunk: those that came with the document, else those of its last encoding here."""
        if self.given and (ready := self.given.get(digest(text))) is not None:
            self.hits += 1
            return np.frombuffer(ready, id_type(self.bpe)).tolist()
        ids = self.cache.get(text)
        if ids is not None:
            self.hits += 1
            self.cache.move_to_end(text)
            return ids
        self.misses += 1
        ids = self.cache[text] = self.bpe.encode(text)
        self.left -= len(text)
        while self.left < 0 and len(self.cache) > 1:
            self.left += len(self.cache.popitem(last=False)[0])
        return ids

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """Ids of ``left + right``. Both have their own ids already."""
        k = 2
        while True:
            a, b = _safe_left(left, k), _safe_right(right, k)
            if a < 0 or b < 0:
                return self.bpe.encode(left + right)
            outer, inner = self.bpe.encode(left[a:]), self.bpe.encode(right[:b])
            mid = self.bpe.encode(left[a:] + right[:b])
            first = self.bpe.encode(left[a : _safe_left(left, k - 1)])
            last = self.bpe.encode(right[_safe_right(right, k - 1) : b])
            agree = left_ids[len(left_ids) - len(outer) :] == outer and right_ids[: len(inner)] == inner and mid[: len(first)] == first and mid[len(mid) - len(last) :] == last
            if agree:
                return left_ids[: len(left_ids) - len(outer)] + mid + right_ids[len(inner) :]
            k *= 2

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. Added tokens stand for themselves and no token reaches over them: what lies between is encoded by chunks."""
        ids: list[int] = []
        for part, own in self.bpe.parts(text):
            ids += [own] if own is not None else self.plain(part)
        return ids

    def plain(self, text: str) -> list[int]:
        parts = chunks(text)
        if len(parts) < 2:
            return self.chunk(text) if text else []
        ids: list[int] = []
        open_text, open_ids = parts[0], self.chunk(parts[0])
        for part in parts[1:]:
            own = self.chunk(part)
            b = _safe_right(part, 4)
            if b < 0:
                open_ids, open_text = self.join(open_text, open_ids, part, own), open_text + part
                continue
            # what stands before the right chunk's fourth safe boundary is settled now; the rest stays open
            head = self.bpe.encode(part[:b])
            ids += self.join(open_text, open_ids, part[:b], head)
            open_text, open_ids = part[b:], own[len(head) :]
        return ids + open_ids


def _found(src: DataFrame, path: str) -> DataFrame:
    """h and digest of every chunk of the texts (h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(path)
        for b in common.by_bytes(batches, "text", 4 << 20):
            h, d = [], []
            for own, t in zip(b.column(0).to_pylist(), pa.compute.fill_null(b.column(1), "").to_pylist(), strict=True):
                got = [digest(c) for part, added in coder.parts(t) if added is None for c in chunks(part)]
                h += [own] * len(got)
                d += got
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(d, pa.binary())], ["h", "digest"])

    return src.select("h", "text").mapInArrow(run, "h long, digest binary")


def _bitmap(shared: DataFrame) -> bytes:
    """BITS bits, those of the shared digests set: of fixed size."""
    bit_ = F.pmod(F.xxhash64("digest"), F.lit(BITS)) + 1
    number, place = F.bitmap_bucket_number(bit_), F.bitmap_bit_position(bit_)
    rows = shared.groupBy(number.alias("k")).agg(F.bitmap_construct_agg(place).alias("bits")).collect()
    out = bytearray(BITS // 8)
    for r in rows:
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = r["bits"]
    return bytes(out)


def shared_ids(src: DataFrame, path: str) -> DataFrame:
    """Of the texts (h, text): h with the digests and ids of its chunks that occur more than once."""
    found = common.written(_found(src, path), "chunks")
    shared = found.groupBy("digest").agg(F.count("h").alias("n")).where("n > 1")
    bits = src.sparkSession.sparkContext.broadcast(_bitmap(shared))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, sent = bpe.load(path), bits.value, set()
        for b in common.by_bytes(batches, "text", 4 << 20):
            out: dict[bytes, str] = {}
            for t in pa.compute.fill_null(b.column(0), "").to_pylist():
                for part, added in coder.parts(t):
                    for c in chunks(part) if added is None else []:
                        d = digest(c)
                        if held[(k := bit(d)) >> 3] >> (k & 7) & 1 and d not in sent:
                            out[d] = c
            sent = sent | out.keys() if len(sent) < 1 << 20 else set(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.string())], ["digest", "chunk"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(path)
        for b in common.by_bytes(batches, "chunk", 4 << 20):
            ids = [np.array(coder.encode(c), id_type(coder)).tobytes() for c in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["digest", "ids"])

    once = src.select("text").mapInArrow(gather, "digest binary, chunk string").groupBy("digest").agg(F.first("chunk").alias("chunk"))
    ids = common.written(once.mapInArrow(encode, "digest binary, ids binary"), "ids")
    # a chunk may be in a third of all texts: both sides are plain exchanges, so Spark may split it
    use = found.select("h", "digest").distinct().join(ids.hint("merge"), "digest")
    given = common.written(use.groupBy("h").agg(F.collect_list(F.struct("digest", "ids")).alias("given")), "given")
    common.forget(found, ids)
    return given


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("h"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> dict[str, int]:
    """chunks: how many there are in all texts; distinct: how many of them differ; shared: those that occur more than once, encoded once each."""
    found = _found(_source(docs, id_col, text_col), path or bpe.default_path()).groupBy("digest").agg(F.count("h").alias("n"))
    r = found.agg(F.sum("n").alias("chunks"), F.count("n").alias("distinct"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("shared")).first()
    return {k: v or 0 for k, v in r.asDict().items()}


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of each row; with ``keep_ids`` also ids (array) and decoded (text)."""
    path = path or bpe.default_path()
    kind = docs.schema[id_col].dataType.simpleString()
    src = _source(docs, id_col, text_col)
    given = shared_ids(src, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkCoder(path)
        names = coder.bpe.names
        for b in common.by_bytes(batches, "text", 4 << 20):
            n, ids_sha, text_sha, all_ids, texts = [], [], [], [], []
            for t, own in zip(pa.compute.fill_null(b.column(1), "").to_pylist(), b.column(2).to_pylist(), strict=True):
                coder.given = {g["digest"]: g["ids"] for g in own or []}
                ids = coder.encode(t)
                back = coder.bpe.decode_bytes(ids)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(back).hexdigest())
                if keep_ids:
                    all_ids.append(ids)
                    texts.append(back.decode())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if keep_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])

    # hinted, so that the plan is the same at every size; both sides are plain exchanges, so Spark may split a text that many rows have
    rows = src.join(given.hint("merge"), "h", "left").select("id", "text", "given")
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids)


def op1_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(common.table(spark, sf_dir, "documents"))
