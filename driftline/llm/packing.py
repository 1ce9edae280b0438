"""Best-fit packing by hierarchical residual packing.

Each input partition tokenises its documents and packs their pieces by best fit (longest first; the bin with the least
sufficient residual). Bins that are nearly full are final. The rest travel on as single items, a few partitions to a
group, and are packed again by best fit, until one group is left; then whatever is open is final too.

Which underfull bins travel on is no cap but what can still be used. After best fit in one group no two of its bins fit together, so at most one
of them is filled to half or less. A merge of bins from two groups needs such a bin and leaves one fewer of them: with G groups at most
G merges are left, each into one receiver, and receivers with less room can always be replaced by unused ones with more. So
from each group the half-empty bin and the G underfull bins with most room travel; more of them could save no sequence. G shrinks by FAN_IN with
every round, and the others become sequences as they are: nothing is dropped.

Null texts count as empty and give one piece of length 1 (the end id). Ids may be null or repeat; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common

LENGTH = 2048
SLACK = 8
FAN_IN = 16


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: only the first may be shorter."""
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of indexes, longest items first, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has r left
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[i]
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask &= ~(1 << r)
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        room[r - n].append(b)
        mask |= 1 << (r - n)
    return bins


def _ranks(fills: list[int], capacity: int, slack: int) -> list[int]:
    """The place of each underfull bin by its room, most room first; -1 for those that are nearly full."""
    out = [-1] * len(fills)
    for r, i in enumerate(sorted((i for i, f in enumerate(fills) if capacity - f > slack), key=lambda i: (fills[i], i))):
        out[i] = r
    return out


_COLS = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "rank"]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH, end_id: int = 0, slack: int = SLACK, fan_in: int = FAN_IN) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    path = path or bpe.default_path()
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, bin long, offset long, rank int"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = bpe.load(path)
        base = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        id_type = None
        for b in common.by_bytes(batches, text_col, 4 << 20):
            id_type = b.column(0).type
            for d, t in zip(b.column(0).to_pylist(), pa.compute.fill_null(b.column(1), "").to_pylist(), strict=True):
                ids = np.array([*(i for p in bpe.pieces(t, 1 << 16) for i in coder.encode(p)), end_id], "<u4")
                rows += [(d, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), length))]
        if not rows:
            return
        lengths = [r[3] for r in rows]
        bins = best_fit(lengths, length)
        rank = _ranks([sum(lengths[i] for i in b) for b in bins], length, slack)
        out: list[tuple] = []
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                out.append((*rows[i], base + k, at, rank[k]))
                at += lengths[i]
        kinds = [id_type, pa.int32(), *[pa.int64()] * 5, pa.int32()]
        for s in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[s : s + 50_000], strict=True), kinds, strict=True)], _COLS)

    def merge(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [b for b in batches if b.num_rows]
            if not parts:
                return
            got = pa.Table.from_batches(parts)
            bin_of, n = got["bin"].to_numpy(), got["length"].to_numpy()
            ids, index = np.unique(bin_of, return_inverse=True)
            fill = np.bincount(index, weights=n).astype(np.int64)
            bins = best_fit(fill.tolist(), length)
            rank = [-1] * len(bins) if last else _ranks([int(fill[b].sum()) for b in bins], length, slack)
            new_bin, shift, ranks = ids.copy(), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int32)
            for k, b in enumerate(bins):
                at = 0
                for i in b:
                    new_bin[i], shift[i], ranks[i] = ids[b[0]], at, rank[k]
                    at += int(fill[i])
            cols = {"bin": pa.array(new_bin[index]), "offset": pa.array(got["offset"].to_numpy() + shift[index]), "rank": pa.array(ranks[index])}
            yield from pa.table([cols.get(c, got[c]) for c in _COLS], _COLS).to_batches()

        return run

    src = docs.select(id_col, text_col)
    level = common.written(src.mapInArrow(first, schema), "pack0")
    parts = 1 + (level.agg(F.max(F.expr("shiftright(bin, 32)")).alias("p")).first()["p"] or 0)
    done, group, width = [], 1, parts
    while True:
        travels = F.col("rank").between(0, width)  # the half-empty bin has most room
        done.append(level.where(~travels))
        group *= fan_in
        open_, width = level.where(travels), -(-parts // group)
        key = F.expr(f"shiftright(bin, 32) div {group}")
        level = common.written(open_.repartition(width, key).mapInArrow(merge(width == 1), schema), "pack")
        if width == 1:
            done.append(level)
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
