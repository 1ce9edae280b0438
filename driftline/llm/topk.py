"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists.

1. Vectors that are alike share a block: a k-d tree over a bounded sample (SAMPLE, a parameter) deals every vector to a leaf, and leaves
   of more than CANDIDATES vectors are split by hash. A block keeps each dimension as a sorted list.
2. A query is first searched in its own block. There it reads, one after another, the lists of the dimensions in which it isn't 0, from the
   end that its sign asks for: DEPTH entries of each, then twice as many, and so on; each vector met is scored in full. It stops when the sum
   of the best values still unread falls below its k-th score (on a tie a smaller id could still win).
3. The k-th score goes along to all other blocks. Blocks whose lists' ends cannot reach it are never read: neither their vectors
   nor the query are sent there. In the others the same search starts from that score. Last, the few best of each are merged.

How much is scored depends on the data: on unit vectors that point anywhere no bound over 64 lists can stop early (README has figures);
on vectors in clusters it stops in its own block. ``report`` measures the share.

Vectors that are null or hold null or non-finite components take no part, nor do rows without id. Rows that repeat an id are
vectors of their own. Scores exist between vectors of one length only; empty vectors score 0. No rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

CANDIDATES = 16_384
QUERIES = 2_048
SAMPLE = 16_384
DEPTH = 4


def search(c: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, depth: int = DEPTH, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best k rows of ``c`` for each row of ``q`` by inner product, ties to the smaller row: (query row, candidate row, score) and the number of pairs scored.

    own: the row of ``c`` that is the query itself, or -1. floor: a score that k vectors elsewhere reach; rows below it may be left out.
    """
    n = len(c)
    most = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, c.shape[1])
    exact = (most + 1) * (n + 1) < 2**53
    kind = np.float64 if exact else object
    c, q = c.astype(kind), q.astype(kind)
    order = np.argsort(c.astype(np.float64), axis=0, kind="stable")
    lists = np.take_along_axis(c, order, axis=0)
    out_q, out_c, out_s, scored = [], [], [], 0
    for r, w in enumerate(q):
        up, down = np.flatnonzero(w > 0), np.flatnonzero(w < 0)
        least = None if floor is None or floor[r] is None else int(floor[r])
        keys, seen, at, step = np.zeros(0, kind), np.zeros(n, bool), 0, depth if len(up) + len(down) else n
        while at < n and not seen.all():
            # what a row that is in none of the parts read can reach
            bound = lists[n - 1 - at, up] @ w[up] + lists[at, down] @ w[down]
            if least is not None and bound < least or len(keys) == k and keys.min() >= (bound + 1) * n:
                break
            to = min(n, at + step)
            new = np.zeros(n, bool)
            if len(up) + len(down):
                new[order[n - to : n - at, up].ravel()] = True
                new[order[at:to, down].ravel()] = True
            else:
                new[:] = True
            new &= ~seen
            seen |= new
            rows = np.flatnonzero(new)
            rows = rows[rows != own[r]]
            scored += len(rows)
            score = c[rows] @ w
            if least is not None:
                rows, score = rows[score >= least], score[score >= least]
            keys = np.concatenate([keys, score * n + (n - 1 - rows).astype(kind)])  # a score and its row in one number
            if len(keys) > k:
                keys = -np.partition(-keys, k - 1)[:k] if exact else -np.sort(-keys)[:k]
            at, step = to, step * 2
        score = np.floor_divide(keys, n) if exact else np.array([x // n for x in keys], object)
        out_q.append(np.full(len(keys), r))
        out_c.append((n - 1 - (keys - score * n)).astype(np.int64))
        out_s.append(score.astype(np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_q]), np.concatenate([none, *out_c]), np.concatenate([none, *out_s]), scored


def threshold(c: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``search`` without its count."""
    return search(c, q, own, k, depth)[:3]


class Tree:
    """A k-d tree of ``levels`` splits at the sample's medians, each along the dimension that spreads most."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels, self.width = levels, sample.shape[1] if sample.ndim == 2 else 0
        self.dim, self.at = np.zeros(2**levels - 1, np.int64), np.zeros(2**levels - 1)
        parts = [sample]
        for node in range(2**levels - 1):
            x = parts[node]
            if len(x) and self.width:
                self.dim[node] = x.var(axis=0).argmax()
                self.at[node] = np.median(x[:, self.dim[node]])
            right = x[:, self.dim[node]] > self.at[node] if self.width else np.zeros(len(x), bool)
            parts += [x[~right], x[right]]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.levels if self.width == x.shape[1] else 0):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.dim[node]] > self.at[node])
        return node


def _matrix(col, dims: int) -> np.ndarray:
    v = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), dims)


_FOUND = "kind int, dims int, leaf long, part long, query_id long, query_copy int, vec_id long, vec_copy int, score long, lo array<long>, hi array<long>"


def _cell(k: int):
    """The search of one block's vectors (query false) for the queries that came to it (query true)."""

    def run(cell: pa.Table) -> pa.Table:
        dims = cell["dims"][0].as_py()
        v = _matrix(cell["v"], dims)
        ids, copy, query = (cell[x].to_numpy() for x in ("id", "copy", "query"))
        query = query.astype(bool)
        sort = np.lexsort((copy[~query], ids[~query]))
        cid, ccopy, c = ids[~query][sort], copy[~query][sort], v[~query][sort]
        qid, qcopy, q = ids[query], copy[query], v[query]
        floor = np.array(cell["floor"].to_pylist(), object)[query]
        where = {x: i for i, x in enumerate(zip(cid.tolist(), ccopy.tolist(), strict=True))}
        own = np.array([where.get(x, -1) for x in zip(qid.tolist(), qcopy.tolist(), strict=True)], np.int64)
        r, i, s, scored = search(c, q, own, k, floor=floor) if len(c) and len(q) else (*[np.zeros(0, np.int64)] * 3, 0)
        n = len(r)
        ends = [c.min(axis=0).tolist(), c.max(axis=0).tolist()] if len(c) and dims else [[], []]
        one = lambda name, kind: pa.array([cell[name][0].as_py()] * (n + 1), kind)
        tail = lambda x, last, kind: pa.array([*x.tolist(), last], kind)
        return pa.table({
            "kind": tail(np.zeros(n, np.int64), 1, pa.int32()), "dims": one("dims", pa.int32()), "leaf": one("leaf", pa.int64()), "part": one("part", pa.int64()),
            "query_id": tail(qid[r], None, pa.int64()), "query_copy": tail(qcopy[r], None, pa.int32()), "vec_id": tail(cid[i], None, pa.int64()), "vec_copy": tail(ccopy[i], None, pa.int32()),
            "score": tail(s, scored, pa.int64()), "lo": pa.array([None] * n + [ends[0]], pa.list_(pa.int64())), "hi": pa.array([None] * n + [ends[1]], pa.list_(pa.int64())),
        })

    return run


def _found(vectors: DataFrame, id_col: str, vec_col: str, k: int, scale: int, every: int, candidates: int, queries: int) -> DataFrame:
    """kind 0: what each search found; kind 1: a row a search with the pairs scored (score) and the ends of the block's lists."""
    x = F.col("v")
    fine = x.isNotNull() & F.col("id").isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where(fine)
    rows = rows.select("id", F.transform("v", lambda e: F.floor(e.cast("double") * scale)).alias("v"))
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("id").orderBy("v"))).withColumn("place", F.xxhash64("id", "copy"))
    rows = common.written(rows, "vectors")
    n = rows.count()
    some = [r.v for r in rows.orderBy("place").limit(SAMPLE).select("v").collect()] if n > candidates else []
    lengths = sorted(len(v) for v in some)
    width = lengths[len(lengths) // 2] if some else 0
    sample = np.array([v for v in some if len(v) == width], np.float64) if width else np.zeros((0, 0))
    tree = Tree(sample, min(12, math.ceil(math.log2(n / candidates))) if width else 0)

    def dealt(batches):
        for b in batches:
            sizes = pa.compute.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
            leaf = np.zeros(b.num_rows, np.int64)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                leaf[at] = tree.leaf(_matrix(b.column(1).take(pa.array(at)), d))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes.astype(np.int32)), pa.array(leaf)], ["id", "v", "copy", "place", "dims", "leaf"])

    dealt_rows = rows.select("id", "v", "copy", "place").mapInArrow(dealt, "id long, v array<long>, copy int, place long, dims int, leaf long")
    parts = dealt_rows.groupBy("dims", "leaf").agg(F.ceil(F.count("id") / candidates).alias("parts"))
    placed = common.written(dealt_rows.join(parts, ["dims", "leaf"]).select("id", "v", "copy", "dims", "leaf", F.pmod("place", "parts").alias("part")), "placed")
    block = ["dims", "leaf", "part"]
    sides = lambda df, query, floor: df.select(*block, "id", "copy", "v", F.lit(query).alias("query"), floor.cast("long").alias("floor"))
    asks = placed.where(F.col("id") % every == 0)
    home = sides(placed, False, F.lit(None)).unionByName(sides(asks, True, F.lit(None)))
    first = common.written(home.groupBy(*block).applyInArrow(_cell(k), _FOUND), "home")
    ends = first.where("kind = 1")
    blocks = ends.count()
    if blocks < 2:
        return first
    kth = first.where("kind = 0").groupBy("query_id", "query_copy").agg(F.min("score").alias("floor"), F.count("score").alias("had"))
    floors = kth.select(F.col("query_id").alias("id"), F.col("query_copy").alias("copy"), F.when(F.col("had") == k, F.col("floor")).alias("floor"))
    groups = max(1, -(-n // (every * queries)))
    asked = asks.withColumn("grp", F.pmod(F.xxhash64(*block), F.lit(groups))).join(floors, ["id", "copy"], "left")
    others = ends.select("dims", F.col("leaf").alias("to_leaf"), F.col("part").alias("to_part"), "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"))
    edge = F.zip_with(F.zip_with("v", "lo", lambda a, b: a * b), F.zip_with("v", "hi", lambda a, b: a * b), lambda a, b: F.greatest(a, b))
    reach = F.aggregate(edge, F.lit(0).cast("long"), lambda s, e: s + e)
    live = asked.join(others, ["dims", "grp"]).where(((F.col("leaf") != F.col("to_leaf")) | (F.col("part") != F.col("to_part"))) & (F.col("floor").isNull() | (reach >= F.col("floor"))))
    live = common.written(live.select("dims", F.col("to_leaf").alias("leaf"), F.col("to_part").alias("part"), "grp", "id", "copy", "v", "floor"), "live")
    cand = placed.join(live.select(*block, "grp").distinct(), block)
    sent = cand.select(*block, "grp", "id", "copy", "v", F.lit(False).alias("query"), F.lit(None).cast("long").alias("floor"))
    cells = sent.unionByName(live.select(*block, "grp", "id", "copy", "v", F.lit(True).alias("query"), "floor"))
    return first.unionByName(common.written(cells.groupBy(*block, "grp").applyInArrow(_cell(k), _FOUND), "others"))


def exact_top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, scale: int = 64, every: int = 20, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score for each row whose id is divisible by ``every``."""
    found = _found(vectors, id_col, vec_col, k, scale, every, candidates, queries).where("kind = 0")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_copy").orderBy(F.desc("score"), "vec_id", "vec_copy"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, scale: int = 64, every: int = 20, candidates: int = CANDIDATES, queries: int = QUERIES) -> dict[str, int]:
    """How many pairs of a query and another vector there were, and how many the search scored."""
    found = _found(vectors, id_col, vec_col, k, scale, every, candidates, queries)
    n = vectors.where(F.col(vec_col).isNotNull()).count()
    m = vectors.where(F.col(vec_col).isNotNull() & (F.col(id_col) % every == 0)).count()
    return {"pairs": m * (n - 1), "scored": found.where("kind = 1").agg(F.sum("score")).first()[0] or 0}


def op4_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(common.table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
