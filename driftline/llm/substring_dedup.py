"""Substring dedup by MinHash banding of paragraphs.

Paragraphs are cut where the content says so, as a shared passage may stand anywhere in a line: before a word whose three-word hash is the strict
least among RADIUS words on either side. So inside a passage the same paragraphs arise in every document that has it.

1. Each paragraph's five-word shingles give one MinHash value a band; ``bands_for`` tunes the number of bands (of one row each)
   to the recall that is asked for at the threshold. 3 bands find 99 % at 0.8, and equal paragraphs always.
2. Paragraphs that collide in a band are made again from the whole texts; those with the same shingle set are one content from there on.
   Every two contents that collide in a band and have a Jaccard similarity of the threshold or more end in one cluster: no bucket is capped.
   Two such sets share one of their first n/5 + 1 shingles in any common order (here rarest first), so a bucket falls into regions by
   these. Each content is compared with its regions' most central one; components follow; in regions that are not one component
   the pairs of different components are compared, unless their sizes or what is left of both sets from that shingle on rule it out.
3. Components of the links are clusters. The first place (document, paragraph) of a cluster stays; in other documents
   the paragraph is to be removed, where such paragraphs in a row have at least MIN_WORDS words. Repeats inside one document stay.

Null texts, texts without words and null ids take no part. Rows that repeat an id are one document: repeats among them stay, and each
row has spans of its own, told apart by a hash of its text (``text_hash``); rows that are the same in both share them. No rows give no rows.
Spans are byte offsets in the UTF-8 text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, graph, words

RADIUS = 5
K = 5
MIN_WORDS = 12
RECALL = 0.99
_TOP = np.uint64(2**64 - 1)


def bands_for(threshold: float, recall: float = RECALL) -> int:
    """Bands of one row that find pairs of that similarity with that probability: 1 - (1 - threshold)^bands >= recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold) - 1e-9))


def starts(w: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """First words of the paragraphs of a text, given its word hashes."""
    n = len(w)
    if n <= radius:
        return np.zeros(min(n, 1), np.int64)
    h = w * words.PLACES[20]
    h[: n - 1] += w[1:] * words.PLACES[21]
    h[: n - 2] += w[2:] * words.PLACES[22]
    h = words.mix(h)
    pad = np.concatenate([np.full(radius, _TOP), h, np.full(radius, _TOP)])
    before = np.lib.stride_tricks.sliding_window_view(pad[: n + radius - 1], radius).min(axis=1)
    after = np.lib.stride_tricks.sliding_window_view(pad[radius + 1 :], radius).min(axis=1)
    at = np.flatnonzero((h < before) & (h < after))
    return at if len(at) and at[0] == 0 else np.concatenate([[0], at])


def signatures(w: np.ndarray, at: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(paragraph, shingles in it, a key for each band) of the paragraphs with K words or more."""
    n = len(w)
    if n < K:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, bands), np.uint64)
    ends = np.append(at[1:], n)
    fit = np.flatnonzero(ends - at >= K)
    s = words.shingles(w, K)
    inside = np.repeat(ends, ends - at)[: len(s)] >= np.arange(len(s)) + K
    keys = np.empty((len(fit), bands), np.uint64)
    for b in range(bands):
        v = np.where(inside, words.mix(s ^ words.PLACES[30 + b]), _TOP)
        keys[:, b] = np.minimum.reduceat(v, at[at < len(s)])[np.searchsorted(at[at < len(s)], at[fit])]
    return fit, (ends - at)[fit] - K + 1, keys


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, h (a hash of the text) and text of the rows with an id."""
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))


def _paragraphs(docs: DataFrame, id_col: str, text_col: str, bands: int) -> DataFrame:
    """id, h and, as lists, a key for each band and the paragraph that has it. The key of band i is moved by i, so that a value does not meet the same value in another band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = np.arange(bands, dtype=np.uint64)
        for b in common.by_bytes(batches, "text", 8 << 20):
            seg, keys = [], []
            for w in words.of_texts(b.column(2)):
                f, _, k = signatures(w, starts(w), bands)
                seg.append(np.repeat(f, bands).astype(np.int32))
                keys.append((k ^ moved).ravel().view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(seg, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))], ["id", "h", "seg", "key"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "id long, h long, seg array<int>, key array<long>")


def _sets(asked: DataFrame, docs: DataFrame, id_col: str, text_col: str, bands: int) -> DataFrame:
    """id, h, seg, n_words, start, end, node (a hash of the shingle set), its size n, keys and shingles of the paragraphs (id, h, segs) asked for."""
    # hinted, so that the plan is the same at every size
    rows = asked.hint("merge").join(_rows(docs, id_col, text_col), ["id", "h"]).select("id", "segs", "text", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "h", "seg", "n_words", "start", "end", "node", "n", "keys", "shingles"]
        for b in common.by_bytes(batches, "text", 2 << 20):
            ids, marks, col = b.column(0).to_numpy(), b.column(3).to_numpy(), b.column(2)
            parts: list[list[np.ndarray]] = [[] for _ in range(8)]
            for lo, hi, raw, off in words.blocks(col):
                h, w0, w1, first = words.word_hashes(raw, off)
                for i in range(lo, hi):
                    a, z = int(first[i - lo]), int(first[i - lo + 1])
                    w = h[a:z]
                    at = starts(w)
                    seg = np.sort(b.column(1)[i].values.to_numpy())
                    p, q = at[seg], np.append(at[1:], len(w))[seg]
                    size = q - p - K + 1
                    s = words.shingles(w, K)
                    pick = np.arange(size.sum()) + np.repeat(p - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                    for c, v in zip(parts, (np.full(len(seg), ids[i]), np.full(len(seg), marks[i]), seg, q - p, w0[a + p] - off[i - lo], w1[a + q - 1] - off[i - lo], size, s[pick].view(np.int64)), strict=True):
                        c.append(v)
            if parts[0]:
                one, mark, seg, n, start, end, size, flat = (np.concatenate(c) for c in parts)
                which, flat = np.repeat(np.arange(len(size)), size), flat.view(np.uint64)
                order = np.lexsort((flat, which))
                flat = flat[order]
                new = np.concatenate([[True], (flat[1:] != flat[:-1]) | (which[1:] != which[:-1])])
                flat, size = flat[new], np.bincount(which[new], minlength=len(size))
                first = np.cumsum(size) - size
                node = words.mix(np.add.reduceat(words.mix(flat ^ words.PLACES[29]), first) + size.astype(np.uint64))
                # the key of band i is moved by i, so that a value does not meet the same value in another band
                keys = np.stack([np.minimum.reduceat(words.mix(flat ^ words.PLACES[30 + i]), first) ^ np.uint64(i) for i in range(bands)], axis=1)
                lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(mark), pa.array(seg.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(start), pa.array(end), pa.array(node.view(np.int64)), pa.array(size.astype(np.int32)), lists(np.arange(len(size) + 1) * bands, keys.ravel()), lists(np.append(first, len(flat)), flat)], names)

    return rows.mapInArrow(run, "id long, h long, seg int, n_words int, start long, end long, node long, n int, keys array<long>, shingles array<long>")


def _compare(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of the pairs (a, b) of nodes those that link."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(of("a").hint("merge"), "a").join(of("b").hint("merge"), "b").where(both * den >= (F.size("sa") + F.size("sb") - both) * num).select("a", "b")


def _links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) of nodes whose components are those of all pairs that share a key and link."""
    nodes = sets.groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    spots = nodes.select("node", "n", F.explode(F.array_distinct("keys")).alias("key"))
    # two sets of one size n have at most n - 1 in common
    alike = (F.col("n") - 1) * (num + den) >= 2 * num * F.col("n")
    able = F.count("n").alias("m"), F.min("n").alias("n0"), F.max("n").alias("n1"), F.max(alike).alias("alike")
    full = spots.groupBy("key").agg(*able).where("m > 1 and (alike or n0 < n1)").select("key")
    spots = common.written(spots.join(full.hint("merge"), "key"), "spots")
    sets = sets.select("node", "n", "shingles").join(spots.select("node").distinct().hint("merge"), "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    sets = common.written(sets, "contents")
    one = sets.select("node", "n", F.explode("shingles").alias("pivot"))
    rare = one.groupBy("pivot").agg(F.count("node").alias("c"))
    near = F.col("n") - F.ceil(F.col("n") * num / F.lit(den)).cast("int") + 1
    order = one.join(rare.hint("merge"), "pivot").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "pivot"))).alias("order"))
    pivots = order.select("node", F.posexplode(F.slice("order", F.lit(1), near)).alias("at", "p")).select("node", "at", "p.pivot")
    # left: how many shingles of the set come from this pivot on
    met = spots.join(pivots.hint("merge"), "node").select("key", "pivot", "node", "n", (F.col("n") - F.col("at")).alias("left"))
    full = met.groupBy("key", "pivot").agg(*able).where("m > 1 and (alike or n0 < n1)").select("key", "pivot", "m")
    met = common.written(met.join(full.hint("merge"), ["key", "pivot"]), "met")
    central = met.groupBy("node").agg(F.sum("m").alias("degree"))
    lead = met.join(central.hint("merge"), "node").groupBy("key", "pivot").agg(F.max_by(F.struct("node", "n"), F.struct("degree", "node")).alias("l"))
    size = lambda x, y: (F.least(x, y) * den >= F.greatest(x, y) * num) & ((x != y) | ((x - 1) * (num + den) >= 2 * num * x))
    asked = met.join(lead.hint("merge"), ["key", "pivot"]).where((F.col("node") != F.col("l.node")) & size(F.col("n"), F.col("l.n")))
    pair = F.greatest("node", "l.node").alias("a"), F.least("node", "l.node").alias("b")
    told = common.written(asked.select(*pair).distinct(), "told")
    links = common.written(_compare(told, sets, num, den), "links")
    comp = graph.components(links)
    here = met.join(comp.hint("merge"), "node", "left").select("key", "pivot", "node", "n", "left", F.coalesce("comp", "node").alias("comp"))
    open_ = here.groupBy("key", "pivot").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key", "pivot")
    here = common.written(here.join(open_.hint("merge"), ["key", "pivot"]), "open")
    # a set of n and a larger or equal one of m: n >= num / den * m, and min(left, left) * (num + den) >= num * (n + m)
    most = F.floor(F.col("left") * (num + den) / F.lit(num)).cast("int") - F.col("n")
    small = F.least(F.floor(F.col("n") * den / F.lit(num)).cast("int"), most)
    large = F.ceil(F.col("n") * num / F.lit(den)).cast("int")
    x = here.where(small >= F.col("n")).select("key", "pivot", "n", F.explode(F.sequence("n", small)).alias("m"), F.col("node").alias("x"), F.col("comp").alias("xc"))
    y = here.where(F.least("n", most) >= large).select("key", "pivot", F.explode(F.sequence(large, F.least("n", most))).alias("n"), F.col("n").alias("m"), F.col("node").alias("y"), F.col("comp").alias("yc"))
    pairs = x.join(y.hint("merge"), ["key", "pivot", "n", "m"]).where((F.col("xc") != F.col("yc")) & size(F.col("n"), F.col("m")))
    pairs = common.written(pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct().join(told.hint("merge"), ["a", "b"], "left_anti"), "pairs")
    common.forget(spots, met, here)
    return common.written(links.unionByName(_compare(pairs, sets, num, den)), "links")


def clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4, den: int = 5, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """The colliding paragraphs (``_sets``), and the cluster (comp) of each of their contents (node) that links with another."""
    bands = bands_for(num / den, recall)
    base = common.written(_paragraphs(docs, id_col, text_col, bands), "paragraphs")
    spots = base.select("id", "h", F.explode(F.arrays_zip("seg", "key")).alias("p")).select("p.key", "id", "h", "p.seg")
    # numbers only, so that Spark can sum up in hash tables
    full = spots.groupBy("key").agg(F.count("id").alias("m")).where("m > 1").select("key")
    asked = common.written(spots.join(full.hint("merge"), "key").groupBy("id", "h").agg(F.collect_set("seg").alias("segs")), "asked")
    common.forget(base)
    sets = common.written(_sets(asked, docs, id_col, text_col, bands), "sets")
    comp = common.written(graph.components(_links(sets, num, den)), "components")
    return sets, comp


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4, den: int = 5, recall: float = RECALL, min_words: int = MIN_WORDS) -> DataFrame:
    """id, text_hash, start, end, n_words, n_paragraphs, keep_id of each span to be removed; keep_id is where its first paragraph stays."""
    sets, comp = clusters(docs, id_col, text_col, num, den, recall)
    places = sets.select("id", "h", "seg", "n_words", "start", "end", "node").join(comp.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    keep = places.groupBy("comp").agg(F.min("id").alias("keep_id"), F.max("id").alias("last")).where("keep_id < last").drop("last")
    gone = places.join(keep.hint("merge"), "comp").where("id <> keep_id").groupBy("id", "h", "seg").agg(F.first("n_words").alias("n_words"), F.first("start").alias("start"), F.first("end").alias("end"), F.min("keep_id").alias("keep_id"))
    run = F.col("seg") - F.row_number().over(Window.partitionBy("id", "h").orderBy("seg"))
    spans = gone.withColumn("run", run).groupBy("id", "h", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"), F.count("seg").alias("n_paragraphs"), F.min_by("keep_id", "seg").alias("keep_id"))
    return spans.where(F.col("n_words") >= min_words).select(F.col("id").alias(id_col), F.col("h").alias("text_hash"), "start", "end", "n_words", "n_paragraphs", "keep_id")


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of the texts; rows left without a word that had one are dropped."""
    new = ["_cuts", "_cut_id", "_cut_hash"]
    while set(new) & set(docs.columns):
        new = [f"{c}_" for c in new]
    cuts_col, cut_id, cut_hash = new
    cuts = spans.groupBy(F.col(id_col).alias(cut_id), F.col("text_hash").alias(cut_hash)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts_col))
    rest = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, keep = [], []
            for t, c in zip(b.column(len(rest)).cast(pa.binary()).to_pylist(), b.column(len(rest) + 1).to_pylist(), strict=True):
                keep.append(True)
                if c and t is not None:
                    edges = [0, *(e for s in c for e in (s["start"], s["end"])), len(t)]
                    t = b"".join([t[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)])
                    keep[-1] = bool(t.strip())
                texts.append(t)
            out = pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(rest))), pa.array(texts, pa.binary()).cast(pa.string())], [*rest, text_col])
            yield out.filter(pa.array(keep, pa.bool_()))

    # hinted, so that the plan is the same at every size
    mine = (docs[id_col] == F.col(cut_id)) & (F.xxhash64(docs[text_col]) == F.col(cut_hash))
    joined = docs.join(cuts.hint("merge"), mine, "left").select(*rest, text_col, cuts_col)
    return joined.mapInArrow(run, docs.select(*rest, text_col).schema).select(*docs.columns)


def op9_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(common.table(spark, sf_dir, "documents")).drop("text_hash")
