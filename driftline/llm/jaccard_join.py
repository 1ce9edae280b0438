"""N-gram Jaccard join in the metric space of shingle sets.

Jaccard distance and the size of the symmetric difference are both metrics. The method: documents as pivots, regions around them,
windows by the triangle inequality, and regions that are joined again until they are small.

1. Where pivots can be. Nearly all distances between unrelated texts are 1: with any document as pivot a window of 0.2 on either side copies every
   such text to every region (README has the measured copies). So a document only asks pivots that it shares a rare shingle with: as a link
   leaves at most a fifth of a set unmatched, two linked documents share one of their first n/5 + 1 shingles, rarest first. Rarity
   comes from a table of COUNTERS counts over all shingles of all documents (fixed size; any order is exact). Equal sets of a partition go
   on as one node, equal sets of different partitions are linked at once.
2. Voronoi regions. Of all documents that share a rare shingle, the one that meets most others, over all its shingles, is their pivot (a text
   is more central than its edited copies). Each document is compared in full with the pivot that it meets most often, its nearest, and
   linked if the distance allows; its distance to this pivot is kept. LEADER_ROUNDS rounds, each with pivots of other components only.
3. Windows. Two documents that share a rare shingle and are not in one component yet are a candidate pair only if three bounds allow a link, whose
   symmetric difference is at most (|x| + |y|) / 9: what is left of both sets from their first common shingle on; the distances to
   their common pivot P, as | |x ^ P| - |y ^ P| | <= |x ^ y|; and the same over PROFILE pivots that are classes of shingles by hash.
4. Recursion. Where more than LEAF documents share a shingle, the region is split by the next shingle that two of them have in common,
   and again by the one after it: of a linked pair's common shingles in order, the i-th is one of the first n/5 + i. Regions of up to LEAF documents
   are joined at once. What is still larger after LEVELS shingles in common is joined by classes of sizes that can link, which Spark may split.
   Pairs inside a component need no comparison, so no group of copies is ever expanded into its pairs.

Full comparisons run in blocks of at most BLOCK documents against one pivot, on sets made from whole texts again.

Null or empty texts have no set, link with nothing and are their own component. Rows that repeat an id are one document: it is linked
with what any of its rows is linked with. A null id has no component. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, graph, words

COUNTERS = 1 << 20
SLICES = 32
PROFILE = 32
BLOCK = 256
LEADER_ROUNDS = 2
LEAF = 2_048
LEVELS = 3


def distinct(shingles: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes."""
    s = np.sort(shingles)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def counter(shingles: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return (shingles >> np.uint64(44)).astype(np.int64) & (COUNTERS - 1)


def count_table(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """How many shingles of the corpus fall on each counter: COUNTERS numbers, whatever the data."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for _, _, raw, off in words.blocks(b.column(0)):
                h, _, _, first = words.word_hashes(raw, off)
                total += np.bincount(counter(words.runs(h, first, k)[0]), minlength=COUNTERS)
        parts = total.astype(np.uint32).reshape(SLICES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                part = np.frombuffer(c.as_buffer(), np.uint32)
                sums[s] = sums[s] + part if s in sums else part.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(v, 2**32 - 1).astype(np.uint32).tobytes() for v in sums.values()], pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    got = docs.select(text_col).mapInArrow(tally, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect()
    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for r in got:
        out[r["slice"]] = np.frombuffer(r["counts"], np.uint32)
    return out.ravel()


def _sum64(x: np.ndarray) -> int:
    return int(np.add.reduce(x).astype(np.uint64).view(np.int64)) if len(x) else 0


def regions(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """id, n (set size) and node of each row; the first row of a node in its partition (own) also has a key of the set, its text, the rarest shingles and the profile."""
    table = docs.sparkSession.sparkContext.broadcast(count_table(docs, text_col, k))
    names = ["id", "n", "node", "own", "k1", "k2", "text", "pivots", "profile"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rare = table.value
        base, nodes = TaskContext.get().partitionId() << 32, {}
        for b in common.by_bytes(batches, text_col, 8 << 20):
            rows: list[tuple] = []
            for i, t, s in zip(b.column(0).to_pylist(), b.column(1), words.shingles_of(b.column(1), k), strict=True):
                s = distinct(s)
                if not len(s) or i is None:
                    rows.append((i, len(s), None, False, None, None, None, None, None))
                    continue
                key = (len(s), _sum64(s), _sum64(words.mix(s + np.uint64(1))))
                if key in nodes:
                    rows.append((i, len(s), nodes[key], False, None, None, None, None, None))
                    continue
                nodes[key] = node = base + len(nodes)
                near = len(s) - -(-num * len(s) // den) + LEVELS
                order = np.argsort(rare[counter(s)], kind="stable")[:near]  # of equally rare ones the smaller first
                profile = np.bincount((s & np.uint64(PROFILE - 1)).astype(np.int64), minlength=PROFILE).astype(np.int32)
                rows.append((i, len(s), node, True, key[1], key[2], t.as_py(), s[order].view(np.int64), profile))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, "id long, n long, node long, own boolean, k1 long, k2 long, text string, pivots array<long>, profile array<int>")


def _able(n: Column, left: Column, other_n: Column, other_left: Column, num: int, den: int) -> Column:
    """Whether two sets can link of which at most ``left`` and ``other_left`` shingles can be common. A pair that links passes where it first meets."""
    return F.least(left, other_left) * (num + den) >= (n + other_n) * num


def compare(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with apart (how many shingles only one has) and linked; texts: node, text. Blocks hold one b and at most about BLOCK of its a's."""
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("a") / BLOCK).alias("blocks"))
    pairs = pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).alias("blk"))
    need = pairs.select(F.col("a").alias("node"), "b", "blk", F.lit(1).alias("role")).unionByName(pairs.select(F.col("b").alias("node"), "b", "blk", F.lit(0).alias("role")).distinct())
    rows = need.hint("merge").join(texts, "node").repartition("b", "blk").sortWithinPartitions("b", "blk", "role").select("node", "b", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot = None, None
        for batch in common.by_bytes(batches, "text", 8 << 20):
            out: list[list] = [[], [], [], []]
            for i, b, role, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), words.shingles_of(batch.column(3), k), strict=True):
                s = distinct(s)
                if role == 0:
                    at, pivot = b, s
                    continue
                assert at == b
                both = len(np.intersect1d(s, pivot, assume_unique=True))
                whole = len(s) + len(pivot) - both
                for c, v in zip(out, (i, b, whole - both, den * both >= num * whole), strict=True):
                    c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["a", "b", "apart", "linked"])

    return rows.mapInArrow(run, "a long, b long, apart long, linked boolean")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of the regions (key) that are not one component, with the number of their documents as m."""
    open_ = rows.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("node").alias("m")).where("c0 <> c1").select("key", "m")
    return rows.join(open_.hint("merge"), "key")


def _pairs(rows: DataFrame, num: int, den: int, classes: bool = False) -> DataFrame:
    """Pairs (a, b) of documents of different components in a region that no window rules out."""
    x, y = rows, rows
    on = F.col("x.key") == F.col("y.key")
    later = F.col("x.node") > F.col("y.node")
    if classes:  # the smaller set looks for larger ones among the classes of sizes that can link with it
        of = lambda c: F.floor(F.log(c) / math.log(1.06)).cast("int")
        most = F.least(F.floor(F.col("n") * den / F.lit(num)), F.floor(F.col("left") * (num + den) / F.lit(num)) - F.col("n"))
        x = x.withColumn("most", most).where("most >= n").withColumn("cls", F.explode(F.sequence(of(F.col("n")), of(F.col("most")))))
        y = y.withColumn("cls", of(F.col("n")))
        on = on & (F.col("x.cls") == F.col("y.cls"))
        later = (F.col("x.n") < F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & later
    x, y = x.alias("x"), y.alias("y")
    room = (F.col("x.n") + F.col("y.n")) * (den - num)
    window = F.col("x.apart").isNull() | F.col("y.apart").isNull() | (F.col("x.lead") != F.col("y.lead")) | (F.abs(F.col("x.apart") - F.col("y.apart")) * (num + den) <= room)
    apart = F.aggregate(F.zip_with("x.profile", "y.profile", lambda p, q: F.abs(p - q)), F.lit(0), lambda s, v: s + v)
    near = on & later & (F.col("x.comp") != F.col("y.comp")) & _able(F.col("x.n"), F.col("x.left"), F.col("y.n"), F.col("y.left"), num, den) & window & (apart * (num + den) <= room)
    return x.join(y, near).select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))


def _candidates(rows: DataFrame, heads: DataFrame, num: int, den: int, leaf: int) -> DataFrame:
    """Distinct pairs of all regions (rows: those of ``_sized``); regions of more than ``leaf`` documents are split by the next shingles that are common in them."""
    found, level = None, 1
    cols = ["key", "node", "n", "at", "left", "comp", "lead", "apart"]
    profiles = heads.select("node", "profile").hint("merge")
    near = F.expr(f"n - (({num} * n + {den - 1}) div {den})").cast("int")
    while True:
        here = common.written((rows if "m" in rows.columns else _sized(rows)).select(*cols, "m").join(profiles, "node"), "open")
        small = _pairs(here.where(F.col("m") <= leaf), num, den)
        found = small if found is None else found.unionByName(small)
        large = here.where(F.col("m") > leaf)
        if large.isEmpty():
            break
        if level == LEVELS:
            found = found.unionByName(_pairs(large, num, den, classes=True))
            break
        level += 1
        # of the shingles after the last common one, those up to place n/5 + level
        some = large.join(heads.select("node", "pivots").hint("merge"), "node").select(*cols, F.slice("pivots", F.col("at") + 2, F.greatest(F.lit(0), near + (level - 1) - F.col("at"))).alias("next"))
        some = some.select(*cols, F.posexplode("next").alias("j", "pivot")).withColumn("key", F.xxhash64("key", "pivot")).withColumn("at", F.col("at") + 1 + F.col("j"))
        rows = some.withColumn("left", (level - 1) + F.col("n") - F.col("at"))
    return found.distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4, den: int = 5, leaf: int = LEAF) -> DataFrame:
    """id, n_shingles, component_id of each row. Two documents link when den * |x & y| >= num * |x | y|; num/den is at least 1/2."""
    whole = common.written(regions(docs, id_col, text_col, k, num, den), "regions")
    heads = whole.where("own")
    base = common.written(whole.select("id", "n", "node"), "rows")  # read often: numbers alone are a small table
    sets = heads.select("node", "n", "k1", "k2")
    same = sets.groupBy("n", "k1", "k2").agg(F.min("node").alias("b"), F.count("node").alias("c")).where("c > 1")
    comp = common.written(sets.join(same.hint("merge"), ["n", "k1", "k2"]).select("node", F.col("b").alias("comp")), "components")
    # left: how many shingles of the document come from this one on, in the order of all
    near = F.expr(f"cast(n - (({num} * n + {den - 1}) div {den}) + 1 as int)")
    spots = heads.select("node", "n", F.posexplode(F.slice("pivots", F.lit(1), near)).alias("at", "key"))
    full = spots.groupBy("key").agg(F.count("node").alias("m")).where("m > 1")
    met = common.written(spots.join(full.hint("merge"), "key"), "met")
    central = met.groupBy("node").agg(F.sum("m").alias("degree"))
    lead = met.join(central.hint("merge"), "node").groupBy("key").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("lead"))
    led = common.written(met.join(lead.hint("merge"), "key").select("key", "node", "n", "at", (F.col("n") - F.col("at")).alias("left"), "lead"), "led")
    common.forget(met)
    met = led
    # hinted, so that the plan is the same at every size
    texts = common.written(heads.select("node", "text").join(met.select("node").distinct().hint("merge"), "node", "left_semi"), "texts")
    leads = met.where("node = lead").select("key", F.col("n").alias("lead_n"), F.col("left").alias("lead_left"))
    able = _able(F.col("n"), F.col("left"), F.col("lead_n"), F.col("lead_left"), num, den)
    often = met.where("node <> lead").join(leads.hint("merge"), "key").groupBy("node", "lead").agg(F.count(F.lit(1)).alias("c"), F.max(able).alias("able"))
    asked = common.written(often.where("able").drop("able"), "asked")
    told = None
    for _ in range(LEADER_ROUNDS):
        of = lambda c: comp.select(F.col("node").alias(c), F.col("comp").alias(f"_{c}"))  # noqa: B023, E731
        open_ = asked.join(of("node"), "node", "left").join(of("lead"), "lead", "left").where(F.coalesce("_node", "node") != F.coalesce("_lead", "lead"))
        if told is not None:
            open_ = open_.join(told.select(F.col("a").alias("node"), F.col("b").alias("lead")), ["node", "lead"], "left_anti")
        best = common.written(open_.groupBy("node").agg(F.max_by("lead", F.struct("c", -F.col("lead"))).alias("b")).withColumnRenamed("node", "a"), "best")
        new = common.written(compare(best, texts, k, num, den), "compared")
        told = new if told is None else told.unionByName(new)
        comp = _grown(comp, new.where("linked").select("a", "b"))
    here = met.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    near_pivot = told.select(F.col("a").alias("node"), F.col("b").alias("lead"), "apart").unionByName(met.where("node = lead").select("node", "lead", F.lit(0).cast("long").alias("apart")).distinct())
    here = _sized(here).join(near_pivot.hint("merge"), ["node", "lead"], "left")
    pairs = _candidates(here, heads, num, den, leaf)
    for a, b in (("a", "b"), ("b", "a")):
        pairs = pairs.join(told.select(F.col("a").alias(a), F.col("b").alias(b)), ["a", "b"], "left_anti")
    pairs = common.written(pairs, "pairs")
    common.forget(met)
    new = common.written(compare(pairs, texts, k, num, den).where("linked").select("a", "b"), "links")
    # rows that repeat an id are one document
    rep = common.written(base.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("b"), F.max("node").alias("z")).where("c > 1"), "repeated")
    again = base.join(rep.where("b <> z").select("id", "b").hint("merge"), "id").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    comp = common.written(_grown(comp, new.unionByName(again)), "components")
    least = base.where("node is not null").groupBy("node").agg(F.min("id").alias("least")).join(comp.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = common.written(least, "named")
    named = common.written(least.groupBy("comp").agg(F.min("least").alias("component_id")), "named")
    found = common.written(least.join(named.hint("merge"), "comp").select("node", "component_id"), "named")
    out = base.select("id", "n", "node").join(found.hint("merge"), "node", "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    if not rep.isEmpty():  # a row without a set, whose id has another row
        whole = common.written(out.join(rep.select("id").hint("merge"), "id", "left_semi").groupBy("id").agg(F.min("component_id").alias("whole")), "named")
        out = out.join(whole.hint("merge"), "id", "left").withColumn("component_id", F.coalesce("whole", "component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _grown(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components of those that are known and of new links."""
    return graph.components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(common.table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""
