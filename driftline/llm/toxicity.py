"""Toxicity: a convolutional text classifier over hashed words, trained in numpy.

Words (lower case, ASCII punctuation taken as space) and their first PREFIXES bytes are hashed to rows of an embedding table, and
a word's vector is the sum of its rows; filters of several widths run over the whole text and each filter's largest answer goes to a logistic
layer. One dimension starts at each word's log odds, counted over all texts that are fitted.

It is trained on all labelled rows, whole texts, where they lie. They are dealt by a hash of their id into shards of about SHARD rows; in
each round every shard makes one pass of Adam from the common network, and what it has changed is averaged by rows (a word's row of the table
over the shards that have the word). Changes are summed as integers, so the order in which tasks end doesn't matter. To the driver
come sums of fixed size.

Thresholds are calibrated by language on the fifth of the ids that is not fitted, from counts of all its texts by logit in steps of 1 / STEPS. The
language comes from the text alone (which set of function words is most frequent), never from a column; the logit is shifted so that
0.5 is the language's threshold.

Scoring reads each whole text once, without a shuffle. Null and empty texts get the score of no words. Rows with a null id are scored
(held_out false). No rows give no rows; without labels of both kinds every score is the share of toxic labels, or 0.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, words

BUCKETS = 1 << 16
#: Rows of a shard, about, and passes over each.
SHARD, ROUNDS = 1_024, 6
#: Steps of a logit's unit, and the largest logit, in counts for thresholds.
STEPS, MOST = 64, 30
#: Changes are summed in units of 1 / UNIT.
UNIT = 1 << 28
#: Bits that tell which ids may have a label.
BITS = 1 << 26
PREFIXES = (4, 6)
SLOTS = 1 + len(PREFIXES)
#: Function words by language (fixed values).
FUNCTION_WORDS = {
    "en": "the of and to in is that it for on with was are this".split(),
    "fr": "le la les de des et un une du que qui pour dans est".split(),
    "de": "der die das und ist mit ein eine zu den nicht von im sich".split(),
    "es": "el los las y en que un una por con no se su del".split(),
}


def bucket_ids(col: pa.Array, buckets: int, block: int = 512 << 10) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of slices of a text column: the buckets of each word (whole, then prefixes), and the number of the first word of each text."""
    for _, _, raw, off in words.blocks(col, block):
        h, _, _, first, prefixes = words.word_hashes(raw, off, words.NO_WORD, PREFIXES)
        yield (np.stack([h, *prefixes], axis=1) >> np.uint64(20)).astype(np.int64) & (buckets - 1), first


def _language_table(buckets: int) -> np.ndarray:
    """For each bucket the languages (columns) in which it is a function word."""
    out = np.zeros((buckets, len(FUNCTION_WORDS)), np.float32)
    for k, ws in enumerate(FUNCTION_WORDS.values()):
        for ids, _ in bucket_ids(pa.array([" ".join(ws)]), buckets):
            out[ids[:, 0], k] = 1
    return out


@dataclass
class TextCnn:
    """The network. ``dim`` numbers a word, ``filters`` filters of each width."""

    buckets: int = BUCKETS
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    seed: int = 7
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))
    constant: float | None = None

    def start(self) -> None:
        r = np.random.default_rng(self.seed)
        self.table = np.vstack([r.normal(0, 0.1, (self.buckets, self.dim)), np.zeros((1, self.dim))]).astype(np.float32)
        self.kernels = [r.normal(0, 0.5, (w * self.dim, self.filters)).astype(np.float32) for w in self.widths]
        for k in self.kernels:
            k[:: self.dim] = np.abs(k[:: self.dim]) + 0.5
        self.bias = np.zeros(self.filters * len(self.widths), np.float32)
        self.out = r.normal(0.2, 0.1, self.filters * len(self.widths)).astype(np.float32)
        self.off = np.float32(-1)

    def padded(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts in a row, each text closed by pads (so that no filter reaches into the next)."""
        pad, n = max(self.widths), len(first) - 1
        sizes = np.diff(first)
        begin = first[:-1] + pad * np.arange(n)
        row = np.full((len(ids) + pad * n, SLOTS), self.buckets, np.int64)
        row[np.arange(len(ids)) + np.repeat(pad * np.arange(n), sizes)] = ids
        return row, begin

    def pooled(self, row: np.ndarray, begin: np.ndarray, where: bool = False):
        """Largest answer of each filter in each text, and where it was."""
        emb = np.vstack([sum(self.table[row[:, s]] for s in range(SLOTS)), np.zeros((max(self.widths), self.dim), np.float32)])
        out, at = [], []
        for w, kernel in zip(self.widths, self.kernels, strict=True):
            got = emb[: len(row)] @ kernel[: self.dim]
            for j in range(1, w):
                got += emb[j : j + len(row)] @ kernel[j * self.dim : (j + 1) * self.dim]
            top = np.maximum.reduceat(got, begin, axis=0)
            out.append(top)
            if where:
                ends = np.append(begin[1:], len(row))
                at.append(np.stack([a + got[a:b].argmax(axis=0) for a, b in zip(begin, ends, strict=True)]))
        return np.concatenate(out, axis=1), at

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        row, begin = self.padded(ids, first)
        top, _ = self.pooled(row, begin)
        return np.maximum(top + self.bias, 0) @ self.out + self.off

    def prime(self, seen: np.ndarray, n0: int, n1: int) -> None:
        """The start of training: of texts of either label, ``seen`` has for each bucket in how many it is, and n0 and n1 how many there are."""
        self.start()
        odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
        self.table[:-1, 0] = odds * np.minimum(1, seen.sum(axis=0) / 8) / 2

    def passes(self, texts: list[np.ndarray], y: np.ndarray, ratio: float, epochs: int, seed: int, batch: int = 32, rate: float = 0.02) -> None:
        """Adam over the texts. ``ratio``: clean texts for each toxic one."""
        params = [self.table, *self.kernels, self.bias, self.out]
        first_m, second_m = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        r, step = np.random.default_rng(seed), 0
        weight = np.where(y == 1, min(5.0, ratio), 1.0)
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for s in range(0, len(order), batch):
                pick = order[s : s + batch]
                ids = np.concatenate([texts[i] for i in pick])
                first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
                _, grads, off = self.gradient(ids, first, y[pick], weight[pick])
                step += 1
                touched = np.flatnonzero(np.abs(grads[0]).sum(axis=1))
                for q, g, m, v in zip(params, grads, first_m, second_m, strict=True):
                    rows = touched if q is self.table else slice(None)
                    m[rows] = 0.9 * m[rows] + 0.1 * g[rows]
                    v[rows] = 0.99 * v[rows] + 0.01 * g[rows] ** 2
                    q[rows] -= (rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
                self.off -= np.float32(rate * off)

    def fit(self, texts: list[np.ndarray], y: np.ndarray, epochs: int = 6) -> None:
        """Trains on texts that one process holds."""
        seen = np.zeros((2, self.buckets))
        for ids, label in zip(texts, y, strict=True):
            seen[int(label), np.unique(ids)] += 1
        n0, n1 = max(1, (y == 0).sum()), max(1, (y == 1).sum())
        self.prime(seen, n0, n1)
        self.passes(texts, y, n0 / n1, epochs, self.seed)

    def flat(self) -> np.ndarray:
        """All that is trained as rows as wide as the table's, which come first."""
        rest = np.concatenate([p.ravel() for p in (*self.kernels, self.bias, self.out, np.array([self.off]))])
        return np.vstack([self.table, np.pad(rest, (0, -len(rest) % self.dim)).reshape(-1, self.dim)])

    def unflat(self, flat: np.ndarray) -> None:
        """Takes over what ``flat`` gave."""
        self.table, rest, at = flat[: self.buckets + 1], flat[self.buckets + 1 :].ravel(), 0
        for p in (*self.kernels, self.bias, self.out):
            p[...] = rest[at : at + p.size].reshape(p.shape)
            at += p.size
        self.off = np.float32(rest[at])

    def gradient(self, ids: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray], float]:
        """Mean weighted log loss of some texts, and its gradient by table, kernels, bias, out, and by off."""
        row, begin = self.padded(ids, first)
        top, at = self.pooled(row, begin, True)
        hidden = np.maximum(top + self.bias, 0)
        z = np.clip(hidden @ self.out + self.off, -30, 30)
        p = 1 / (1 + np.exp(-z))
        loss = float((weight * (np.logaddexp(0, z) - y * z)).mean())
        d = ((p - y) * weight / len(y)).astype(self.table.dtype)
        d_hidden = np.outer(d, self.out) * (top + self.bias > 0)
        grads = [np.zeros_like(self.table), *(np.zeros_like(k) for k in self.kernels), d_hidden.sum(axis=0), hidden.T @ d]
        full = np.vstack([row, np.full((max(self.widths), SLOTS), self.buckets)])
        for k, (w, kernel) in enumerate(zip(self.widths, self.kernels, strict=True)):
            part = d_hidden[:, k * self.filters : (k + 1) * self.filters]
            for j in range(w):
                word = full[at[k] + j]  # text x filter x slot
                use = self.table[word].sum(axis=2)
                grads[1 + k][j * self.dim : (j + 1) * self.dim] += np.einsum("tfd,tf->df", use, part)
                np.add.at(grads[0], word, (part[:, :, None] * kernel[j * self.dim : (j + 1) * self.dim].T[None])[:, :, None, :])
        grads[0][self.buckets] = 0
        return loss, grads, float(d.sum())

    def languages(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The number of each text's language, the last for none."""
        if not hasattr(self, "_lang"):
            self._lang = _language_table(self.buckets)
        hit = np.concatenate([np.zeros((1, len(FUNCTION_WORDS))), np.cumsum(self._lang[ids[:, 0]], axis=0, dtype=np.float64)])
        votes = hit[first[1:]] - hit[first[:-1]]
        return np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), len(FUNCTION_WORDS))

    def scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        z = self.logits(ids, first) - self.shift[self.languages(ids, first)]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def placed(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Logit and language of each text."""
        parts = []
        for s in range(0, len(texts), 32):
            some = texts[s : s + 32]
            ids, first = np.concatenate(some), np.concatenate([[0], np.cumsum([len(t) for t in some])])
            parts.append((self.logits(ids, first).astype(np.float64), self.languages(ids, first)))
        z, lang = (np.concatenate(c) for c in zip(*parts, strict=True))
        return z, lang

    def calibrate(self, texts: list[np.ndarray], y: np.ndarray, least: int = 30) -> None:
        """Moves each language's best threshold to 0."""
        if texts:
            self.calibrate_counts(*self.placed(texts), y, np.ones(len(texts), np.int64), least)

    def calibrate_counts(self, z: np.ndarray, lang: np.ndarray, y: np.ndarray, n: np.ndarray, least: int = 30) -> None:
        """The same from ``n`` texts of each logit, language and label. Few examples pull a threshold to that of all languages."""

        def best(own):
            at, place = np.unique(z[own], return_inverse=True)
            toxic, clean = (np.bincount(place, n[own] * (y[own] == k), len(at)) for k in (1, 0))
            cut = np.concatenate([[at[0] - 1], (at[1:] + at[:-1]) / 2, [at[-1] + 1]])
            wrong = np.concatenate([[0], np.cumsum(toxic)]) + clean.sum() - np.concatenate([[0], np.cumsum(clean)])
            fine = cut[wrong == wrong.min()]
            return fine[np.abs(fine).argmin()]

        overall = best(np.ones(len(z), bool))
        for k in range(len(self.shift)):
            own = lang == k
            toxic = int(n[own & (y == 1)].sum())
            share = toxic / (toxic + least)
            self.shift[k] = share * best(own) + (1 - share) * overall if toxic else overall


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, most_words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For trials in one process, ``train`` doesn't use it: bucket numbers and labels of some texts, whole ones, in order of a hash, as long as they have ``most_words`` words at most."""
    key = F.col(id_col)
    pick = labels.where(key.isNotNull() & F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("y"))
    pick = pick.groupBy(id_col).agg(F.max("y").alias("y")).orderBy(F.xxhash64(key), key).limit(sample)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[np.ndarray] = []
            for got, first in bucket_ids(b.column(2), BUCKETS):
                rows += [got[a:z].ravel().astype(np.int32) for a, z in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.int32()))], ["key", "y", "ids"])

    rows = docs.select(id_col, text_col).join(F.broadcast(pick), id_col).select(F.xxhash64(id_col).alias("key"), "y", text_col).mapInArrow(ids, "key long, y int, ids array<int>")
    rows = common.written(rows, "sample")
    sizes = sorted(tuple(r) for r in rows.groupBy("key").agg(F.sum(F.size("ids")).alias("n")).collect())  # at most ``sample`` numbers
    held = np.cumsum([n // SLOTS for _, n in sizes])
    fit = int(np.searchsorted(held, most_words, "right"))
    got = rows.where(F.col("key") <= sizes[fit - 1][0]).toArrow().sort_by([("key", "ascending"), ("y", "ascending")]) if fit else rows.limit(0).toArrow()
    common.forget(rows)
    y, flat = got["y"].to_numpy(), got["ids"].combine_chunks().flatten().to_numpy()
    ends = np.cumsum(pa.compute.list_value_length(got["ids"]).to_numpy())
    return [t.reshape(-1, SLOTS) for t in np.split(flat, ends[:-1])] if len(y) else [], y


def _marks(ids: DataFrame) -> np.ndarray:
    """Of BITS bits those that a hash of an id (column key) falls on: a filter of fixed size that lets all of them pass."""
    at = ids.select(F.pmod("key", F.lit(BITS)).alias("at"))
    word = at.groupBy(F.expr("at div 32").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 32 as int)))").alias("b")).toArrow()
    out = np.zeros(BITS >> 5, np.uint32)
    out[word["w"].to_numpy()] = word["b"].to_numpy().astype(np.uint32)
    return out


def _cut(ids: pa.Array) -> list[np.ndarray]:
    """Bucket numbers of each text, as ``labelled`` has packed them."""
    return [np.frombuffer(x, np.uint16).reshape(-1, SLOTS).astype(np.int64) for x in ids.to_pylist()]


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """key (a hash of the id), y, ids (bucket numbers of the whole text, packed) of every text with a label, in a written table.

    Only texts whose id may have a label travel to the join, as bucket numbers.
    """
    key = F.col(id_col)
    pick = labels.where(key.isNotNull() & F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("y"))
    pick = common.written(pick.groupBy(id_col).agg(F.max("y").alias("y")), "labels")
    marks = docs.sparkSession.sparkContext.broadcast(_marks(pick.select(F.xxhash64(id_col).alias("key"))))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.by_bytes(batches, text_col, 64 << 20):
            at = b.column(1).to_numpy().astype(np.int64) % BITS
            b = b.filter(pa.array((marks.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))
            rows = [ids[a:z].astype(np.uint16).tobytes() for ids, first in bucket_ids(b.column(2), BUCKETS) for a, z in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.binary())], [id_col, "key", "ids"])

    here = docs.where(key.isNotNull()).select(id_col, F.xxhash64(id_col).alias("key"), text_col)
    got = here.mapInArrow(packed, here.select(id_col, "key").schema.add("ids", "binary"))
    out = common.written(got.join(pick.hint("merge"), id_col).select("key", "y", "ids"), "labelled")
    common.forget(pick)
    marks.destroy()
    return out


def _counted(rows: DataFrame) -> np.ndarray:
    """For each label and bucket the number of texts that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for ids, y in zip(_cut(b.column(1)), b.column(0).to_pylist(), strict=True):
                seen[y, np.unique(ids)] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *map(pa.array, seen[:, at])], ["i", "n0", "n1"])

    got = common.written(rows.select("y", "ids").mapInArrow(count, "i long, n0 long, n1 long").groupBy("i").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "counts")
    sums, out = got.toArrow(), np.zeros((2, BUCKETS))
    common.forget(got)
    for k in (0, 1):
        out[k, sums["i"].to_numpy()] = sums[f"n{k}"].to_numpy()
    return out


def _round(rows: DataFrame, net: TextCnn, shards: int, ratio: float, seed: int) -> None:
    """One pass over all shards: ``net`` then has the mean of their changes. All but the table counts as rows after it, as wide as the table's."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    cols = [f"d{k}" for k in range(net.dim)]

    def run(key: tuple, group: pa.Table) -> pa.Table:
        old, new = shared.value, copy.deepcopy(shared.value)
        each = sorted(zip(*(group[c].to_pylist() for c in ("key", "y", "ids")), strict=True))
        new.passes(_cut(pa.array([r[2] for r in each], pa.binary())), np.array([r[1] for r in each]), ratio, 1, seed * 1_000_003 + key[0].as_py())
        change = new.flat().astype(np.float64) - old.flat()
        at = np.flatnonzero(change.any(axis=1))
        whole = np.rint(change[at] * UNIT).astype(np.int64) * len(each)
        return pa.table([pa.array(at), pa.array(np.full(len(at), len(each))), *map(pa.array, whole.T)], ["i", "n", *cols])

    schema = "i long, n long, " + ", ".join(f"{c} long" for c in cols)
    got = rows.withColumn("shard", F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards))).repartition(min(shards, 2_000), "shard").groupBy("shard").applyInArrow(run, schema)
    got = common.written(got.groupBy("i").agg(*(F.sum(c).alias(c) for c in ("n", *cols))), "round")
    sums = got.toArrow()
    common.forget(got)
    shared.destroy()
    flat = net.flat().astype(np.float64)
    flat[sums["i"].to_numpy()] += np.stack([sums[c].to_numpy() for c in cols], axis=1) / UNIT / sums["n"].to_numpy()[:, None]
    net.unflat(flat.astype(np.float32))


def _thresholds(rows: DataFrame, net: TextCnn) -> None:
    """Calibrates by counts of texts by language, label and step of the logit."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    shape = (len(net.shift), 2, 2 * MOST * STEPS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(shape, np.int64)
        for b in batches:
            if b.num_rows:
                z, lang = shared.value.placed(_cut(b.column(1)))
                np.add.at(found, (lang, b.column(0).to_numpy(), np.clip(np.floor(z * STEPS) + MOST * STEPS, 0, shape[2] - 1).astype(np.int64)), 1)
        at = np.nonzero(found)
        yield pa.RecordBatch.from_arrays([*map(pa.array, at), pa.array(found[at])], ["lang", "y", "z", "n"])

    got = common.written(rows.select("y", "ids").mapInArrow(count, "lang long, y long, z long, n long").groupBy("lang", "y", "z").agg(F.sum("n").alias("n")), "logits")
    lang, y, z, n = (got.orderBy("lang", "y", "z").toArrow()[c].to_numpy() for c in ("lang", "y", "z", "n"))
    common.forget(got)
    shared.destroy()
    if len(n):
        net.calibrate_counts((z + 0.5) / STEPS - MOST, lang, y, n)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", shard: int = SHARD, rounds: int = ROUNDS) -> TextCnn:
    """Fits on all labelled rows; of one id in five only the thresholds are learnt."""
    rows = labelled(docs, labels, id_col, text_col, label_col)
    held = F.pmod(F.xxhash64("key", F.lit("held")), F.lit(5)) == 0
    n = {(r["held"], r["y"]): r["n"] for r in rows.groupBy(held.alias("held"), "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = [n.get((False, y), 0) + n.get((True, y), 0) for y in (0, 1)]
    net = TextCnn()
    if not all(total):
        net.constant = total[1] / sum(total) if sum(total) else 0.0
    else:
        fit = rows.where(~held)
        n0, n1 = (max(1, n.get((False, y), 0)) for y in (0, 1))
        net.prime(_counted(fit), n0, n1)
        for k in range(rounds):
            _round(fit, net, -(-(n0 + n1) // shard), n0 / n1, net.seed + k)
        _thresholds(rows.where(held), net)
    common.forget(rows)
    pa.default_memory_pool().release_unused()  # the driver keeps no more than the network
    return net


def score(docs: DataFrame, net: TextCnn, text_col: str = "text", out: str = "score", keep_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (the text only with ``keep_text``) and the score as ``out``. ``net`` has a fixed size, whatever the data."""
    if out in docs.columns:
        raise ValueError(f"there is a column {out} already")
    rest = [c for c in docs.columns if keep_text or c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = docs.select(*rest).schema.add(out, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            got = [model.scores(ids, first) for ids, first in bucket_ids(b.column(b.schema.get_field_index(text_col)), model.buckets)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in rest), pa.array(np.concatenate(got) if got else np.zeros(0))], [*rest, out])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def op2_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    net = train(docs, labels.where(~held_out()))
    out = score(docs.select("doc_id", "text"), net)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
