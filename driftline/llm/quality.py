"""Quality classifier with hierarchical empirical Bayes.

The evidence of a text is a logistic model's log odds over a few measures of its bytes and words (lengths, kinds of characters,
repetition), fitted in numpy on a bounded sample of labelled rows (SAMPLE, a parameter). Sites form a hierarchy: all, host
(``source``), path (host and ``lang``). Labelled counts are summed up by site over all labels; the spread between sites
gives by moments how many labels the prior is worth, and a sparse site's share of good texts shrinks to its host's, and a host's to that
of all. A document's posterior log odds are its evidence, less the share in the sample, plus its path's posterior log odds.

Null and empty texts get the measures of no words. Null hosts or languages are sites of their own. Null ids are scored. Without labels
of both kinds all evidence is 0. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, words

SAMPLE = 6_000
MEASURES = 14
_KINDS = np.zeros((5, 256), np.float32)
_KINDS[0, 65:91] = 1
_KINDS[1, 97:123] = 1
_KINDS[2, 48:58] = 1
_KINDS[3, 128:] = 1
_KINDS[4, [b for b in range(33, 128) if not chr(b).isalnum() and chr(b) not in ".,"]] = 1


def measures(col: pa.Array) -> Iterator[np.ndarray]:
    """A row of measures for each text, slice by slice."""
    for lo, hi, raw, off in words.blocks(col, 512 << 10):
        h, w0, w1, first = words.word_hashes(raw, off)
        size = np.maximum(1, np.diff(off)).astype(np.float64)
        out = np.zeros((hi - lo, MEASURES))
        for k in range(5):
            total = np.concatenate([[0], np.cumsum(_KINDS[k][raw], dtype=np.float64)])
            out[:, k] = (total[off[1:]] - total[off[:-1]]) / size
        stops = np.concatenate([[0], np.cumsum((raw == 46) | (raw == 44), dtype=np.float64)])
        lines = np.concatenate([[0], np.cumsum(raw == 10, dtype=np.float64)])
        out[:, 5] = (stops[off[1:]] - stops[off[:-1]]) / size
        out[:, 6] = (lines[off[1:]] - lines[off[:-1]]) / size
        n = np.diff(first).astype(np.float64)
        out[:, 7] = np.log1p(n)
        out[:, 8] = np.log1p(np.maximum(0, size - n) / np.maximum(1, n))
        for i in range(hi - lo):
            w = h[first[i] : first[i + 1]]
            if len(w):
                seen, times = np.unique(w, return_counts=True)
                three, often = np.unique(words.shingles(w, 3), return_counts=True)
                out[i, 9] = len(seen) / len(w) ** 0.75
                out[i, 10] = times.max() / len(w)
                out[i, 11] = (len(w) - len(three)) / len(w)
                out[i, 12] = (w[1:] == w[:-1]).mean() if len(w) > 1 else 0
                out[i, 13] = ((w1 - w0)[first[i] : first[i + 1]] <= 1).mean()
        yield out


class Evidence:
    """Logistic regression on standardised measures and their squares."""

    def __init__(self):
        self.mean, self.scale = np.zeros(2 * MEASURES), np.ones(2 * MEASURES)
        self.weights, self.offset, self.base = np.zeros(2 * MEASURES), 0.0, 0.0

    @staticmethod
    def wide(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, x**2], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1.0) -> None:
        x = self.wide(x)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.concatenate([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))], axis=1)
        w, pull = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        pull[-1] = 1e-6
        for _ in range(steps):  # Newton
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (y - p) - pull * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights, self.offset = w[:-1], w[-1]
        self.base = float(np.log(y.mean() / (1 - y.mean())))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Evidence alone: less the log odds of the sample."""
        return np.clip((self.wide(x) - self.mean) / self.scale, -8, 8) @ self.weights + self.offset - self.base


def _measured(docs: DataFrame, text_col: str, rest: Sequence[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [r for x in measures(b.column(len(rest))) for r in x]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(rest))), pa.array(got, pa.list_(pa.float64()))], [*rest, "x"])

    return docs.select(*rest, text_col).mapInArrow(run, docs.select(*rest).schema.add("x", T.ArrayType(T.DoubleType())))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> Evidence:
    key = F.col(id_col)
    pick = labels.where(key.isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y")).orderBy(F.xxhash64(key), key).limit(sample)
    rows = docs.select(id_col, text_col).join(F.broadcast(pick), id_col).select(F.xxhash64(id_col).alias("key"), "y", text_col)
    got = _measured(rows, text_col, ["key", "y"]).toArrow().sort_by("key")
    model, y = Evidence(), got["y"].to_numpy().astype(np.float64)
    if len(y) and 0 < y.mean() < 1:
        model.fit(np.array(got["x"].to_pylist()), y)
    return model


def shrunk(counts: DataFrame, by: Sequence[str], up: DataFrame, name: str) -> DataFrame:
    """Posterior share of each site of ``counts`` (by, n, good), given its parent's (``up``: the parent's keys, prior).

    The prior's weight m comes from the moments over all sites: Var(share) = p(1 - p) / (m + 1) beyond what sampling gives.
    """
    parent = [c for c in by if c in up.columns]
    got = counts.join(up, parent, "left") if parent else counts.crossJoin(F.broadcast(up))
    share = F.col("good") / F.col("n")
    noise = F.col("prior") * (1 - F.col("prior"))
    spread = got.where("n > 1").agg(F.sum("n").alias("w"), F.sum(F.col("n") * (share - F.col("prior")) ** 2).alias("s"), F.sum(noise).alias("e"), F.sum(F.col("n") * noise).alias("v"))
    between = F.greatest(F.lit(1e-4), (F.col("s") - F.col("e")) / F.nullif(F.col("v"), F.lit(0.0)))
    weight = spread.select(F.coalesce(F.least(F.greatest(1 / between - 1, F.lit(1.0)), F.lit(1000.0)), F.lit(50.0)).alias("m"))
    return got.crossJoin(F.broadcast(weight)).select(*by, ((F.col("good") + F.col("m") * F.col("prior")) / (F.col("n") + F.col("m"))).alias(name))


def site_posteriors(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, host: str, path: str) -> DataFrame:
    """host, path, share: every site of ``docs``, by grouped aggregation of all labels."""
    site = lambda df, *more: df.select(*more, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    known = site(docs, id_col).join(labels.where(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("y")), id_col)
    # each level is used several times: written once, it is computed once
    paths = common.written(known.groupBy("host", "path").agg(F.count("y").alias("n"), F.sum("y").alias("good")), "paths")
    hosts = common.written(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "hosts")
    total = common.written(hosts.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior")), "total")
    host_share = common.written(shrunk(hosts, ["host"], total, "prior"), "host_share")
    path_share = shrunk(paths, ["host", "path"], host_share, "share")
    sites = site(docs).distinct()
    return sites.join(path_share, ["host", "path"], "left").join(host_share, "host", "left").crossJoin(F.broadcast(total.withColumnRenamed("prior", "p0"))).select("host", "path", F.coalesce("share", "prior", "p0").alias("share"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", host: str = "source", path: str = "lang", threshold: float = 0.5) -> DataFrame:
    """id, evidence, site_share, score, keep of each row."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_col))
    sites = common.written(site_posteriors(docs, labels, id_col, label_col, host, path), "sites")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.value.log_odds(x) for x in measures(b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.concatenate(got) if got else np.zeros(0))], [id_col, "host", "path", "evidence"])

    src = docs.select(id_col, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), text_col)
    scored = src.mapInArrow(run, src.select(id_col, "host", "path").schema.add("evidence", "double"))
    # a site may hold a third of all rows: both sides are plain exchanges, so Spark may split it (or broadcasts the sites if they are few)
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.ln(F.col("share") / (1 - F.col("share"))))))
    return scored.join(sites, ["host", "path"], "left").select(id_col, "evidence", F.col("share").alias("site_share"), score.alias("score")).withColumn("keep", F.col("score") >= threshold)


def op6_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return quality(docs, labels.where(~held)).withColumn("held_out", F.coalesce(held, F.lit(False)))
