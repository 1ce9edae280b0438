"""A training corpus in five stages: toxicity, exact dedup, n-gram Jaccard join, substring dedup, best-fit packing.

Every stage is written as Parquet and read again as the next one's documents. All but the last return the columns of ``documents``.
Of an empty table every stage makes an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import common, exact_dedup, jaccard_join, packing, substring_dedup, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go; null and empty texts have the score of no words. Fits on labels outside the held-out fold."""
    net = toxicity.train(docs, common.table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    out = "score"
    while out in docs.columns:
        out += "_"
    return toxicity.score(docs, net, out=out, keep_text=True).where(F.col(out) < 0.5).drop(out)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that with the smallest id (null ids come last). Rows are told apart by id and text, so an id may keep one text and lose another.

    Hints make the plan the same at every size.
    """
    got = common.written(exact_dedup.exact_dedup(docs, hashes=True).select("doc_id", "text_hash", "kept"), "kept")
    rows = got.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")).where("kept")
    here = docs["doc_id"].eqNullSafe(rows["doc_id"]) & (F.xxhash64(docs["text"]) == rows["text_hash"])
    kept = docs.join(rows.hint("merge"), here, "left_semi")
    if not rows.where("times > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, with all its rows. Rows without id are in no group and stay."""
    got = common.written(jaccard_join.jaccard_components(docs), "near")
    ids = got.where("doc_id is null or doc_id = component_id").select("doc_id").distinct()
    return docs.join(ids.hint("merge"), docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all documents but the first that has them; what is left without a word goes.

    Each row of a repeated id is cut by its own passages. Rows without id or text stay as they are.
    """
    spans = common.written(substring_dedup.repeated_spans(docs), "spans")
    return substring_dedup.without_spans(docs, spans)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; null texts are empty."""
    return packing.pack(docs)


_spent: list = []


def _tidy(stage: Callable) -> Callable:
    """A stage that first removes the scratch tables of the stages before it: its ``docs`` are written by then."""

    @functools.wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.drop(_spent)
        with common.recorded(_spent):
            return stage(spark, docs, sf_dir)

    return call


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", _tidy(toxicity_stage)),
    ("exact_dedup", _tidy(exact_stage)),
    ("jaccard_join", _tidy(near_stage)),
    ("substring_dedup", _tidy(substring_stage)),
    ("packing", _tidy(packing_stage)),
]

#: A trained network and a tokenizer are no SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
        if before is not None:
            common.forget(before)
        before = docs
    return docs
