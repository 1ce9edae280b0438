"""Token counts: batches of texts are encoded inside Arrow functions and only lengths leave them.

Batches are balanced by bytes (large ones are cut, small ones joined), long texts are cut at safe boundaries, and nothing is shuffled.
Null texts count as empty (0 tokens); rows with a null id are counted like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

from . import bpe, common

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16


def counter(path: str):
    """A function from a list of texts to their token counts, for a tokenizers .json or a sentencepiece .model file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    try:
        lengths = bpe.load(path).lengths

        def count(texts: list[str]) -> list[int]:
            cut = [bpe.pieces(t, PIECE_CHARS) for t in texts]
            n = iter(lengths([p for c in cut for p in c]))
            return [sum(next(n) for _ in c) for c in cut]

        return count
    except ValueError:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()
        return lambda texts: [len(x.ids) for x in whole.encode_batch(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 512, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of each row."""
    path = path or bpe.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in common.balanced(batches, text_col, batch_bytes):
            col = pa.compute.fill_null(b.column(1), "")
            n = pa.array(count(col.to_pylist()), pa.int64())
            sizes = pa.compute.binary_length(col).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, n, pa.compute.greater(n, limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"))
