import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n, size=400):
    return " ".join(f"w{r.randrange(size)}{'abcdefgh'[r.randrange(8)]}" for _ in range(n))


@pytest.fixture
def docs(spark):
    def make(texts, extra=""):
        rows = [(i, t, "en", "src", len(t or "")) if not isinstance(t, tuple) else (t[0], t[1], "en", "src", len(t[1] or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def odd(docs):
    """Nulls in every column, empty and long texts, ties and repeated rows, and columns with names that operators use inside."""
    from pyspark.sql import functions as F

    long = "word " * 3_000 + "x" * 30_000
    df = docs([None, "", " ", "Hello  world", "hello world", "Hello\tworld", long, long, "<|endoftext|> tail", "héllo wörld 日本", (3, "Hello  world"), (None, "no id here"), (None, None)])
    df = df.withColumn("lang", F.when(F.col("doc_id") != 4, F.col("lang"))).withColumn("source", F.when(F.col("doc_id") != 5, F.col("source"))).withColumn("n_chars", F.lit(None).cast("long"))
    for c in ("id", "score", "grp", "key", "y", "x", "node", "comp", "seg", "_cuts", "bin", "pivot", "host", "path", "kept", "n"):
        df = df.withColumn(c, F.lit(7))
    return df
