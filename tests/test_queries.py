"""Every query against its SQL in DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from driftline.plans import catalog


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob("/root/testdata/sf0.001/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, float):
        return f"{v:.6f}"
    return str(v)


def canon(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, duck, sf, name):
    got = catalog.queries()[name](spark, sf)
    want = duck.execute(catalog.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(cols, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_has_rows(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.fixture(scope="module")
def typos(tmp_path_factory):
    """The tables with names of objects that swing between two that are two bytes apart, one of them with a byte that SQL writes out."""
    d = tmp_path_factory.mktemp("typos")
    for p in glob.glob("/root/testdata/sf0.001/*.parquet"):
        os.symlink(p, d / os.path.basename(p))
    (d / "documents.parquet").unlink()
    duckdb.sql(f"COPY (SELECT i AS doc_id, ['Enü den', 'Enbe den', 'a\"b x', 'acb x'][i // 20 % 4 + 1] AS text, 'de' AS lang, 'src' || i % 20 AS source, CAST(7 AS BIGINT) AS n_chars FROM range(1200) t(i)) TO '{d}/documents.parquet'")
    con = duckdb.connect()
    for p in d.iterdir():
        con.execute(f"CREATE VIEW {p.name[:-8]} AS SELECT * FROM '{p}'")
    return str(d), con


@pytest.mark.parametrize("name", ["feed_entries", "suspect_export", "lang_days", "language_counts", "latest_suspects"])
def test_typos_are_told_as_in_sql(spark, typos, name):
    test_same_rows(spark, typos[1], typos[0], name)


def odd_tables(d, name, rows):
    """The tables with another ``name``, and a DuckDB connection that has them."""
    for p in glob.glob("/root/testdata/sf0.001/*.parquet"):
        os.symlink(p, d / os.path.basename(p))
    (d / f"{name}.parquet").unlink()
    con = duckdb.connect()
    con.execute(f"COPY ({rows}) TO '{d}/{name}.parquet'")
    for p in d.iterdir():
        con.execute(f"CREATE VIEW {p.name[:-8]} AS SELECT * FROM '{p}'")
    return str(d), con


@pytest.fixture(scope="module")
def unknown(tmp_path_factory):
    """Events of which some have no time, no type or no user."""
    return odd_tables(
        tmp_path_factory.mktemp("unknown"),
        "events",
        """SELECT i AS event_id, CASE WHEN i % 11 <> 0 THEN TIMESTAMP '2024-01-10' + to_seconds(i * 97) END AS ts, CASE WHEN i % 29 <> 0 THEN i % 24 END AS user_id,
  CASE WHEN i % 24 % 5 <> 0 THEN ['click', 'view', 'error'][i % 3 + 1] END AS event_type, i * 37 % 700 / 1.0 AS value, '{"k": ' || i * 53 % 170 || '}' AS props FROM range(3000) t(i)""",
    )


@pytest.mark.parametrize("name", ["suspect_export", "move_days", "coverage_days"])
def test_unknown_times_and_types_as_in_sql(spark, unknown, name):
    test_same_rows(spark, unknown[1], unknown[0], name)


@pytest.fixture(scope="module")
def languages(tmp_path_factory):
    """Documents whose languages are empty or of two lines."""
    return odd_tables(
        tmp_path_factory.mktemp("languages"),
        "documents",
        """SELECT i AS doc_id, ['Ulm am', 'Ulm Ulm', 'Rom am', 'Paris Rom'][i * i // 20 % 4 + 1] AS text, ['', 'de', 'de', 'a' || chr(10) || 'b', 'de'][i // 40 % 5 + 1] AS lang, 'src' || i % 20 AS source, CAST(7 AS BIGINT) AS n_chars
FROM range(1200) t(i)""",
    )


@pytest.mark.parametrize("name", ["lang_days"])
def test_any_language_counts_as_in_sql(spark, languages, name):
    test_same_rows(spark, languages[1], languages[0], name)


@pytest.fixture(scope="module")
def no_languages(tmp_path_factory):
    """Documents of which some have no language."""
    return odd_tables(
        tmp_path_factory.mktemp("no_languages"),
        "documents",
        """SELECT i AS doc_id, ['Ulm am', 'Ulm Ulm', 'Rom am', 'Paris Rom'][i * i // 20 % 4 + 1] AS text, ['de', NULL, 'de', 'fr', NULL][i // 20 % 5 + 1] AS lang, 'src' || i % 20 AS source, CAST(7 AS BIGINT) AS n_chars
FROM range(1200) t(i)""",
    )


@pytest.mark.parametrize("name", ["language_counts"])
def test_no_language_as_in_sql(spark, no_languages, name):
    test_same_rows(spark, no_languages[1], no_languages[0], name)


def test_latest_without_user_come_in_the_order_of_sql(spark, unknown):
    got = catalog.queries()["latest_suspects"](spark, unknown[0])
    want = unknown[1].execute(catalog.oracle_sql()["latest_suspects"])
    cols = [c[0] for c in want.description]
    found = want.fetchall()
    assert any(r[cols.index("uid")] is None for r in found)
    assert [[plain(r[c]) for c in cols] for r in got.collect()] == [[plain(v) for v in r] for r in found]
