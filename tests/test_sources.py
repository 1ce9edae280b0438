import gzip
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from driftline import schemas
from driftline.operators import activity, explore
from driftline.sources import files, fs, publish
from driftline.streaming import incremental
from tests.conftest import rows

DIFF = """<?xml version="1.0"?><osmChange version="0.6">
<create><node id="1" version="1" timestamp="2024-01-01T00:00:30Z" uid="10" user="alice" lat="1.5" lon="2.5"/></create>
<modify><node id="2" version="2" timestamp="2024-01-01T00:01:00Z" uid="10" user="alice" lat="1" lon="2"><tag k="name" v="X"/></node>
<way id="7" version="3" timestamp="2024-01-01T00:02:00Z" uid="12" user="carol"><nd ref="1"/><nd ref="2"/><tag k="a" v="1"/><tag k="b" v="2"/></way></modify>
<delete><node id="3" version="4" timestamp="2024-01-01T00:03:00Z" uid="12" user="carol"/><relation id="9" version="2" timestamp="2024-01-01T00:02:30Z" uid="12" user="carol"/></delete>
</osmChange>"""


def test_change_documents(spark, tmp_path):
    (tmp_path / "1234.osc").write_text(DIFF)
    with gzip.open(tmp_path / "1235.osc.gz", "wt") as f:
        f.write(DIFF)
    got = files.change_documents(spark, str(tmp_path))
    assert got.count() == 10
    one = got.where("seq = 1235")
    assert [(r.type, r.id, r.visible, len(r.tags), r.refs) for r in one.orderBy("type", "id").collect()] == [("node", 1, True, 0, []), ("node", 2, True, 1, []), ("node", 3, False, 0, []), ("relation", 9, False, 0, []), ("way", 7, True, 2, [1, 2])]
    merged, span = files.merge_diffs([one, got.where("seq = 1234")])
    assert [r.seq for r in merged.select("seq").distinct().orderBy("seq").collect()] == [1234, 1235] and (span.first().hi - span.first().lo).seconds == 150


def test_states_and_names():
    s = files.parse_state("#comment\r\n\nsequenceNumber=4321\r\ntimestamp=2024-01-01T00\\:00\\:00Z\n")
    assert s == {"sequenceNumber": "4321", "timestamp": "2024-01-01T00:00:00Z"}
    for bad in ("sequenceNumber=1", "timestamp=x", ""):
        with pytest.raises(ValueError):
            files.parse_state(bad)
    assert files.diff_path(1_234_567) == "001/234/567.osc.gz" and files.diff_sequence("567.osc.gz") == 567 and files.sidecar("x.osh.pbf") == "x.state.txt"
    assert files.manifest_source('{"source": {"url": "u"}}') == {"url": "u"} and files.manifest_source("{") == {}


def test_staged_discovery(spark, tmp_path):
    for seq in (5, 60):
        spark.createDataFrame([(1, seq)], "uid long, n long").write.parquet(str(tmp_path / f"stage/seq_{seq}/minutes"))
    got = files.staged(spark, str(tmp_path / "stage"), schemas.of("uid BIGINT, n BIGINT"))
    assert rows(got) == [(1, 5, 5), (1, 60, 60)]


def test_country_index(spark, tmp_path):
    big = (1 << 63) + (1 << 20)
    spark.createDataFrame([(str(big), 1, 9), ("64", 2, 3)], "s string, country_id int, level int").select(F.col("s").cast("decimal(20,0)").alias("s2_cell"), "country_id", "level").write.parquet(str(tmp_path / "i"))
    (tmp_path / "n.json").write_text(json.dumps({"0": None, "1": "AA", "2": "BB"}))
    index, names = files.country_index(spark, str(tmp_path / "i"), str(tmp_path / "n.json"))
    assert {r.s2_cell for r in index.collect()} == {big - (1 << 64), 64} and names.count() == 3


def test_country_lookup(spark, sf):
    from driftline.plans import catalog

    got = {r.cell: r.iso for r in catalog.queries()["country_of_points"](spark, sf).collect()}
    assert all((v is None) == (k % 3 == 0 or k % 5 == 0) for k, v in got.items() if k < 5)


def test_schema_guard(spark):
    with pytest.raises(ValueError, match="missing column"):
        schemas.assert_schema(spark.range(1), schemas.CUBE)
    with pytest.raises(ValueError, match="change_date"):
        schemas.assert_schema(spark.createDataFrame([], "h3_cell long, change_date long, count long"), schemas.CUBE)
    assert len(schemas.RANKING.fields) == 40 and len(schemas.SUSPECTS.fields) == 13


def test_table_options(spark, tmp_path):
    df = spark.range(5_000).select(F.col("id").alias("uid"), F.col("id").alias("n")).coalesce(1)
    publish.table(df, str(tmp_path / "t"), 1_000, ("uid",))
    f = next((tmp_path / "t").glob("*.parquet"))
    m = pq.read_metadata(f)
    assert m.num_row_groups == 5 and m.row_group(0).column(0).statistics.has_min_max and m.row_group(0).column(0).compression == "ZSTD"
    assert m.row_group(0).column(1).statistics is None or not m.row_group(0).column(1).statistics.has_min_max
    assert publish.footer_bytes(spark, str(f)) == m.serialized_size + 8


def test_cube_partitions_and_rewrite(spark, tmp_path):
    path = str(tmp_path / "cube")
    publish.cube(spark.createDataFrame([(2, 19_723, 1), (1, 19_723, 1), (1, 19_000, 4)], "cell long, day int, count long"), path)
    base = spark.read.parquet(path)
    staged = spark.createDataFrame([(101, 2024, 1, 19_723, 6), (99, 2022, 1, 19_000, 9)], "seq long, year int, cell long, day int, count long")
    new = incremental.merge_years(base, staged, 100, 101)
    old = {f.name for f in (tmp_path / "cube/year=2022").iterdir()}
    incremental.rewrite_years(spark.createDataFrame(new.collect(), new.schema), path)
    assert rows(spark.read.parquet(path).select("cell", "day", "count")) == [(1, 19_000, 4), (1, 19_723, 7), (2, 19_723, 1)]
    assert {f.name for f in (tmp_path / "cube/year=2022").iterdir()} == old


def test_feed_and_manifest(spark, tmp_path):
    s = spark.createDataFrame([(1, "a<b", 19_723, 3, 9, 600, 0.0, ["k"], ["FR"], 2, 1500, 4, 0), (2, "z", 19_724, 32, 1, 0, 0.0, [], [], 0, 0, 4, 1)], schemas.SUSPECTS)
    publish.feed(s, str(tmp_path / "feed.xml"))
    out = (tmp_path / "feed.xml").read_text()
    assert out.index("<title>z - 2024-01-02 (1 changes)") < out.index("<title>a&lt;b - 2024-01-01 (9 changes)") and "filter-2" in out and "<updated>2024-01-02" in out and "2 far moves, largest 1.5 km" in out
    assert len(__import__("xml.etree.ElementTree").etree.ElementTree.fromstring(out.encode()).findall("{http://www.w3.org/2005/Atom}entry")) == 2
    publish.feed(s.limit(0), str(tmp_path / "feed.xml"))
    assert "1970-01-01" in (tmp_path / "feed.xml").read_text()
    publish.suspects(s, str(tmp_path / "s"))
    publish.manifest(spark, str(tmp_path / "m.json"), 9, {"url": "u"}, (1.0, 2.0), (19_723, 19_724), {}, {"suspect": publish.files_of(spark, str(tmp_path / "s"))})
    m = json.loads((tmp_path / "m.json").read_text())
    assert m["date_range"] == {"min_date": "2024-01-01", "max_date": "2024-01-02"} and m["datasets"]["suspect"]["footer_size"][0] > 8
    assert rows(explore.query_parquet(spark, str(tmp_path / "s"), schemas.SUSPECTS, "uid = 2", ["uid"], 5)) == [(2,)]
    assert explore.query_parquet(spark, str(tmp_path / "none"), schemas.SUSPECTS).count() == 0


def test_ranking_tables(spark, tmp_path):
    from tests.test_operators import users

    u = users(spark, {1: 4, 2: 5})
    publish.ranking(activity.ranking(u), activity.ranking_stats(u), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r/ranking")).count() == 2 and spark.read.parquet(str(tmp_path / "r/ranking_stats")).count() == 15


def test_plans_and_folds(spark):
    assert list(incremental.sequence_range(10, 15)) == [11, 12, 13, 14, 15] and list(incremental.sequence_range(10, 15, 2)) == [11, 12]
    assert incremental.batches([(1, 0, 60), (2, 60, 4_000), (3, 4_000, 4_060)]) == [[1, 2], [3]] and incremental.batches([]) == []
    assert incremental.consecutive([5, 6, 8], 5) == [5, 6]
    assert incremental.compaction_due(100, 10, 0) and not incremental.compaction_due(100, 5, 4) and incremental.compaction_due(0, 1, 0)
    base = spark.createDataFrame([(10, 1000, 300)], "uid long, minute long, n long")
    st = spark.createDataFrame([(50, 10, 1000, 300), (60, 10, 1000, 50), (60, 12, 3000, 600), (70, 1, 1, 1)], "seq long, uid long, minute long, n long")
    assert rows(incremental.fold(base, st, 50, ["uid", "minute"], applied=60)) == [(10, 1000, 350), (12, 3000, 600)]


def test_next_state(spark):
    over, dead = spark.createDataFrame([(1, 5), (2, 6)], "node long, cell long"), spark.createDataFrame([(3,)], "node long")
    ch = spark.createDataFrame([(2, 1, True, 7), (2, 2, False, None), (3, 1, True, 8), (4, 1, False, None), (4, 2, True, 9)], "node long, ord long, visible boolean, cell long")
    o, d = incremental.next_state(over, dead, ch)
    assert rows(o) == [(1, 5), (3, 8), (4, 9)] and rows(d) == [(2,)]


def test_ledger_and_lock(spark, tmp_path):
    led = incremental.Ledger(spark, str(tmp_path / "l.json"))
    led.commit("cube", 5, "2024")
    again = incremental.Ledger(spark, str(tmp_path / "l.json"))
    assert again.applied("cube", "2024") == 5 and led.applied("cube", "2023") == 0 and again.partitions("cube") == {"2024": 5} and not again.known("cube")
    with pytest.raises(ValueError):
        led.commit("cube", 4, "2024")
    with pytest.raises(ValueError):  # all or none
        led.move({"history/": 6, "cube/2024": 4})
    assert not led.known("history") and not incremental.Ledger(spark, str(tmp_path / "l.json")).known("history")
    with incremental.Lock(spark, str(tmp_path / "lock")):
        with pytest.raises(RuntimeError):
            incremental.Lock(spark, str(tmp_path / "lock")).__enter__()
    with incremental.Lock(spark, str(tmp_path / "lock")):
        pass
    (tmp_path / "lock").write_text("left by a run that broke off")
    with incremental.Lock(spark, str(tmp_path / "lock"), stale_s=0):
        pass


def test_files_of_any_file_system(spark, tmp_path):
    path = str(tmp_path / "a/b.txt")
    assert not fs.exists(spark, path) and fs.listed(spark, str(tmp_path / "a")) == []
    fs.replace(spark, path, "one é")
    fs.replace(spark, f"file://{path}", "two é")
    assert fs.read_text(spark, path) == "two é" and fs.read_tail(spark, path, 2).decode() == "é" and [x[0] for x in fs.listed(spark, str(tmp_path / "a"))] == ["b.txt"]
    (tmp_path / "a/b.txt").write_text("edited by hand")
    assert fs.read_text(spark, path) == "edited by hand"
    with pytest.raises(ZeroDivisionError):
        with fs.Writer(spark, path) as f:
            f.write("half")
            1 / 0  # noqa: B018
    assert fs.read_text(spark, path) == "edited by hand"
    fs.delete(spark, str(tmp_path / "a"))
    assert not (tmp_path / "a").exists()


def test_stream_applies_each_file_once(spark, tmp_path):
    src, total = str(tmp_path / "src"), str(tmp_path / "total")
    schema = schemas.of("uid BIGINT, minute BIGINT, n BIGINT")
    spark.createDataFrame([], schema).write.parquet(total)

    def apply(batch, i):
        now = spark.read.schema(schema).parquet(total).unionByName(batch).groupBy("uid", "minute").agg(F.sum("n").alias("n"))
        spark.createDataFrame(now.collect(), schema).write.mode("overwrite").parquet(total)

    for k in range(3):
        spark.createDataFrame([(1, 5, k + 1)], schema).coalesce(1).write.mode("append").parquet(src)
        incremental.run_stream(spark, src, schema, str(tmp_path / "cp"), apply, 1)
    assert rows(spark.read.parquet(total)) == [(1, 5, 6)]
