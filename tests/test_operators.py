import pytest
from pyspark.sql import functions as F

from driftline.operators import activity, cube, edits, explore, finalize
from driftline.schemas import COUNTERS
from tests.conftest import rows

VERSION = "uid long, username string, day int, ord long, kind int, visible boolean, version int, tags array<struct<k:string,v:string>>"


def users(spark, node=None, **more):
    """Totals with so many created nodes (or other counters) by uid."""
    uids = sorted({*(node or {}), *(u for v in more.values() for u in v)})
    data = [(u, f"u{u}", 100, *((node or {}).get(u, 0) if c == "node_created" else more.get(c, {}).get(u, 0) for c in COUNTERS)) for u in uids]
    return spark.createDataFrame(data, "uid long, username string, first_seen_day int, " + ", ".join(f"{c} long" for c in COUNTERS))


def test_change_classes(spark):
    df = spark.createDataFrame([(True, 1), (True, 2), (False, 1), (False, 3)], "visible boolean, version int")
    assert [r[0] for r in df.select(edits.change()).collect()] == ["created", "modified", "deleted", "deleted"]
    assert edits.without_creates(df).count() == 3


def test_percentiles_and_score(spark):
    got = activity.ranking(users(spark, {1: 5, 2: 5, 3: 7, 4: 9}))
    assert [(r.uid, round(r.node_pct, 2), r.ranking) for r in got.orderBy("uid").collect()] == [(1, 0, 0), (2, 0, 0), (3, 66.67, 13), (4, 100, 20)]
    assert [(r.aspect, r.active, r.most) for r in activity.ranking_stats(users(spark, {1: 5, 2: 5, 3: 7, 4: 9})).where("aspect = 'node'").collect()] == [("node", 4, 9)]
    assert [(r.uid, r.node_pct, r.ranking) for r in activity.ranking(users(spark, {1: 4, 2: 0})).orderBy("uid").collect()] == [(1, 100, 20), (2, 0, 0)]
    three = {1: 8, 2: 7, 3: 6, 4: 5}
    assert [r.ranking for r in activity.ranking(users(spark, three, way_created=three, relation_created=three)).orderBy("uid").collect()] == [52, 35, 17, 0]


def test_ranking_table(spark):
    got = activity.ranking(users(spark, {1: 10, 2: 5, 3: 5}, way_created={3: 1}, relation_created={4: 7}, tag_building={1: 3}, tag_highway={2: 2}))
    assert [r.ranking for r in got.orderBy("uid").collect()] == [24, 4, 20, 12]


def test_user_days_and_totals(spark):
    v = spark.createDataFrame([(1, "", 5, 1, 0, True, 1, [("building", "yes")]), (1, "b", 5, 2, 0, True, 2, [("building", "yes")]), (1, "a", 5, 3, 1, False, 4, []), (1, "", 6, 4, 2, True, 1, [("name", "x"), ("sport", "y")]), (2, "", 6, 5, 0, True, 1, [])], VERSION)
    days = activity.user_days(v)
    r = days.where("uid = 1 and day = 5").first()
    assert (r.username, r.node_created, r.node_modified, r.way_deleted, r.tag_building) == ("b", 1, 1, 1, 1)
    assert rows(activity.history(days)) == [(1, 5, 3, 0), (1, 6, 1, 0), (2, 6, 1, 0)]
    t = {x.uid: x for x in activity.totals(days).collect()}
    assert (t[1].username, t[1].first_seen_day, t[1].tag_sport, t[2].username) == ("b", 5, 1, "<2>")
    both = {x.uid: x for x in activity.merged_totals(activity.totals(days), activity.totals(days)).collect()}
    assert both[1].node_created == 2 and both[1].username == "b" and both[2].username == "<2>"


def test_cube_merge_and_nodes(spark):
    c = lambda d: spark.createDataFrame(d, "cell long, day int, count long")
    assert rows(cube.merged(c([(1, 1, 3), (2, 2, 5)]), c([(1, 1, 7), (3, 3, 2)]))) == [(1, 1, 10), (2, 2, 5), (3, 3, 2)]
    n = spark.createDataFrame([(1, 1, True, 10, 5), (1, 2, True, 11, 6), (1, 3, False, 12, None), (2, 1, False, 10, None), (3, 1, True, 9, None), (4, 2, False, 9, 8)], "id long, version int, visible boolean, day int, cell long")
    assert rows(cube.counted(cube.node_events(n))) == [(5, 10, 1), (6, 11, 1), (6, 12, 1), (8, 9, 1)]
    assert rows(cube.positions(n)) == [(1, 10, 5), (1, 11, 6), (4, 9, 8)]
    assert rows(cube.last_positions(cube.positions(n))) == [(1, 6), (4, 8)]


def test_ways(spark):
    h = spark.createDataFrame([(1, 10, 5), (2, 10, 5), (3, 12, 7)], "node long, day int, cell long")
    w = spark.createDataFrame([(1, 1, True, 11, [1, 2, 3]), (1, 2, True, 12, [1, 3, 3, 9]), (1, 3, False, 20, []), (1, 4, False, 21, []), (2, 1, True, 11, []), (3, 1, False, 11, [1])], "id long, version int, visible boolean, day int, refs array<long>")
    assert rows(cube.counted(cube.way_events(w, h))) == [(5, 11, 1), (5, 12, 1), (5, 20, 1), (5, 21, 1), (7, 12, 1), (7, 20, 1), (7, 21, 1)]


def test_as_of_is_inclusive(spark):
    a = spark.createDataFrame([(1, 9), (1, 10), (1, 15), (2, 1)], "node long, day int")
    h = spark.createDataFrame([(1, 10, 5), (1, 15, 6)], "node long, day int, cell long")
    assert rows(cube.as_of(a, h, "node", "day", "cell")) == [(1, 10, 5), (1, 15, 6)]


def test_state_views(spark):
    of = lambda d, s="node long, cell long": spark.createDataFrame(d, s)
    base, over, dead, ids = of([(1, 5), (2, 6), (3, 7)]), of([(2, 60), (4, 80)]), of([(3,)], "node long"), of([(1,), (2,), (3,), (4,), (5,)], "node long")
    assert rows(cube.pre_positions(ids, base, over)) == [(1, 5), (2, 60), (3, 7), (4, 80), (5, None)]
    assert rows(cube.post_positions(ids, base, over, dead)) == [(1, 5), (2, 60), (3, None), (4, 80), (5, None)]
    assert rows(cube.compacted(base, over, dead)) == [(1, 5), (2, 60), (4, 80)]


def test_sequential_prior(spark):
    c = spark.createDataFrame([(1, 1, True, 6), (1, 2, True, 7), (1, 3, False, None), (1, 4, True, 8), (1, 5, True, 9)], "node long, ord long, visible boolean, cell long")
    base, over = spark.createDataFrame([(1, 5)], "node long, cell long"), spark.createDataFrame([(1, 55)], "node long, cell long")
    assert [r[-1] for r in rows(cube.sequential_prior(c, base))] == [5, 6, 7, 5, 8]
    assert [r[-1] for r in rows(cube.sequential_prior(c, base, over))] == [55, 6, 7, 5, 8]


HIST = "uid long, change_date int, count long, suspect_flag int"


def test_fold_of_flags(spark):
    assert rows(finalize.folded(spark.createDataFrame([(7, 100, 2, 1), (7, 100, 3, 8)], HIST))) == [(7, 100, 5, 9)]


def test_flags_grow_and_columns_stay(spark):
    d = lambda cols, data: spark.createDataFrame(data, cols)
    hist = finalize.history_merge(d(HIST, [(1, 5, 2, 2), (3, 5, 1, 0)]), d(HIST, [(1, 5, 1, 0), (1, 6, 1, 0), (2, 6, 1, 0), (9, 6, 1, 0)]))
    rank = d("uid long, username string, ranking int", [(1, "a", 4), (2, "b", 5), (3, "c", 1)])
    burst = d("uid long, day int, max_edits_per_hour long, flag int", [(1, 5, 600, 1)])
    moves = d("uid long, day int, far_move_count long, max_move_meters long, flag int", [(1, 5, 5, 55_000, 2), (2, 6, 1, 700, 2)])
    spread = d("uid long, day int, spread_km2 double, flag int", [])
    cover = d("uid long, day int, changed_keys array<string>, flag int", [(2, 6, ["b"], 16)])
    lang = d("uid long, day int, name_lang_events long, flag int", [(2, 6, 3, 32)])
    prev = d("uid long, change_date int, far_move_count long, max_move_meters long, ranking_at_day int", [(1, 5, 2, 900, 3)])
    out = finalize.flagged(hist, rank, burst, moves, spread, cover, lang, prev)
    assert rows(finalize.history_of(out)) == [(1, 5, 3, 3), (1, 6, 1, 4), (2, 6, 1, 50), (3, 5, 1, 0), (9, 6, 1, 4)]
    got = finalize.newest_first(finalize.suspects(out, d("uid long, change_date int, countries array<string>", [(2, 6, ["AA"])]))).collect()
    assert [(r.uid, r.username, r.change_date, r.far_move_count, r.max_move_meters, r.ranking_at_day, r.changed_keys, r.countries) for r in got] == [
        (1, "a", 6, 0, 0, 4, [], []), (2, "b", 6, 1, 700, 5, ["b"], ["AA"]), (9, "<9>", 6, 0, 0, 0, [], []), (1, "a", 5, 2, 900, 3, [], []),
    ]


def test_interval_join_reads_no_cross_product(spark):
    p = spark.createDataFrame([(5,), (20,), (40,), (None,)], "x long")
    i = spark.createDataFrame([(0, 10, "a"), (18, 39, "b")], "lo long, hi long, iso string")
    out = finalize.interval_join(p, i, "x", "lo", "hi", ["iso"], 16)
    assert rows(out) == [(5, "a"), (20, "b"), (40, None), (None, None)]
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()


def test_explore(spark):
    c = cube.by_year(spark.createDataFrame([(1, 19_723, 5), (2, 19_723, 7), (1, 19_725, 1), (9, 19_724, 3)], "cell long, day int, count long"))
    box = explore.in_box(c, spark.createDataFrame([(1,), (9,)], "cell long"), 19_723, 19_724)
    assert rows(explore.by_cell(box)) == [(1, 5), (9, 3)]
    assert rows(explore.rolled_up(box)) == sorted([(None, None, 8), (1, None, 5), (9, None, 3), (None, 19_723, 5), (None, 19_724, 3)], key=lambda t: tuple((x is None, str(type(x)), x) for x in t))
    assert explore.in_box(c, spark.createDataFrame([], "cell long"), 0, 99_999).count() == 0
    assert rows(explore.gap_filled(explore.by_day(c), 19_722, 19_725)) == [(19_722, 0), (19_723, 12), (19_724, 3), (19_725, 1)]
    assert rows(explore.gap_filled(explore.by_day(c), 19_722, 19_723, log=True)) == [(19_722, None), (19_723, 12)]
    assert [r[0] for r in explore.years(c).collect()] == [2024]
    explore.check_query("2024-01-01", "2024-02-01", 12)
    for bad in (("", "2024-01-01", 12), ("2024-02-01", "2024-01-01", 12), ("2024-01-01", "2024-01-02", 11)):
        with pytest.raises(ValueError):
            explore.check_query(*bad)


def test_suspect_filters(spark):
    s = spark.createDataFrame([(1, "Anna", 19_723, 3, 5, ["highway"], ["AA"], 4), (2, "bob", 19_724, 3, 9, [], [], 80)], "uid long, username string, change_date int, suspect_flag int, changes long, changed_keys array<string>, countries array<string>, ranking_at_day int")
    who = lambda **k: [r.uid for r in explore.filtered(s, **k).orderBy("uid").collect()]
    assert who() == [1, 2] and who(date="2024-01-01") == [1] and who(country="aa") == [1] and who(country="none") == [2] and who(user="AN") == [1]
    assert who(keys="HIGH") == [1] and who(uid="2") == [2] and who(least={"changes": 6}) == [2] and who(ranking=(None, 50)) == [1] and who(ranking=(50, None)) == [2]
    assert [r.uid for r in explore.latest(s, 1).collect()] == [2]


def test_centre(spark):
    c = spark.createDataFrame([(1, 1, 3), (2, 1, 1)], "cell long, day int, count long")
    r = cube.spatial_centre(c, spark.createDataFrame([(1, 0.0, 0.0), (2, 40.0, 8.0)], "cell long, lat double, lon double")).first()
    assert (r.lat, r.lon) == (10.0, 2.0)


def test_day_guard(spark):
    from driftline.functions import time

    df = spark.createDataFrame([(70_000,)], "d int")
    with pytest.raises(Exception, match="out of range"):
        df.select(time.checked_day(F.col("d"))).collect()
