import random

import pytest

from driftline.operators import screens
from driftline.operators.windows import trailing_sum
from tests.conftest import rows

MIN = "uid long, minute long, n long"
CELL = "uid long, minute long, cell long, n long"
KEY = "uid long, minute long, key string, n long"


def minutes(spark, data):
    return spark.createDataFrame(data, MIN)


def test_trailing_hour(spark):
    got = trailing_sum(minutes(spark, [(1, 5, 100), (1, 35, 400), (1, 65, 150), (2, 10, 100), (2, 70, 250)]))
    assert rows(got.select("uid", "minute", "hour")) == [(1, 5, 100), (1, 35, 500), (1, 65, 550), (2, 10, 100), (2, 70, 250)]


@pytest.mark.parametrize("bucket", [60, 61, 200, 1440])
def test_trailing_hour_in_buckets(spark, bucket):
    r = random.Random(bucket)
    data = [(u, m, r.randint(1, 9)) for u in (1, 2) for m in sorted(r.sample(range(2_000), 200))]
    want = sorted((u, m, sum(k for v, t, k in data if v == u and m - 60 < t <= m)) for u, m, _ in data)
    assert rows(trailing_sum(minutes(spark, data), bucket=bucket).select("uid", "minute", "hour")) == want


def test_burst_days(spark):
    got = screens.burst_days(minutes(spark, [(7, 0, 501), (7, 1440, 500), (8, 2880, 400), (8, 2882, 120)]))
    assert rows(got) == [(7, 0, 501, 1), (8, 2, 520, 1)]
    assert rows(screens.burst_days(minutes(spark, [(3, 5, 700), (3, 10, 100), (3, 200, 1), (3, 210, 640)]))) == [(3, 0, 800, 1)]


def test_burst_over_midnight_lands_on_the_later_day(spark):
    assert rows(screens.burst_days(minutes(spark, [(1, 1430, 400), (1, 1445, 200)]))) == [(1, 1, 600, 1)]


def test_spread(spark):
    cells = spark.createDataFrame([(1, 100, 1, 1), (1, 100, 2, 1), (1, 100, 3, 1)], CELL)
    got = screens.spread_minutes(cells, minutes(spark, [(1, 100, 3), (1, 130, 17)]), 10.0)
    assert rows(got) == [(1, 100, 3, 3, 30.0, False), (1, 130, 20, 3, 30.0, True)]
    late = spark.createDataFrame([(1, 1000, 1, 1), (1, 1000, 2, 1), (1, 1000, 3, 1)], CELL)
    assert not screens.spread_minutes(late, minutes(spark, [(1, 100, 40), (1, 1000, 3)]), 10.0).where("flagged").count()
    many = spark.createDataFrame([(1, 100, c, 1) for c in range(10)], CELL)
    assert not screens.spread_minutes(many, minutes(spark, [(1, 100, 15)]), 2.0).where("flagged").count()


def test_spread_needs_both_tables(spark):
    cells = spark.createDataFrame([(u, 100, c, 7) for u in (10, 20, 40) for c in range(3)], CELL)
    got = screens.spread_days(cells, minutes(spark, [(u, 100, 21) for u in (10, 30, 40)]), 10.0)
    assert [r[0] for r in rows(got)] == [10, 40]


@pytest.mark.parametrize("bucket", [60, 300])
def test_spread_against_brute_force(spark, bucket):
    r = random.Random(3)
    cells = [(1, m, r.randint(1, 6), 1) for m in r.sample(range(900), 150)]
    edits = [(1, m, r.randint(1, 5)) for m in r.sample(range(900), 150)]
    grid = sorted({m for _, m, _, _ in cells} | {m for _, m, _ in edits})
    want = [(1, m, sum(n for _, t, n in edits if m - 60 < t <= m), len({c for _, t, c, _ in cells if m - 60 < t <= m})) for m in grid]
    got = screens.spread_minutes(spark.createDataFrame(cells, CELL), minutes(spark, edits), 10.0, bucket=bucket).select("uid", "minute", "edits", "cells")
    assert rows(got) == want


@pytest.mark.parametrize(("objects", "key", "flag"), [(100, 95, True), (100, 90, False), (100, 89, False), (99, 99, False)])
def test_coverage_gate_and_share(spark, objects, key, flag):
    keys = spark.createDataFrame([(1, 100, "highway", key)], KEY)
    assert bool(screens.coverage_days(keys, minutes(spark, [(1, 100, objects)])).count()) is flag


def test_coverage_over_two_minutes(spark):
    keys = spark.createDataFrame([(1, 100, "highway", 45), (1, 110, "highway", 55)], KEY)
    got = screens.coverage_minutes(keys, minutes(spark, [(1, 100, 50), (1, 110, 60)]))
    assert rows(got) == [(1, 110, 110, "highway", 100)]


def test_a_key_can_qualify_without_a_row_of_its_own(spark):
    keys = spark.createDataFrame([(1, 50, "a", 100), (1, 55, "b", 1)], KEY)
    got = screens.coverage_minutes(keys, minutes(spark, [(1, 0, 100), (1, 50, 100), (1, 65, 1)]))
    assert [(r[1], r[3]) for r in rows(got)] == [(65, "a")]


def test_moves(spark):
    s = spark.createDataFrame([(10, 5, True, 2, 1.0, 1.0, 0.0, 0.0), (10, 6, True, 2, 0.0, 0.00135, 0.0, 0.0), (10, 7, True, 1, 5.0, 5.0, 0.0, 0.0), (10, 8, False, 3, 5.0, 5.0, 0.0, 0.0), (10, 9, True, 3, 5.0, 5.0, None, None)], "uid long, minute long, visible boolean, version int, lat double, lon double, lat0 double, lon0 double")
    got = rows(screens.far_moves(s))
    assert len(got) == 1 and got[0][:2] == (10, 5) and 150_000 < got[0][2] < 165_000
    assert rows(screens.move_days(screens.far_moves(s)))[0][:3] == (10, 0, 1)


TAGS = "array<struct<k:string,v:string>>"
CASES = [
    ([("wikipedia:en", "Rome")], [("wikipedia:it", "Rome")], "wikipedia_swap", "en"),
    ([("name:fr", "A"), ("name:de", "B")], [("name:fr", "A")], "variant_removed", "de"),
    ([("name", "Old town"), ("name:en", "X")], [("name", "Somewhere"), ("name:en", "X")], "name_changed", "en"),
    ([("name", "Old town"), ("name:en", "X")], [("name", "Old towns"), ("name:en", "X")], None, None),
    ([("name", "Old town"), ("name:en", "X")], [("name", "Somewhere"), ("name:en", "X"), ("old_name", "Old town")], None, None),
    ([("name", "N"), ("name:en", "X")], [("name", "N"), ("name:en", "N")], "variant_overwritten", "en"),
    ([("name", "N"), ("name:en", "X")], [("name:en", "X")], "name_deleted", "en"),
    ([("name", "N")], [], None, None),
    ([], [("name", "N"), ("name:en", "N")], "variant_overwritten", "en"),
    ([("alt_name:ja", "日")], [("name", "日")], "variant_removed", "ja"),
]


@pytest.mark.parametrize(("old", "new", "event", "lang"), CASES)
def test_language_rules(spark, old, new, event, lang):
    v = spark.createDataFrame([("node", 1, 1, True, 5, 3, old), ("node", 1, 2, True, 6, 4, new)], f"type string, id long, version int, visible boolean, uid long, day int, tags {TAGS}")
    assert rows(screens.language_events(v)) == ([(6, 4, event, lang)] if event else [])


def test_language_state(spark):
    kind = f"type string, id long, version int, visible boolean, uid long, day int, tags {TAGS}"
    v = spark.createDataFrame([("way", 1, 2, False, 5, 3, []), ("way", 1, 3, True, 6, 4, [("name", "N")])], kind)
    prior = spark.createDataFrame([("way", 1, [("name:de", "N")])], f"type string, id long, tags {TAGS}")
    assert rows(screens.language_events(v, prior)) == []  # a deletion clears what was remembered
    later = spark.createDataFrame([("way", 1, 3, True, 6, 4, [("name", "N")])], kind)
    assert rows(screens.language_events(later, prior)) == [(6, 4, "variant_removed", "de")]
    assert rows(screens.last_tags(later)) == []


def test_language_days(spark):
    c = spark.createDataFrame([(1, 5, "fr", 2), (1, 5, "de", 2), (1, 6, "es", 1)], "uid long, day int, lang string, n long")
    assert rows(screens.language_days(c)) == [(1, 5, 4, "de", 2, 32), (1, 6, 1, "es", 1, 32)]
