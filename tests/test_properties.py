"""Relations that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftline.operators import activity, cube, screens
from driftline.operators.windows import trailing_sum
from driftline.streaming import incremental
from tests.conftest import rows

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
minute = st.integers(0, 400)
edits = st.dictionaries(minute, st.integers(1, 9), min_size=1, max_size=25)
keyed = st.dictionaries(st.tuples(minute, st.sampled_from("abc")), st.integers(1, 9), min_size=1, max_size=25)


@FEW
@given(edits, st.sampled_from([60, 90, 500]))
def test_trailing_sum(spark, data, bucket):
    df = spark.createDataFrame([(1, m, n) for m, n in data.items()], "uid long, minute long, n long")
    assert rows(trailing_sum(df, bucket=bucket).select("minute", "hour")) == sorted((m, sum(n for t, n in data.items() if m - 60 < t <= m)) for m in data)


@FEW
@given(edits, keyed)
def test_coverage(spark, data, keys):
    df = spark.createDataFrame([(1, m, n) for m, n in data.items()], "uid long, minute long, n long")
    kf = spark.createDataFrame([(1, m, k, n) for (m, k), n in keys.items()], "uid long, minute long, key string, n long")
    want = []
    for m in sorted({*data, *(t for t, _ in keys)}):
        total = sum(n for t, n in data.items() if m - 60 < t <= m)
        for k in "abc":
            n = sum(v for (t, x), v in keys.items() if x == k and m - 60 < t <= m)
            if total >= 5 and n > 0.9 * total:
                want.append((1, m, total, k, n))
    assert rows(screens.coverage_minutes(kf, df, objects=5, bucket=120).select("uid", "minute", "total", "key", "n")) == want


@FEW
@given(st.lists(st.integers(0, 6), min_size=1, max_size=12))
def test_percentiles(spark, totals):
    df = spark.createDataFrame([(i, "node", t) for i, t in enumerate(totals)], "uid long, aspect string, total long")
    live = [t for t in totals if t]
    want = [0.0 if not t else 100.0 if len(live) == 1 else 100.0 * sum(x < t for x in live) / (len(live) - 1) for t in totals]
    assert [r.pct for r in activity.percentiles(df).orderBy("uid").collect()] == want


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=10, unique=True), st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=10, unique=True))
def test_as_of(spark, left, right):
    a = spark.createDataFrame(left, "node long, day int")
    b = spark.createDataFrame([(n, d, i) for i, (n, d) in enumerate(right)], "node long, day int, cell long")
    want = []
    for n, d in left:
        fit = [(e, i) for i, (m, e) in enumerate(right) if m == n and e <= d]
        if fit:
            want.append((n, d, max(fit)[1]))
    assert rows(cube.as_of(a, b, "node", "day", "cell")) == sorted(want)


@given(st.lists(st.tuples(st.integers(0, 20_000), st.integers(0, 4_000)), max_size=12), st.integers(0, 9_000))
def test_batches_keep_order(spans, width):
    plan = incremental.batches([(i, a, a + w) for i, (a, w) in enumerate(spans)], width)
    assert [s for b in plan for s in b] == list(range(len(spans)))
    for b in plan[:-1]:
        assert max(spans[s][0] + spans[s][1] for s in b) - min(spans[s][0] for s in b) >= width
