import random

import numpy as np
import pytest

from driftline.llm import quality, topk, toxicity, urls, words
from driftline.llm.common import table


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["The  quick\nfox", "", "the quick fox", "x", " é a"]
    got = list(words.of_texts(pa.array(texts)))
    assert [len(g) for g in got] == [3, 0, 3, 1, 2] and (got[0] == got[2]).all() and got[0][0] != got[0][1]
    big = ["alpha beta " * 40_000, None, "alpha beta"]
    got = list(words.of_texts(pa.array(big)))
    assert len(got[0]) == 80_000 and len(got[1]) == 0 and (got[0][:2] == got[2]).all()
    assert len(words.shingles(got[2], 5)) == 1 and len(words.shingles(got[0], 5)) == 79_996


@pytest.mark.parametrize("slice_", [1, 7, 50, 10_000])
def test_long_texts_in_slices(monkeypatch, slice_):
    import pyarrow as pa

    r = random.Random(5)
    texts = ["".join(r.choice("ab é\n .") for _ in range(r.randrange(120))) for _ in range(30)] + ["", "x" * 90, " " * 40]
    _, _, raw, off = next(words.blocks(pa.array(texts)))
    for space in (words.SPACE, words.NO_WORD):
        monkeypatch.setattr(words, "SLICE", 1 << 30)
        want = words.word_hashes(raw, off, space, (2, 3))
        monkeypatch.setattr(words, "SLICE", slice_)
        got = words.word_hashes(raw, off, space, (2, 3))
        assert all((a == b).all() for a, b in zip(want[:4], got[:4], strict=True)) and all((a == b).all() for a, b in zip(want[4], got[4], strict=True))
        assert len(words.word_hashes(raw, off, space)) == 4


def test_runs_of_a_block():
    import pyarrow as pa

    r = random.Random(6)
    texts = [" ".join(r.choice("abc") for _ in range(r.choice([0, 1, 4, 5, 6, 40]))) for _ in range(60)]
    for k in (3, 5):
        want = [words.shingles(w, k) for w in words.of_texts(pa.array(texts))]
        got = list(words.shingles_of(pa.array(texts), k))
        assert len(got) == len(want) and all(len(a) == len(b) and (a == b).all() for a, b in zip(got, want, strict=True))


def test_gradient_against_differences():
    r = np.random.default_rng(4)
    net = toxicity.TextCnn(buckets=40, dim=3, widths=(1, 2, 3), filters=2)
    net.start()
    net.table, net.kernels = net.table.astype(np.float64) * 10, [k.astype(np.float64) for k in net.kernels]
    net.bias, net.out, net.off = r.normal(0, 0.3, 6), r.normal(0, 1, 6), -0.3
    sizes = [7, 0, 1, 2, 12]
    ids, first = r.integers(0, 40, (sum(sizes), toxicity.SLOTS)), np.concatenate([[0], np.cumsum(sizes)])
    y, weight = np.array([1, 0, 1, 0, 1]), np.array([3.0, 1, 3, 1, 3])
    _, grads, off = net.gradient(ids, first, y, weight)
    at = lambda: net.gradient(ids, first, y, weight)[0]
    for p, g in zip([net.table, *net.kernels, net.bias, net.out], grads, strict=True):
        for k in r.choice(p.size, min(p.size, 25), replace=False):
            place = np.unravel_index(k, p.shape)
            if p is net.table and place[0] == net.buckets:
                continue  # the pad stays zero
            old = p[place]
            p[place] = old + 1e-6
            more = at()
            p[place] = old - 1e-6
            less = at()
            p[place] = old
            assert abs((more - less) / 2e-6 - g[place]) < 1e-5
    net.off += 1e-6
    more = at()
    net.off -= 2e-6
    assert abs((more - at()) / 2e-6 - off) < 1e-5


def test_training_words_are_bounded(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    every, _ = toxicity.sampled(docs, labels, "doc_id", "text", "toxic", 6_000, 1 << 40)
    some, y = toxicity.sampled(docs, labels, "doc_id", "text", "toxic", 6_000, 2_000)
    assert 0 < len(some) == len(y) < len(every) and sum(len(t) for t in some) <= 2_000 and all((a == b).all() for a, b in zip(some, every, strict=False))
    assert toxicity.sampled(docs, labels, "doc_id", "text", "toxic", 6_000, 0)[0] == []


def test_gradient_of_the_network():
    """Loss falls, and a word seen only in one class decides."""
    import pyarrow as pa

    r = random.Random(1)
    texts, y = [], []
    for k in range(240):
        w = [f"n{r.randrange(300)}" for _ in range(40)]
        if k % 4 == 0:
            w[r.randrange(40)] = "badword"
        texts.append(" ".join(w))
        y.append(int(k % 4 == 0))
    got = [(i, f) for i, f in toxicity.bucket_ids(pa.array(texts), toxicity.BUCKETS)]
    ids, first = got[0]
    each = [ids[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    net = toxicity.TextCnn()
    net.fit(each[:200], np.array(y[:200]))
    net.calibrate(each[:200], np.array(y[:200]))
    s = net.scores(np.concatenate(each[200:]), np.concatenate([[0], np.cumsum([len(e) for e in each[200:]])]))
    assert ((s >= 0.5) == np.array(y[200:])).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = toxicity.op2_toxicity_cnn(spark, d).join(table(spark, d, "labels"), "doc_id").where("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert toxic.predicted.mean() > 0.8 and clean.predicted.mean() < 0.02 and got.score.between(0, 1).all()


def test_toxicity_odd(spark, odd, sf):
    labels = table(spark, sf, "labels")
    net = toxicity.train(table(spark, sf, "documents"), labels)
    got = toxicity.score(odd.select("doc_id", "text"), net)
    assert got.count() == 13 and got.where("score is null or not score between 0 and 1").count() == 0
    assert toxicity.score(odd.drop("score").limit(0), net).count() == 0
    with pytest.raises(ValueError):
        toxicity.score(odd, net)
    none = toxicity.train(odd, labels.limit(0))
    assert {r.score for r in toxicity.score(odd.select("doc_id", "text"), none).collect()} == {0.0}


def test_languages_come_from_the_text():
    import pyarrow as pa

    got = next(toxicity.bucket_ids(pa.array(["the cat of it", "le chat et la", "der hund und", "el perro y las", "zzz", ""]), toxicity.BUCKETS))
    assert list(toxicity.TextCnn().languages(*got)) == [0, 1, 2, 3, 4, 4]


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = quality.op6_quality_bayes(spark, d).join(table(spark, d, "labels"), "doc_id").where("held_out").toPandas()
    assert (got.keep == (got.quality == 1)).mean() > 0.95 and got[got.quality == 1].keep.mean() > 0.98


def test_sparse_sites_shrink(spark):
    docs = spark.createDataFrame([(i, "", "p", "big" if i < 400 else "small" if i < 402 else "new") for i in range(403)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1 if i < 200 else 0) for i in range(402)], "doc_id long, quality int")
    s = {(r.host, r.path): r.share for r in quality.site_posteriors(docs, labels, "doc_id", "quality", "source", "lang").collect()}
    assert abs(s["big", "p"] - 0.5) < 0.02 and 0.2 < s["small", "p"] < 0.5 and abs(s["new", "p"] - 0.5) < 0.02


def plain_measures(text):
    import math
    import re
    from collections import Counter

    b = (text or "").encode()
    size, w = max(1, len(b)), [x for x in re.split(rb"[\x20\t-\r]+", bytes(c + 32 if 65 <= c <= 90 else c for c in b)) if x]
    share = lambda kind: sum(map(kind, b)) / size
    letter = lambda c: c < 128 and chr(c).isalpha()
    out = [share(lambda c: 65 <= c <= 90), share(lambda c: 97 <= c <= 122), share(lambda c: 48 <= c <= 57), share(lambda c: c >= 128)]
    out += [share(lambda c: 33 <= c < 128 and not letter(c) and not 48 <= c <= 57 and c not in b".,"), share(lambda c: c in b".,"), share(lambda c: c == 10)]
    n = len(w)
    out += [math.log1p(n), math.log1p(max(0, size - n) / max(1, n))]
    if not n:
        return out + [0.0] * 5
    runs = {tuple(w[i : i + 3]) for i in range(max(1, n - 2))}
    return out + [len(set(w)) / n**0.75, max(Counter(w).values()) / n, (n - len(runs)) / n, sum(a == z for a, z in zip(w, w[1:], strict=False)) / (n - 1) if n > 1 else 0, sum(len(x) <= 1 for x in w) / n]


def test_quality_against_plain_python(spark, sf):
    """Evidence, posteriors of sites and scores, computed anew without Spark or numpy blocks."""
    import math

    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.train(docs, labels, "doc_id", "text", "quality")
    good = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1)}
    rows = docs.collect()
    sites, hosts = {}, {}
    for r in rows:
        if r.doc_id in good:
            for at, k in ((sites, (r.source or "", r.lang or "")), (hosts, r.source or "")):
                n, g = at.get(k, (0, 0))
                at[k] = n + 1, g + good[r.doc_id]
    p0 = (sum(g for _, g in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)

    def weight(counts, prior):
        got = [(n, g / n, prior(k)) for k, (n, g) in counts.items() if n > 1]
        v = sum(n * p * (1 - p) for n, _, p in got)
        if not got or not v:
            return 50.0
        between = max(1e-4, (sum(n * (s - p) ** 2 for n, s, p in got) - sum(p * (1 - p) for _, _, p in got)) / v)
        return min(max(1 / between - 1, 1.0), 1000.0)

    m = weight(hosts, lambda k: p0)
    host_share = {k: (g + m * p0) / (n + m) for k, (n, g) in hosts.items()}
    m = weight(sites, lambda k: host_share[k[0]])
    share = {k: (g + m * host_share[k[0]]) / (n + m) for k, (n, g) in sites.items()}
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    for r in rows:
        x = plain_measures(r.text)
        z = [max(-8.0, min(8.0, (v - a) / b)) for v, a, b in zip(x + [v * v for v in x], model.mean, model.scale, strict=True)]
        evidence = sum(a * b for a, b in zip(z, model.weights, strict=True)) + model.offset - model.base
        s = share.get((r.source or "", r.lang or ""), host_share.get(r.source or "", p0))
        score = 1 / (1 + math.exp(-(evidence + math.log(s / (1 - s)))))
        assert abs(got[r.doc_id].evidence - evidence) < 1e-6 and abs(got[r.doc_id].site_share - s) < 1e-9 and abs(got[r.doc_id].score - score) < 1e-6


def test_quality_odd(spark, odd, sf):
    labels = table(spark, sf, "labels")
    got = quality.quality(odd, labels)
    assert got.count() == 13 and got.where("score is null").count() == 0
    assert quality.quality(odd.limit(0), labels).count() == 0
    assert {r.evidence for r in quality.quality(odd, labels.limit(0)).collect()} == {0.0}


def scores(vectors, k=20, every=20):
    fine = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(fine):
        if i % every == 0:
            got = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j) for b, (j, w) in enumerate(fine) if b != a and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(got)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(16_384, 2_048), (37, 2)])
def test_top_k(spark, blocks):
    r = np.random.default_rng(3)
    v = [(i, [float(np.float32(x)) for x in r.normal(0, 0.2, 6)]) for i in range(300)]
    v += [(400 + i, [0.125, 0.0, -0.125, 0.25, 0.0, 0.0]) for i in range(60)]
    v += [(500, None), (501, [None] * 6), (520, [float("nan")] * 6), (521, [float("inf")] * 6), (None, [0.1] * 6), (540, [0.5, 0.5]), (541, [0.5, -0.5]), (560, []), (7, [0.3] * 6)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    got = topk.exact_top_k(df, candidates=blocks[0], queries=blocks[1])
    assert sorted(tuple(x) for x in got.collect()) == scores([(i, None if w is None else [None if x is None else float(np.float32(x)) for x in w]) for i, w in v])


def test_threshold_stops_early():
    c = np.array([[100, 0]] * 5 + [[1, 1]] * 5_000)
    r, i, s = topk.threshold(c, np.array([[3, 0]]), np.array([-1]), 5)
    assert sorted(i) == [0, 1, 2, 3, 4] and set(s) == {300}


def test_threshold_with_large_numbers():
    c = np.array([[1 << 40, 5], [1 << 40, 6], [3, 3]], np.int64)
    r, i, s = topk.threshold(c, np.array([[1 << 20, 1]], np.int64), np.array([-1]), 2)
    assert sorted(zip(i, s, strict=True)) == [(0, (1 << 60) + 5), (1, (1 << 60) + 6)]


def test_the_kth_score_goes_along(spark):
    """On clustered vectors most pairs of other blocks are never scored; the result stays that of all pairs."""
    r = np.random.default_rng(1)
    centres = r.normal(0, 1, (40, 8))
    v = [(i, [float(x) for x in (lambda y: y / np.linalg.norm(y))(centres[i % 40] + r.normal(0, 0.05, 8))]) for i in range(1_600)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, candidates=100, queries=20)
    assert sorted(tuple(x) for x in got.collect()) == scores(v)
    told = topk.report(df, candidates=100, queries=20)
    assert told["pairs"] == 80 * 1_599 and told["scored"] < 0.6 * told["pairs"]


def test_floor_leaves_out_what_cannot_win():
    c = np.array([[9, 0], [8, 0], [7, 0], [1, 5]])
    r, i, s, scored = topk.search(c, np.array([[1, 0]]), np.array([-1]), 2, depth=1, floor=np.array([8], object))
    assert sorted(zip(i, s, strict=True)) == [(0, 9), (1, 8)] and scored < 4
    assert topk.search(c, np.array([[1, 0]]), np.array([-1]), 2, floor=np.array([10], object))[3] == 0


def test_top_k_of_nothing(spark):
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_url_rules(spark):
    u = ["http://www.Example.com/en/1", "https://a.example.com/en/x?q", "http://example.com/fr/", "http://example.com", "http://shop.net/es/9#t", "http://net/es/9", "http://internet/es/9", "x", None, "ftp://a.com/?b://c", "//x.com/"]
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(u)], "page_id long, url string, host int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(df).collect()}
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[2][2:] == ("com/", "allow") and got[3] == ("example.com", "", None, "allow")
    assert got[4] == ("shop.net", "/es/9", "net/es/", "block") and got[5][2] == "net/es/" and got[6][2] is None
    assert got[7] == got[8] == ("", "", None, "allow") and got[9] == ("a.com", "/", "com/", "allow") and got[10][0] == ""
    assert urls.url_filter(df.limit(0)).count() == 0


def test_url_templates_reject_by_labels(spark):
    rows = [(i, f"http://h.net/es/{i}") for i in range(40)] + [(100, "http://h.net/es"), (101, "http://h.net/de/5"), (102, "http://other.org/es/1")]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[0] == ("net/es/", "block") and got[100] == (None, "block") and got[101] == (None, "allow") and got[102] == (None, "allow")


def test_url_templates_of_deep_paths(spark):
    """The branch that decides is the fifth segment; very long paths, null and repeated ids and empty tables have their rows."""
    rules = [("h.net/x/a/b/c/bad/", "block"), ("h.net/x/a/b/c/good/", "allow")]
    rows = [(i, f"http://h.net/x/a/b/c/bad/p{i}z") for i in range(28)] + [(100 + i, f"http://h.net/x/a/b/c/good/q{i}") for i in range(20)]
    rows += [(200, "http://h.net/x/a/b/c/bad"), (201, "http://h.net/x/a/b/c/good"), (202, "http://h.net/x/a/b/c/other/1"), (203, "http://h.net/" + "s/" * 5_000 + "t" * 50_000), (None, "http://h.net/x/a/b/c/bad#x"), (200, "http://h.net/x"), (None, None)]
    got = [(r.page_id, r.rule, r.verdict) for r in urls.url_filter(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()]
    assert len(got) == len(rows) and sorted(v for i, _, v in got if i == 200) == ["allow", "block"] and sorted(v for i, _, v in got if i is None) == ["allow", "block"]
    by = {i: v for i, _, v in got}
    assert by[201] == by[202] == by[203] == "allow" and by[5] == "block" and by[105] == "allow"


def test_alike_branches_grow_together(spark):
    """Sparse branches with the same share are one template: what is below them is judged by the labels of all."""
    names = [f"b{k}x" for k in range(7)]
    rules = [(f"h.net/{b}/w/", "block") for b in names] + [(f"h.net/{b}/v/", "allow") for b in names]
    rows = [(k, f"http://h.net/{b}/{s}/d{k}e") for k, (b, s) in enumerate([(b, s) for b in names for s in "wv" for _ in range(2)])] + [(50, "http://h.net/b0x/w"), (51, "http://h.net/b1x/v"), (52, "http://h.net/other/w")]
    by = {r.page_id: r.verdict for r in urls.url_filter(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert by[50] == "block" and by[51] == "allow" and by[52] == "allow"


@pytest.mark.parametrize("name", ["op3_jaccard_join", "op4_threshold_top_k", "op8_url_templates", "op10_exact_dedup"])
def test_against_sql(spark, sf, name):
    import glob
    import os

    import duckdb

    from driftline.llm import queries

    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got = queries.queries()[name](spark, sf)
    want = con.execute(queries.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    key = lambda rows, names: sorted(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in rows)
    assert key([tuple(r) for r in got.collect()], got.columns) == key(want.fetchall(), cols)


def test_every_label_counts(spark):
    """Of 9,000 labelled texts, those after the first 6,000 in order of a hash have a word of their own that decides."""
    from pyspark.sql import functions as F

    rank = {r.doc_id: k for k, r in enumerate(spark.range(9_000).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect())}
    r = random.Random(9)
    rows = [(i, int(r.random() < 0.2)) for i in range(9_000)]
    text = lambda i, y: " ".join([f"n{r.randrange(200)}" for _ in range(4)] + y * ["early" if rank[i] < 6_000 else "later"])
    docs = spark.createDataFrame([(i, text(i, y)) for i, y in rows], "doc_id long, text string")
    net = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    new = spark.createDataFrame([(0, "n1 n2 n3 later"), (1, "n1 n2 n3 early"), (2, "n1 n2 n3 n4")], "doc_id long, text string")
    assert [r.score >= 0.5 for r in toxicity.score(new, net).orderBy("doc_id").collect()] == [True, True, False]


def test_training_does_not_depend_on_partitions(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    one, other = (toxicity.train(docs.repartition(k), labels, shard=20, rounds=2) for k in (1, 7))
    assert (one.flat() == other.flat()).all() and (one.shift == other.shift).all()
