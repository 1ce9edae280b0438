import itertools
import random
import re

import pytest

from driftline.llm import exact_dedup, graph, jaccard_join, substring_dedup
from driftline.llm.common import table
from tests.llm.conftest import words


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_trie():
    t = exact_dedup.RadixTrie()
    data = [b"", b"a", b"abc", b"abd", b"ab", b"b" * 5_000, b"b" * 4_999 + b"c", b"abcde"]
    first = [t.insert(s) for s in data]
    assert len(set(first)) == len(data) and [t.insert(s) for s in data] == first


@pytest.mark.parametrize("budget", [1 << 30, 20_000, 2_000])
def test_owners_with_spill(budget):
    r = random.Random(budget)
    base = [bytes(r.choice(b"ab") for _ in range(r.randrange(0, 12))) + b"tail" * r.randrange(3) for _ in range(150)]
    rows = [(r.choice(base), g, r.randrange(1_000) if r.random() < 0.9 else None, r.randrange(1, 4)) for g in range(600)]
    found = exact_dedup.Owners(budget)
    for x in rows:
        found.add(*x)
    assert budget > 50_000 or found.spilled
    got = {g: (i, n, f) for g, i, n, f in found.results()}
    assert len(got) == 600
    for s in {x[0] for x in rows}:
        own = [x for x in rows if x[0] == s]
        least = min((x[2] for x in own if x[2] is not None), default=None)
        assert {got[x[1]][:2] for x in own} == {(least, sum(x[3] for x in own))}
        assert [got[x[1]][2] for x in own].count(True) == 1
        assert all(x[2] == least for x in own if got[x[1]][2])


def test_exact_rows(spark, docs):
    r = random.Random(1)
    pool = [words(r, 5, 4) for _ in range(40)] + [None, "", " "]
    texts = [(lambda t: t and t.replace(" ", r.choice([" ", "  ", "\n", "\t "])))(r.choice(pool)) for _ in range(300)]
    got = {x.doc_id: x for x in exact_dedup.exact_dedup(docs(texts).repartition(6)).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if normal(u) == normal(t)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(same), len(same), i == min(same))


def test_exact_odd(spark, odd):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == 13 and sum(r.kept for r in got) == len({normal(r.text) for r in odd.collect()})
    assert {r.keep_id for r in got if r.doc_id is None} == {None, 0}
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1_000, 1_200)] + [(5, 5)]
    par = {}

    def find(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    for a, b in edges:
        if a != b:
            u, v = find(a), find(b)
            par[max(u, v)] = min(u, v)
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {x.node: x.comp for x in got.collect()} == {x: find(x) for x in par}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(texts, k=5, part=80):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = {i: grams(t) for i, t in texts.items()}
    par = {i: i for i in texts}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= part * len(x | y):
            u, v = find(a), find(b)
            par[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), find(i)) for i in texts}


def near_copies(r):
    out = []
    for _ in range(25):
        w = words(r, r.choice([1, 3, 5, 6, 9, 30, 80, 200])).split()
        for _ in range(r.randrange(1, 8)):
            v = list(w)
            for _ in range(r.randrange(0, 1 + len(w) // 20)):
                v[r.randrange(len(v))] = "edit" + str(r.randrange(99))
            v += words(r, r.randrange(0, 1 + len(w) // 8)).split()
            out.append(" ".join(v).upper() if r.random() < 0.3 else "  ".join(v))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, docs, seed):
    r = random.Random(seed)
    license_ = words(r, 40)
    texts = near_copies(r) + [license_ + " " + words(r, 30) for _ in range(15)] + [license_ + " " + words(r, 3) for _ in range(10)] + [None, "", "one", "one", "two words"]
    got = jaccard_join.jaccard_components(docs(texts).repartition(4))
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()} == brute(dict(enumerate(texts)))


@pytest.mark.parametrize("parts,leaf", [(1, 256), (3, 2), (7, 1)])
def test_jaccard_of_repeated_ids(spark, docs, parts, leaf):
    """An id with several texts is one document, however the rows are dealt and the regions split."""
    r = random.Random(17)
    texts = near_copies(r) + [None, "", "one"]
    rows = [(r.randrange(len(texts)) if r.random() < 0.3 else i, t) for i, t in enumerate(texts)] + [(7, "w1a " * 9), (7, texts[3])]
    nodes = brute({n: t for n, (_, t) in enumerate(rows)})
    par = {i: i for i, _ in rows}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for n, (i, _) in enumerate(rows):
        u, v = find(i), find(rows[nodes[n][1]][0])
        par[max(u, v)] = min(u, v)
    got = jaccard_join.jaccard_components(docs(rows).repartition(parts), leaf=leaf).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted((i, nodes[n][0], find(i)) for n, (i, _) in enumerate(rows))


def test_jaccard_example_of_a_lost_link(spark, docs):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t u v"
    for parts in (1, 3):
        got = jaccard_join.jaccard_components(docs([(7, a), (7, b), (9, b + " more")]).repartition(parts)).collect()
        assert {x.component_id for x in got} == {7}


@pytest.mark.parametrize("leaf", [1, 3, 256])
def test_jaccard_split_regions(spark, docs, leaf):
    """Templates whose fields vary: many share their rarest shingles and few link. Any size of leaf gives the same components."""
    r = random.Random(23)
    fields = [[words(r, 6, 90_000) for _ in range(4)] for _ in range(4)]
    texts = [" ".join(r.choice(f) for f in fields) + " " + words(r, r.randrange(0, 4), 90) for _ in range(250)]
    got = jaccard_join.jaccard_components(docs(texts).repartition(3), leaf=leaf)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()} == brute(dict(enumerate(texts)))


def test_jaccard_odd(spark, odd):
    got = jaccard_join.jaccard_components(odd).collect()
    by = {x.doc_id: x for x in got if x.doc_id is not None}
    assert len(got) == 13 and (by[0].n_shingles, by[0].component_id, by[1].component_id, by[2].n_shingles) == (0, 0, 1, 0)
    assert {by[k].component_id for k in (3, 4, 5)} == {3} and by[7].component_id == 6
    assert jaccard_join.jaccard_components(odd.limit(0)).count() == 0


def test_bands():
    assert substring_dedup.bands_for(0.8, 0.95) == 2 and substring_dedup.bands_for(0.8, 0.8) == 1 and substring_dedup.bands_for(0.5, 0.99) == 7


def test_passages_are_found_and_clean_texts_left(spark, docs):
    r = random.Random(9)
    passages = [words(r, n, 5_000) for n in (51, 55, 60, 80, 120) for _ in range(8)]
    texts, planted = [], {}
    for p in passages:
        for _ in range(r.randrange(2, 5)):
            planted.setdefault(p, []).append(len(texts))
            texts.append(words(r, r.randrange(5, 150), 5_000) + " " + p + " " + words(r, r.randrange(5, 150), 5_000))
    clean = range(len(texts), len(texts) + 60)
    texts += [words(r, 200, 5_000) for _ in clean]
    df = docs(texts).repartition(3)
    spans = substring_dedup.repeated_spans(df).collect()
    hit = {s.doc_id for s in spans}
    want = {i for ids in planted.values() for i in ids[1:]}
    assert not hit & set(clean) and hit <= want and len(want - hit) <= 0.03 * len(want)
    for s in spans:  # paragraphs at the ends may be near copies: a word more or less
        cut, keep = texts[s.doc_id].encode()[s.start : s.end].decode().split(), set(texts[s.keep_id].split())
        assert len(cut) == s.n_words and sum(w in keep for w in cut) >= 0.8 * len(cut)
    left = {x.doc_id: x.text for x in substring_dedup.without_spans(df, substring_dedup.repeated_spans(df)).collect()}
    assert all(left[i] == texts[i] for i in clean) and all(left[ids[0]] == texts[ids[0]] for ids in planted.values())


def cut_paragraphs(texts, num, den, bands):
    """(document, paragraph) of all that go, by all pairs of paragraphs that share a band's key."""
    import numpy as np
    import pyarrow as pa

    from driftline.llm import words as hashed

    places, buckets = [], {}
    for i, w in enumerate(hashed.of_texts(pa.array(texts))):
        at = substring_dedup.starts(w)
        ends = np.append(at[1:], len(w))
        fit, _, keys = substring_dedup.signatures(w, at, bands)
        for f, k in zip(fit.tolist(), keys.tolist(), strict=True):
            for b in range(bands):
                buckets.setdefault((b, k[b]), []).append(len(places))
            places.append((i, f, set(hashed.shingles(w[at[f] : ends[f]]).tolist()), int(ends[f] - at[f])))
    edges = {(x, y) for got in buckets.values() for x, y in itertools.combinations(got, 2) if den * len(places[x][2] & places[y][2]) >= num * len(places[x][2] | places[y][2])}
    comp = list(range(len(places)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for x, y in edges:
        u, v = find(x), find(y)
        comp[max(u, v)] = min(u, v)
    return {p[:2]: p[3] for n, p in enumerate(places) if places[find(n)][0] != p[0]}


@pytest.mark.parametrize("num,den,recall", [(4, 5, 0.95), (1, 2, 0.7), (4, 5, 0.99)])  # two, two and three bands
def test_paragraphs_against_all_pairs(spark, docs, num, den, recall):
    r = random.Random(21)
    texts = []
    for _ in range(60):  # variants ahead of exact copies, and copies with a word more or another word
        p = words(r, r.choice([11, 14, 30, 60]), 9_000).split()
        group = []
        for _ in range(6):
            q = list(p)
            q[r.choice([-1, 0, r.randrange(len(q))])] = "other" + str(r.randrange(99))
            group.append(q)
        group += [p, p, p, p + ["more"], ["more", *p], p[: len(p) // 2] + ["more"] + p[len(p) // 2 :]]
        if r.random() < 0.5:
            r.shuffle(group)
        texts += [words(r, 3, 9_000) + " " + " ".join(q) + " " + words(r, 3, 9_000) for q in group]
    texts += [" ".join([texts[k], texts[k + 1], texts[k]]) for k in range(0, 200, 7)]
    want = cut_paragraphs(texts, num, den, substring_dedup.bands_for(num / den, recall))
    got = substring_dedup.repeated_spans(docs(texts).repartition(5), num=num, den=den, recall=recall, min_words=1).collect()
    assert sum(s.n_paragraphs for s in got) == len(want) and sum(s.n_words for s in got) == sum(want.values())


def test_near_paragraphs(spark, docs):
    r = random.Random(2)
    p = words(r, 400, 9_000).split()
    q = list(p)
    for k in range(0, 400, 25):
        q[k] = "other"
    spans = substring_dedup.repeated_spans(docs([" ".join(p), " ".join(q)])).collect()
    assert {(s.doc_id, s.keep_id) for s in spans} == {(1, 0)} and sum(s.n_words for s in spans) > 100


@pytest.mark.parametrize("turned", [False, True])
def test_spans_of_repeated_ids(spark, docs, turned):
    """Each row of an id is cut by its own spans: no half letters, and nothing of a row that repeats nothing."""
    r = random.Random(31)
    p, own, wide = words(r, 80, 9_000), words(r, 40, 9_000), "é日本ü " * 700
    rows = [(2, wide + "ende"), (2, own + " " + p)]
    df = docs([(1, p)] + (rows[::-1] if turned else rows) + [(3, p + " " + words(r, 30, 9_000))]).repartition(2)
    left = substring_dedup.without_spans(df, substring_dedup.repeated_spans(df)).collect()
    got = {}
    for x in left:
        got.setdefault(x.doc_id, []).append(x.text)
    assert got[1] == [p] and wide + "ende" in got[2] and len(got[2]) == 2
    short = next(t for t in got[2] if t != wide + "ende")
    assert short.startswith(own[:100]) and len(short) < len(own) + 100 and len(got[3][0]) < len(p)


def test_near_recall(spark):
    """Of all pairs of near-equal paragraphs of different documents of sf0.01, found by brute force, at least 95 in 100 share a cluster."""
    import numpy as np

    from driftline.llm import words as hashed

    df = table(spark, "/root/testdata/sf0.01", "documents")
    rows = df.select("doc_id", "text").toArrow()
    sets, index, near = [], {}, set()
    for i, w in zip(rows["doc_id"].to_pylist(), (x for c in rows["text"].chunks for x in hashed.of_texts(c)), strict=True):
        at = substring_dedup.starts(w)
        for a, z in zip(at, np.append(at[1:], len(w)), strict=True):
            if z - a >= 5:
                sets.append((i, frozenset(hashed.shingles(w[a:z]).tolist())))
    for n, (_, s) in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(n)
    for got in index.values():
        firsts = {}
        for n in got:  # of equal sets of a document and of all documents one will do
            firsts.setdefault(sets[n][1], n)
        for a, b in itertools.combinations(sorted(firsts.values()), 2):
            x, y = sets[a], sets[b]
            if x[0] != y[0] and 5 * len(x[1] & y[1]) >= 4 * len(x[1] | y[1]):
                near.add((x[1], y[1]))
    node = lambda s: int((hashed.mix(np.add.reduce(hashed.mix(np.array(sorted(s), np.uint64) ^ hashed.PLACES[29])) + np.uint64(len(s)))).view(np.int64))
    comp = {r.node: r.comp for r in substring_dedup.clusters(df)[1].collect()}
    together = sum(comp.get(node(a), a) == comp.get(node(b), b) for a, b in near)
    assert len(near) > 50 and together >= 0.95 * len(near)


def test_substring_odd(spark, odd):
    spans = substring_dedup.repeated_spans(odd)
    assert {(s.doc_id, s.keep_id) for s in spans.collect()} <= {(7, 6)}
    assert substring_dedup.without_spans(odd, spans).columns == odd.columns
    assert substring_dedup.repeated_spans(odd.limit(0)).count() == 0
    assert substring_dedup.without_spans(odd, spans.limit(0)).count() == 13


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as p

    docs, kept = table(spark, sf, "documents"), {}
    from driftline.llm.common import written

    for name, stage in p.STAGES:
        before = docs
        docs = written(stage(spark, docs, sf), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == before.columns and 0 < docs.count() <= before.count()
    exact = [normal(r.text) for r in kept["exact_dedup"].collect()]
    assert len(exact) == len(set(exact)) == len({normal(r.text) for r in kept["toxicity"].collect()})
    text = {r.doc_id: r.text for r in kept["exact_dedup"].collect()}
    assert {r.doc_id for r in kept["jaccard_join"].collect()} == {c for _, c in brute(text).values()}
    ids = {r.doc_id for r in kept["substring_dedup"].collect()}
    assert {r.doc_id for r in docs.collect()} == ids


def test_pipeline_tells_rows_apart(spark, docs, sf):
    """Null ids and ids with several texts: each row by its own text."""
    import corpus_pipeline as p

    r = random.Random(3)
    a, b, c = words(r, 30, 9_000), words(r, 30, 9_000), words(r, 30, 9_000)
    df = docs([(1, a), (2, a), (2, b), (None, a), (None, c), (None, c.replace(" ", "  ")), (3, c + " x"), (4, b), (1, a)])
    got = sorted(((x.doc_id or 0, x.text) for x in p.exact_stage(spark, df, sf).collect()))
    assert got[0][0] == 0 and normal(got[0][1]) == c and got[1:] == [(1, a), (2, b), (3, c + " x")]
    near = p.near_stage(spark, docs([(1, a), (2, a + " y"), (None, a), (None, b)]), sf).collect()
    assert sorted((x.doc_id or 0, x.text) for x in near) == sorted([(0, a), (0, b), (1, a)])
    wide = "é日本ü " * 700
    cut = p.substring_stage(spark, docs([(1, a + " " + b), (2, wide + "ende"), (2, c + " " + a + " " + b), (None, a)]), sf).collect()
    assert {x.text for x in cut if x.doc_id != 2} == {a + " " + b, a} and {x.text for x in cut if x.doc_id == 2 and "é" in x.text} and len(cut) == 4


def test_pipeline_odd(spark, odd, sf):
    import corpus_pipeline as p

    for _, stage in p.STAGES[:4]:
        got = stage(spark, odd, sf)
        assert got.columns == odd.columns and got.count() >= 6
        assert stage(spark, odd.limit(0), sf).count() == 0
