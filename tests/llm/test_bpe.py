import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftline.llm import bpe, chunked_bpe, packing, token_counts
from tests.llm.conftest import words


@pytest.fixture(scope="module")
def ref():
    t = Tokenizer.from_file(bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(ref, text):
    return ref.encode(text or "", add_special_tokens=False).ids


TEXTS = ["", " ", "\n\n  a", "it's we'll I'D", "a" * 5_000, " " * 3_000, "ab1" * 2_000, "日本語 テスト\u3000x", "e\u0301\u200d\U0001f469\u200d\U0001f467", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "<|endoftext", "tab\there\r\nnew\x0b\x0c \u00a0\u2003z", "\x1c\x1d\x85 q"]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(ref, text):
    b = bpe.load(bpe.default_path())
    ids = ids_of(ref, text)
    assert b.encode(text) == ids
    assert b.decode_bytes(ids).decode() == ref.decode(ids, skip_special_tokens=False)
    assert chunked_bpe.ChunkCoder(bpe.default_path()).encode(text) == ids
    assert sum(len(b.encode(p)) for p in bpe.pieces(text, 100)) == len(ids)


def test_decodes_ids_that_are_no_text(ref):
    b, r = bpe.load(bpe.default_path()), random.Random(1)
    for _ in range(200):
        ids = [r.randrange(50_257) for _ in range(r.randrange(1, 12))]
        assert b.decode_bytes(ids).decode() == ref.decode(ids, skip_special_tokens=False)


def test_chunks_join_exactly(ref):
    r, coder = random.Random(2), chunked_bpe.ChunkCoder(bpe.default_path(), 1 << 18)
    shared = words(r, 3_000)
    alphabet = "ab1'  \n\té日.!"
    for k in range(40):
        noise = "".join(r.choice(alphabet) for _ in range(r.randrange(3_000)))
        text = noise + shared[r.randrange(5_000) :] + noise[::-1]
        assert coder.encode(text) == ids_of(ref, text), k
    assert coder.hits > 100


def test_chunks_are_shared_and_cut_by_content():
    r = random.Random(3)
    body = words(r, 4_000)
    cut = lambda t: set(chunked_bpe.chunks(t))
    one, two = cut(body), cut("something before it " + body)
    assert len(one & two) > 0.7 * len(one)


def test_join_repairs_a_word_cut_in_two(ref):
    c = chunked_bpe.ChunkCoder(bpe.default_path())
    left, right = "the first and second wor", "d of all these words here"
    assert c.join(left, c.chunk(left), right, c.chunk(right)) == ids_of(ref, left + right)


def test_shared_chunks_are_encoded_once(spark, docs, ref):
    """Texts share passages across partitions, repeat as a whole, and hold added tokens: all ids are the library's."""
    r = random.Random(14)
    body = words(r, 3_000)
    texts = [words(r, r.randrange(200)) + body[a : a + 6_000] + r.choice(["", "<|endoftext|>"]) + words(r, r.randrange(200)) for a in range(0, 9_000, 700)] * 2 + ["", None, "<|endoftext|>", body, body]
    df = docs(texts).repartition(5)
    given = chunked_bpe.shared_ids(chunked_bpe._source(df, "doc_id", "text"), bpe.default_path())
    told = chunked_bpe.report(df)
    assert given.count() > 10 and told["distinct"] < 0.5 * told["chunks"] < told["shared"] <= told["chunks"]
    assert not given.selectExpr("explode(given) g").groupBy("g.digest").agg(F.countDistinct("g.ids").alias("k")).where("k > 1").count()
    for x in given.collect():
        assert len({g.digest for g in x.given}) == len(x.given)
    got = {x.doc_id: list(x.ids) for x in chunked_bpe.encode_decode(df, keep_ids=True).collect()}
    assert all(got[i] == ids_of(ref, t) for i, t in enumerate(texts)) and len(got) == len(texts)


def test_op1_rows(spark, odd, ref):
    got = sorted(tuple(r) for r in chunked_bpe.encode_decode(odd).collect() if r.doc_id is not None)
    want = []
    for i, t in odd.select("doc_id", "text").collect():
        ids = ids_of(ref, t)
        if i is not None:
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert chunked_bpe.encode_decode(odd.limit(0)).count() == 0
    full = chunked_bpe.encode_decode(odd, keep_ids=True).where("doc_id = 9").first()
    assert full.decoded == "héllo wörld 日本" and list(full.ids) == ids_of(ref, full.decoded)


def test_op7_rows(spark, odd, ref):
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(odd, batch_bytes=1_000).collect() if r.doc_id is not None)
    want = sorted((i, len((t or "").encode()), len(ids_of(ref, t)), len(ids_of(ref, t)) > 512) for i, t in odd.select("doc_id", "text").collect() if i is not None)
    assert got == want
    assert token_counts.token_counts(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(name)
    texts = ["Hello there, world", "", "x" * 100]
    if name.endswith(".model"):
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.counter(path)(texts) == want


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(1, 4) == [(0, 1)]


def test_best_fit_is_as_good_as_best_fit():
    r = random.Random(5)
    for _ in range(30):
        sizes = [r.randrange(1, 60) for _ in range(r.randrange(1, 120))]
        bins = packing.best_fit(sizes, 64)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        fill = [sum(sizes[i] for i in b) for b in bins]
        assert max(fill) <= 64 and sum(sorted(fill)[:2]) > 64 * (len(fill) > 1)
        plain: list[int] = []
        for n in sorted(sizes, reverse=True):
            fits = [i for i, f in enumerate(plain) if f + n <= 64]
            if fits:
                plain[max(fits, key=lambda i: plain[i])] += n
            else:
                plain.append(n)
        assert len(bins) == len(plain)


def check_packing(got, texts, ref, length):
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        ids, at = np.array([*ids_of(ref, t), 0], "<u4"), 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            assert r.length == length or k == 0
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_seq)


@pytest.mark.parametrize("options", [{}, {"slack": 0, "fan_in": 2}])
def test_packing_rows(spark, docs, ref, options):
    r = random.Random(8)
    texts = [words(r, r.choice([0, 3, 20, 60, 300])) for _ in range(120)] + [None, ""]
    df = docs(texts).repartition(5)
    n = check_packing(packing.pack(df, length=128, **options).collect(), dict(enumerate(texts)), ref, 128)
    total = sum(len(ids_of(ref, t)) + 1 for t in texts)
    assert n <= 1.1 * total / 128 + 2


def test_packing_saves_as_much_as_if_all_bins_travelled(spark, docs, ref, monkeypatch):
    r = random.Random(12)
    texts = [words(r, r.choice([2, 9, 14, 25])) for _ in range(300)]
    df = docs(texts).repartition(40)
    some = packing.pack(df, length=128, fan_in=2, slack=0).select("sequence_id").distinct().count()
    monkeypatch.setattr(packing, "_ranks", lambda fills, capacity, slack: [0 if capacity > f else -1 for f in fills])
    every = packing.pack(df, length=128, fan_in=2, slack=0).select("sequence_id").distinct().count()
    assert some <= every + 1


def test_packing_odd(spark, odd):
    got = packing.pack(odd)
    assert got.select("doc_id").distinct().count() == 11 and got.where("doc_id = 0").first().length == 1
    assert packing.pack(odd.limit(0)).count() == 0
