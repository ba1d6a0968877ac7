"""Operators 11, 12 and 13 against brute force and the tokenizer library."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.llm import block_search, token_counts, whitening

from .conftest import EXTRA

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def key(r):
    return tuple((x is None, x or 0) for x in r)


# --- 11 -------------------------------------------------------------------------------

VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def check_whitened(spark, rows, k=4):
    df = spark.createDataFrame(rows, VECS).select("*", *[F.lit(None).cast("string").alias(c) for c in ("x", "i", "n", "component", "v")])
    got = whitening.whitened(df).withColumn("deviation", whitening.as_long()).collect()
    usable = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in usable)
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dim - len(v)) for _, v in usable])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, u = np.linalg.eigh(np.cov((fit - s / n).T, bias=True).reshape(dim, dim))
    e, u = e[::-1], u[:, ::-1]
    kept = int((e[:k] > 1e-12 * e.sum()).sum())
    assert len(got) == kept * len(usable)
    want = [(i, d) for (i, _), d in zip(usable, ((n * x - s) ** 2).sum(axis=1).tolist())]
    for c in range(kept):
        own = [r for r in got if r.component == c + 1]
        assert sorted(((r.vec_id, r.deviation) for r in own), key=key) == sorted(want, key=key)
        assert {r.n for r in own} == {n} and all(abs(r.explained - e[c] / e.sum()) < 1e-12 and r.identity_error < 1e-9 for r in own)
        z = (x - s / n) @ u[:, c] / math.sqrt(e[c])
        by = {(i, d): v for (i, d), v in zip(want, z)}  # rows of one id and deviation are copies here
        a, b = np.array([r.whitened for r in own]), np.array([by[r.vec_id, r.deviation] for r in own])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    return got


def test_whitening_against_eigenvectors(spark):
    r = np.random.default_rng(5)
    scale = np.linspace(1.5, 0.5, 48)
    rows = [(i, [float(c) for c in r.standard_normal(48) * scale], 0) for i in range(400)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(200)] + [rows[7], rows[7], (None, rows[8][1], None), (None, rows[8][1], None)]
    rows += [(2000, None, 0), (2001, [None] + rows[0][1][1:], 0), (2002, [math.nan] + rows[0][1][1:], 0), (2003, [math.inf] + rows[0][1][1:], 0)]
    rows += [(2004, [], 0), (2005, rows[9][1][:20], 0)]  # continued with zeros
    check_whitened(spark, rows)


def test_whitening_without_variance(spark):
    assert whitening.whitened(spark.createDataFrame([], VECS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None, 0), (2, [], 0)], VECS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], VECS)).collect() == []
    rows = [(i, [i / 256.0, -i / 128.0, 0.5], 0) for i in range(30)]  # one direction only
    assert {r.component for r in check_whitened(spark, rows)} == {1}


@pytest.mark.parametrize("spectrum", [np.append(np.linspace(1100, 900, 63), 0), np.append([9.0, 5, 3, 2, 1], np.zeros(95)), np.ones(90),
                                      np.concatenate([[50, 20, 10, 10, 10, 10], np.linspace(1.2, 0.8, 100)]), 1 / np.arange(1, 201)])
def test_subspace_iteration_is_certified(spectrum):
    u = np.linalg.qr(np.random.default_rng(2).standard_normal((len(spectrum),) * 2))[0]
    v = u * spectrum @ u.T
    widths = []

    def apply(q):
        widths.append(q.shape[1])
        return v @ q

    e, q, passes = whitening.principal(apply, len(v), 4, float(spectrum.sum()))
    assert passes == len(widths)
    assert np.abs(e - np.sort(spectrum)[::-1][:4]).max() < 1e-12 * spectrum.max()
    assert np.linalg.norm(v @ q - q * e, axis=0).max() < 1e-12 * spectrum.max()


def test_deviation_is_exact_beyond_64_bits(spark):
    rows = [(i, [float(2**40 * (-1) ** i), float(i)], 0) for i in range(64)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whitened(spark.createDataFrame(rows, VECS)).where("component = 1").collect()}
    x = [[int(256 * c) for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x)]
    assert got == {i: sum((64 * c - t) ** 2 for c, t in zip(v, s)) for i, v in enumerate(x)}
    assert whitening.whitened(spark.createDataFrame(rows, VECS)).select(whitening.as_long().alias("d")).where("d is not null").count() == 0


# --- 12 -------------------------------------------------------------------------------

def terms_of(text):
    return TERM.findall((text or "").encode().lower())


def brute_search(docs, items, top=20):
    counts = [collections.Counter(terms_of(t)) for _, t in docs]
    size = [sum(c.values()) for c in counts]
    n, total = sum(s > 0 for s in size), sum(size)
    df = collections.Counter(w for c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for (d, _), c, s in zip(docs, counts, size):
            if not s:
                continue
            m = 75 + 25 * s * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w in terms_of(text) if c[w])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scored)[:top])]
    return out


@pytest.fixture(scope="module")
def items(rows):
    r = random.Random(4)
    texts = [t for _, t, *_ in rows if t]
    words = [w for t in texts for w in t.split()]
    out = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 40)))) for i in range(25)]
    out += [(50 + i, " ".join(r.choice(texts).split()[3:30])) for i in range(10)]  # passages
    return out + [(90, None), (91, ""), (92, "...!"), (93, "nowhere else"), (94, "ONE one One"), (95, "één 你好"), (None, "one"), (60, "one two"), (60, "one two")]


def found(spark, docs, items, **kw):
    q = spark.createDataFrame(items, "item_id bigint, text string").select("*", *[F.lit(None).cast("string").alias(c) for c in ("query", "doc_id", "rank", "score")])
    return sorted((tuple(r) for r in block_search.search(docs, q, **kw).collect()), key=key)


def test_search_against_brute_force(spark, docs, rows, items):
    want = sorted(brute_search([(d, t) for d, t, *_ in rows], items), key=key)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, query_bytes=300) == want  # several passes


def test_search_in_many_small_indexes(spark, docs, rows, items, monkeypatch):
    for name, value in (("INDEXED", 16), ("COLUMNS", 60), ("BLOCK", 3), ("SAMPLE", 40)):
        monkeypatch.setattr(block_search, name, value)
    monkeypatch.setattr(block_search, "CELLS", 64 * 60)
    assert found(spark, docs, items) == sorted(brute_search([(d, t) for d, t, *_ in rows], items), key=key)


def test_search_of_empty_tables(spark, docs, no_docs, items):
    assert found(spark, no_docs, items) == [] and found(spark, docs, [(1, None)]) == []
    assert block_search.search(docs, spark.createDataFrame([], "item_id bigint, text string")).collect() == []


def test_blocks_are_skipped_and_bounds_hold():
    r = np.random.default_rng(3)
    rows, width, topics = 600, 120, 12
    dense = r.random((rows, width)) < 0.02
    for d in range(rows):  # documents of a topic share most words
        dense[d, (d % topics) * 10:(d % topics) * 10 + 10] |= r.random(10) < 0.8
    doc, term = np.nonzero(dense)
    impact = r.integers(1000, 900_000, len(doc)).astype(np.int32)
    order = np.argsort(np.argsort(dense.sum(axis=0), kind="stable"), kind="stable")
    queries = [(k, np.sort(r.choice(width, 12, replace=False)), r.integers(1, 9000, 12)) for k in range(10)] + [(20 + t, np.arange(10 * t, 10 * t + 10), np.full(10, 500)) for t in range(topics)]
    group = block_search.Group(queries, order)
    index = block_search.Index(group, rows, doc, term, impact, np.arange(rows), r.standard_normal((width, 16)).astype(np.float32))
    for c, blocks in enumerate(index.blocks):
        docs, begin, summary = blocks
        assert sorted(docs.tolist()) == np.flatnonzero(dense[:, group.terms[c]]).tolist()
        for i, j, s in zip(begin, begin[1:], summary):
            assert (index.matrix[docs[i:j]][:, group.coordinates[c]].max(axis=0) == s).all()
    met = scored = 0
    for q, (_, terms, weights) in zip(group.queries, queries):
        best = block_search.Best(20, 0)
        a, b = index.search(q, best)
        met, scored = met + a, scored + b
        exact = np.zeros(rows, np.int64)
        for t, w in zip(terms, weights):
            here = term == t
            np.add.at(exact, doc[here], impact[here].astype(np.int64) * w)
        order_ = np.lexsort((np.arange(rows), -exact))[:20]
        assert best.id.tolist() == [d for d in order_.tolist() if exact[d] > 0] and best.score.tolist() == exact[best.id].tolist()
    assert scored < 0.7 * met


def test_impacts_of_very_long_documents():
    n = np.array([10**9, 5], np.int64)
    m = [75 + 25 * int(x) * 10**12 // 10**13 for x in n]
    assert block_search.impacts(np.array([3, 4]), n, 10**12, 10**13).tolist() == [10**9 * t // (1000 * t + 12 * x) for t, x in zip((3, 4), m)]


# --- 13 -------------------------------------------------------------------------------

def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    return path, Tokenizer.from_file(path)


def hard_texts():
    r = random.Random(1)
    ranges = [(32, 127), (0xA0, 0x600), (0x2000, 0x2100), (0x3000, 0x3200), (0x1F300, 0x1F900), (0xAC00, 0xD7B0), (0x300, 0x370), (0x1100, 0x1200), (0x10D40, 0x10D70), (0, 33)]
    out = ["".join(chr(r.randrange(*r.choice(ranges))) for _ in range(60)) for _ in range(200)]
    out += ["".join(r.choice("abcAB' ") for _ in range(300)) for _ in range(100)]
    return out + ["z" * 30_000, "<|endoftext|>abc<|ENDOFTEXT|> <|startoftext|><|endoftext|>", "ΑΣ ΟΔΟΣ Σ", "İstanbul ǅ", "é क़ 각", "can't 'LL 1234 ½ ² ٣", "你好世界" * 300,
                  "\x1c\x1d \x85 　x", "a​b﻿c", "", " ", "ab" * 5000 + "c"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_of_the_library(spark, docs, rows, name):
    path, t = library(name)
    texts = hard_texts() + [x or "" for _, x, *_ in rows]
    want = [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.TokenCounter(path).counts(texts) == want
    got = token_counts.over_limit(docs, 50, tokenizer=path).collect()
    n = want[-len(rows):]
    expected = [(d, len((x or "").encode()), k, k > 50) for (d, x, *_), k in zip(rows, n)]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_characters_that_python_and_the_library_treat_alike():
    path, t = library("word_bpe_49k.json")
    c = token_counts.TokenCounter(path)
    same = re.compile(f"[{token_counts.SAME}]")
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and same.match(chr(i))]
    for ch in points[:3000] + points[3000::7]:
        s = f"aB{ch}1 {ch}x"
        n = t.normalizer.normalize_str(s)
        assert [n[i:j] for _, (i, j) in t.pre_tokenizer.pre_tokenize_str(n)] == c._split(s), hex(ord(ch))


def test_merges_that_must_go_one_by_one():
    """(abc, a) outranks (ab, c), which makes abc: pairs of (ab, c) are merged one at a time."""
    letters = token_counts._byte_characters()
    merges = ["a b", "abc a", "ab c"]
    vocab = {x: i for i, x in enumerate([*letters, "ab", "abca", "abc"])}
    m = token_counts.Merges({"vocab": vocab, "merges": merges})
    assert m.one_by_one.tolist() == [False, False, True]

    def plain(word):
        s, rank = list(word), {tuple(x.split()): k for k, x in enumerate(merges)}
        while True:
            k = min(((rank.get(p, 99), i) for i, p in enumerate(zip(s, s[1:]))), default=(99, 0))
            if k[0] == 99:
                return len(s)
            s[k[1]:k[1] + 2] = ["".join(s[k[1]:k[1] + 2])]

    r = random.Random(3)
    words = ["abcabc", "aaa", "b"] + ["".join(r.choice("abc") for _ in range(r.randint(1, 30))) for _ in range(500)]
    assert m.counts([w.encode() for w in words]).tolist() == [plain(w) for w in words]


def test_counts_do_not_depend_on_what_is_kept(monkeypatch):
    path, _ = library("word_bpe_49k.json")
    texts = hard_texts()
    want = token_counts.TokenCounter(path).counts(texts)
    monkeypatch.setattr(token_counts, "KEPT_CHARS", 200)
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 100)
    c = token_counts.TokenCounter(path)
    assert [n for t in texts for n in c.counts([t])] == want


def test_empty_tables(spark, no_docs):
    assert token_counts.over_limit(no_docs).collect() == []
    assert [c for c in EXTRA if c in token_counts.over_limit(no_docs).columns] == []
