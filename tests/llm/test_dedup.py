"""Operators 3, 5, 8: against brute force, on texts with nulls, ties, copies; on empty tables."""
import hashlib
import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrel.llm import exact_dedup as X
from sentrel.llm import jaccard_join as J
from sentrel.llm import phrase_dedup as P
from tests.llm import brute


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("bits", [64, 5, 1])
def test_exact_dedup_also_when_chunk_hashes_collide(docs, rows, bits):
    out = X.exact_dedup(docs, bits=bits).collect()
    got = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out)
    assert got == collections.Counter(brute.exact(pairs(rows)))
    assert sum(r["kept"] for r in out) == len({r["text_sha256"] for r in out})
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_refused_hashes_beyond_the_literal_limit(docs, rows, monkeypatch):
    monkeypatch.setattr(X, "MAX_REFUSED", 1)
    out = X.exact_dedup(docs, bits=5).collect()
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == collections.Counter(brute.exact(pairs(rows)))


def test_chunks_rebuild_the_text_and_resynchronise(spark):
    base = " ".join(f"word{i * 7919 % 1013} dark horse" for i in range(3000))
    df = spark.createDataFrame([(1, base), (2, "an inserted beginning " + base), (3, "x" * 20000)], "doc_id long, text string")
    got = {r["doc_id"]: r["c"] for r in df.select("doc_id", X.chunks("text").alias("c")).collect()}
    assert "".join(got[1]) == base and "".join(got[3]) == "x" * 20000
    assert len(set(got[1]) & set(got[2])) >= len(got[1]) - 3


def test_drop_copies_keeps_columns_and_one_of_identical_rows(docs, rows):
    out = X.drop_copies(docs)
    assert out.columns == docs.columns
    texts = [r["text"] for r in out.collect()]
    assert len(texts) == len({x[3] for x in brute.exact(pairs(rows))})


def test_remove_repeats(docs, rows):
    want = brute.remove_repeats([x for x in pairs(rows) if x[0] is not None] + [(None, rows[4][1])])
    out = P.remove_repeats(docs, block_bytes=4000).collect()
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]
        elif r["n_words"]:
            assert r["n_removed"] == r["n_words"]  # a copy of document 4, and null comes last
    assert len(out) == len(rows)


def test_repeated_and_null_ids_are_told_apart_by_their_words(spark):
    """A start belongs to one row, not to all rows of its id."""
    run = lambda c, n: " ".join(f"{c}{k}" for k in range(n))
    a, b, g, h, x = run("a", 40), run("b", 40), run("g", 60), run("h", 30), run("x", 50)
    rows = [(1, a), (7, f"{g} {b}"), (7, f"{a} {h}"), (7, f"{x} {b}"), (None, f"{a} {x}"), (None, f"{b} {run('n', 25)}"), (9, x), (7, f"{a} {h}")]
    # a document for each id and text, in the order of ids, then of the hashes of the words; null last
    order = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    want = brute.remove_repeats([(k, t) for k, (_, t) in enumerate(order)])
    expected = sorted((str(d), *want[order.index((d, t))]) for d, t in rows)
    out = P.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=600).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == expected


def test_phrases_are_cut_into_bounded_automata(docs, rows, monkeypatch):
    monkeypatch.setattr(P, "PATTERNS", 3)
    got = {r["doc_id"]: r["n_removed"] for r in P.remove_repeats(docs, block_bytes=4000).collect() if r["doc_id"] is not None}
    want = brute.remove_repeats([x for x in pairs(rows) if x[0] is not None])
    assert got == {d: w[1] for d, w in want.items()}


def test_near_duplicates(docs, rows):
    out = J.near_duplicates(docs).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=key) == sorted(brute.near(pairs(rows)), key=key)


def test_near_duplicates_of_one_large_group_without_all_pairs(spark):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words[:i % 90 + 5] + [f"only{i}"] + words[i % 90 + 6:]) for i in range(300)] + [" ".join(words[::-1] + ["tail", str(i)] * 40) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.near_duplicates(df).collect())
    assert got == sorted(brute.near(list(enumerate(texts))))


def test_rtree_returns_every_point_within_the_bound():
    import numpy as np
    r = np.random.default_rng(1)
    base = r.poisson(3, (40, J.GROUPS))
    points = np.concatenate([np.maximum(base + r.integers(-1, 2, base.shape) * (r.random(base.shape) < 0.1), 0) for _ in range(40)])
    tree = J.RTree(points)
    size = points.sum(1)
    for i in range(0, len(points), 97):
        q = points[i]
        want = np.flatnonzero((np.minimum(points, q).sum(1) >= J.needed(size[i], size)) & (5 * size >= 4 * size[i]) & (4 * size <= 5 * size[i]))
        got = tree.search(q)
        assert set(want) <= set(got.tolist()) and (np.minimum(points[got], q).sum(1) >= J.needed(size[i], size[got])).all()


def test_points_travel_packed():
    r = np.random.default_rng(4)
    points = np.concatenate([r.poisson(1, (50, J.GROUPS)), np.zeros((1, J.GROUPS), int), r.integers(0, 2**32, (2, J.GROUPS)), r.poisson(200, (2, J.GROUPS))]).astype(np.uint32)
    packed = [J.pack_point(p) for p in points]
    assert (J.unpack_points(packed) == points).all() and J.unpack_points([]).shape == (0, J.GROUPS)
    assert max(map(len, packed[:50])) < 300  # 2,048 bytes before


def test_drop_near_duplicates_keeps_one_of_each_component(docs, rows):
    out = J.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    want = brute.near(pairs(rows))
    components = {c for _, n, c in want if n}
    kept = [r["doc_id"] for r in out.where(F.length(F.trim("text")) > 1).collect()]
    assert components <= set(kept) | {None}
    assert sum(1 for d in kept if d in components) == len(components - {None})


def test_empty_tables(no_docs):
    for out in (X.exact_dedup(no_docs), P.remove_repeats(no_docs), J.near_duplicates(no_docs), X.drop_copies(no_docs), J.drop_near_duplicates(no_docs)):
        assert out.count() == 0
