"""Operators 6, 7, 9, 10: exact round trips and brute force."""
import base64
import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrel.llm import mixing as M
from sentrel.llm import packing as P
from sentrel.llm import pivot_join as V
from sentrel.llm import warc as R
from tests.llm import brute


def encoded(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = encoded.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    return np.asarray(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


@pytest.mark.parametrize("length", [4096, 256])
def test_packing_round_trip(docs, rows, length):
    out = P.packed(docs, length=length, shard_tokens=8000).collect()
    sequences = collections.defaultdict(list)
    count = collections.Counter(r[0] for r in rows)
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    pieces = collections.defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["doc_id"] is not None:
            ids = encoded(texts[r["doc_id"]])
            assert len(ids) == r["doc_tokens"] and zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            pieces[r["doc_id"]].append((r["start"], r["length"]))
    for d, p in pieces.items():
        assert sum(n for _, n in p) == len(encoded(texts[d])) * count[d]
        if count[d] == 1:
            assert [s for s, _ in sorted(p)] == np.cumsum([0, *[n for _, n in sorted(p)]])[:-1].tolist()
    for s in sequences.values():
        assert [o for o, _ in sorted(s)] == np.cumsum([0, *[n for _, n in sorted(s)]])[:-1].tolist() and sum(n for _, n in s) <= length
    fill = sum(n for s in sequences.values() for _, n in s) / (len(sequences) * length)
    assert fill > 0.8


def test_packing_of_empty_tables_and_shards(spark, docs, no_docs):
    assert P.packed(no_docs).collect() == []
    one = docs.limit(1).select("doc_id", F.lit(None).cast("string").alias("text"))
    assert [(r["start"], r["length"], r["doc_tokens"]) for r in P.packed(one).collect()] == [(0, 1, 1)]
    few = P.packed(docs.where("doc_id < 4"), shard_tokens=10).collect()  # more shards than documents
    assert {r["doc_id"] for r in few} == {0, 1, 2, 3}


def test_ranking_by_parts_is_the_whole_ranking():
    r = np.random.default_rng(2)
    for n in (3, 200, 700):
        free, left, scores = np.sort(r.choice(2000, n, replace=False)), r.integers(1, 50, 2000), r.integers(0, 6, 2000).astype(float)
        assert list(P._ranked(free, left, scores)) == free[np.lexsort((free, -left[free], -scores[free]))].tolist()


def test_counts_above_a_byte_weigh_in_full(spark):
    d = spark.createDataFrame([(1, "same " * 700 + "other")], "doc_id long, text string")
    r = P.tokenized(d, "doc_id", "text", 4096, None).first()
    assert sorted(np.frombuffer(r["counts"], np.uint32).tolist()) == [1, 700]


def test_words_encode_as_whole_texts(spark):
    texts = ["Hello, WORLD it's 12 o'clock", "\xc1 b\xe9 \u03a3\u03a3 \u4f60\u597d\u3000x y", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "tab\tline\n\x0b\x0c\rend",
             "\U0001f600\u200d\u2642 $$$!!! \x85a\xa0b \x1cc", "", None]
    out = P.tokenized(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", 8, None).collect()
    for r in out:
        ids = encoded(texts[r["doc_id"]])
        full = len(ids) // 8
        assert r["doc_tokens"] == len(ids)
        assert bytes(r["full_crcs"]) == np.array([zlib.crc32(ids[8 * k:8 * k + 8].tobytes()) for k in range(full)], "<u4").tobytes()
        assert bytes(r["tail_crcs"]) == np.array([zlib.crc32(ids[8 * full:].tobytes())] if len(ids) % 8 else [], "<u4").tobytes()


def test_neighbours_share_words():
    rng = np.random.default_rng(1)
    topics = [rng.choice(10_000, 40, replace=False) for _ in range(10)]
    terms = [np.unique(rng.choice(topics[i % 10], 25)).astype(np.uint32) for i in range(100)]
    index = P.Index(terms, [np.ones(len(t), np.uint8) for t in terms])
    packs = list(P.fill_windows(np.full(100, 64, np.int64), index, terms, 320))
    assert sum(n for p in packs for _, _, n in p) == 6400
    assert np.mean([len({i % 10 for i, *_ in p}) for p in packs]) < 1.5


def test_tails_without_like_ones_are_left_for_another_round():
    terms = [np.arange(50 * i, 50 * i + 50, dtype=np.uint32) for i in range(8)] * 2  # each tail has one copy
    lone = [np.arange(10_000 + 50 * i, 10_050 + 50 * i, dtype=np.uint32) for i in range(4)]
    index, rest = P.Index(terms + lone, [np.ones(50, np.uint8)] * 20), []
    packs = list(P.fill_windows(np.array([128] * 16 + [96] * 4), index, terms + lone, 256, rest=rest))
    assert sorted(sorted(i % 8 for i, *_ in p) for p in packs) == [[i, i] for i in range(8)] and sorted(i for i, *_ in P._whole(rest)) == [16, 17, 18, 19]
    assert sum(n for *_, n in rest) == 4 * 96


def test_like_documents_of_different_shards_meet_in_the_second_round(spark):
    r = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in r.choice(np.arange(200 * (i % 30), 200 * (i % 30) + 200), 120)) for i in range(240)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    sizes = [len(encoded(x)) for x in texts]
    one = P.packed(df, length=2048).select("sequence_id").collect()
    # one shard a round, whatever the session's shuffle partitions; the rounds are the same at every size
    shards = sorted({q[0] >> 32 for q in one})
    assert len({2 * s // P.SECOND for s in shards}) == len(shards) <= 3
    out = P.packed(df, length=2048, shard_tokens=sum(sizes) // 3).collect()
    assert any(q["sequence_id"] >> 32 >= P.SECOND for q in out) and sum(q["length"] for q in out) == sum(sizes)
    for q in out:
        assert zlib.crc32(encoded(texts[q["doc_id"]])[q["start"]:q["start"] + q["length"]].tobytes()) == q["ids_crc32"]


def test_slice_crc():
    data = np.arange(5000, dtype="<u4").tobytes()
    for a, b in ((0, 40), (128, 4000), (4, 20000)):
        assert P.slice_crc(zlib.crc32(data[:a]), zlib.crc32(data[:b]), b - a) == zlib.crc32(data[a:b])


@pytest.fixture(scope="module")
def pages(spark):
    html = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "é\r\n\r\nWARC/1.1\r\n\r\n", "<p>a</p>", "x" * 300_000] + [f"page {i % 50}" for i in range(100)]
    rows = [(i, f"http://x/{i}\n y" if i % 3 else None, h, "extra") for i, h in enumerate(html)]
    rows += [rows[9], (None, "u", "<p>a</p>", None), (None, "u", "own", None), (-5, "u", "page 3", None)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, shard string")


def test_warc_round_trip(pages):
    rows, df = pages
    least = {}
    for i, _, h, _ in rows:
        least[h or ""] = min([x for x in (least.get(h or ""), i) if x is not None], default=None)
    want = collections.Counter()
    for i, _, h, _ in rows:
        b, first = (h or "").encode(), least[h or ""]
        want[(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == first else "revisit", None if i == first else first)] += 1
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                              for r in R.warc_round_trip(df, shard_bytes=20_000, file_bytes=2_000).collect())
    assert got == want


def test_warc_is_deterministic_and_committed_by_its_manifest(spark, pages, tmp_path):
    import os
    _, df = pages
    folders = [str(tmp_path / x) for x in "ab"]
    for n, f in zip((2, 5), folders):
        R.write_warc(df.repartition(n), f, shard_bytes=20_000, file_bytes=2_000)
    read = [{x: open(os.path.join(f, x), "rb").read() for x in sorted(os.listdir(f)) if x.endswith(".gz")} for f in folders]
    assert read[0] == read[1] and len(read[0]) > 3
    open(os.path.join(folders[0], "shard-99999999-000000.warc.gz"), "wb").write(b"left over")
    assert R.read_warc(spark, folders[0]).count() == df.count()
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in R.read_warc(spark, folders[0], with_payload=True).collect() if r["payload"] is not None}
    assert payloads[5].startswith("é\r\n")
    first = next(iter(read[0]))
    open(os.path.join(folders[1], first), "wb").write(read[0][first][:-3] + b"abc")
    with pytest.raises(Exception, match="differs"):
        R.read_warc(spark, folders[1]).count()


def test_warc_of_an_empty_table(spark, pages):
    assert R.warc_round_trip(spark.createDataFrame([], pages[1].schema)).count() == 0


def test_warc_range_shards_follow_the_bytes(spark):
    df = spark.createDataFrame([(i if i < 900 else i * 10**15, 100) for i in range(1000)], "page_id long, bytes long")
    bounds = R.shard_bounds(df, 10_000)
    assert bounds == [100, 200, 300, 400, 500, 600, 700, 800, 900 * 10**15]


def _links(vectors, least=0.95):
    x = np.array(vectors, float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T >= least
    np.fill_diagonal(s, False)
    return s


@pytest.mark.parametrize("options", [{}, {"chunk": 20}, {"list_rows": 5}])
def test_embedding_links(spark, options):
    r = np.random.default_rng(4)
    base = r.normal(size=(150, 64))
    near = np.concatenate([base[i] + 0.02 * r.normal(size=(k, 64)) for i, k in ((0, 40), (1, 5), (2, 1), (3, 1), (4, 2))])
    x = np.concatenate([base, near, base[:3], base[5:6] * 3]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(1000, None, 0), (1001, [0.0] * 64, 0), (1002, [float("nan")] + [1.0] * 63, 0), (1003, [None] + [1.0] * 63, 0), (1004, [1.0] * 3, 0), (1005, [float("inf")] * 64, 0), (1006, [], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, cls int")
    got = {q["vec_id"]: (q["n_links"], q["component_id"], q["kept"]) for q in V.embedding_links(df, **options).collect()}
    s = _links(x)
    found = sum(got[i][0] for i in range(len(x)))
    assert found <= s.sum() and found >= 0.98 * s.sum()
    if found == s.sum():
        root = brute.union(len(x), list(zip(*np.nonzero(s))))
        least = {}
        for i, c in enumerate(root):
            least.setdefault(c, i)
        assert all(got[i] == (s[i].sum(), least[root[i]], least[root[i]] == i) for i in range(len(x)))
    assert all(got[i] == (0, i, True) for i, *_ in bad)


def test_links_do_not_depend_on_the_size_for_lists(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(150, 64))
    x = np.concatenate([base, base + 0.3 * r.normal(size=base.shape)])  # cosines about 0.958
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {n: sum(q["n_links"] for q in V.embedding_links(df, n_pivots=20, list_rows=n).collect()) for n in (1, 10**9)}
    assert found[1] == found[10**9] >= 0.95 * _links(x).sum()


def test_vectors_of_every_length_link(spark):
    r = np.random.default_rng(7)
    rows = []
    for dim, n in ((64, 30), (32, 20), (2, 1)):
        base = r.normal(size=(n, dim))
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(np.concatenate([base, base + 0.01 * r.normal(size=base.shape)]))]
    got = V.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 102 and all(q["n_links"] == 1 for q in got) and sum(q["kept"] for q in got) == 51


def test_embedding_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert V.embedding_links(spark.createDataFrame([], schema)).count() == 0
    one = V.embedding_links(spark.createDataFrame([(7, [1.0, 2.0]), (7, [2.0, 4.0]), (None, [1.0, 2.0]), (9, [-1.0, 0.5])], schema)).collect()
    assert sorted((r["n_links"], r["component_id"]) for r in one) == [(0, 9), (2, 7), (2, 7), (2, 7)]


def test_mix_targets_and_taken_words(docs, rows):
    out = M.mix_sources(docs).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    want = brute.targets(dict(sizes))
    taken = collections.Counter()
    assert len(out) == len(rows)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert want[s] - 4 <= taken[s] <= want[s]
    again = sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in M.mix_sources(docs.repartition(5)).collect())
    assert again == sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in out)


def test_mixed_rows_follow_the_taken_words(docs):
    marks = {(r["doc_id"], r["source"], r["size"]): r for r in M.mix_sources(docs).collect() if r["doc_id"] is not None and r["doc_id"] != 5}
    out = M.mixed(docs)
    assert out.columns == docs.columns
    times = collections.Counter((r["doc_id"], r["source"], len(brute.words(r["text"]))) for r in out.collect())
    for k, r in marks.items():
        assert times[k] == (int(r["taken"] / r["size"] + 0.5) if r["size"] else 0)


def test_mix_edges(spark, no_docs):
    assert M.mix_sources(no_docs).count() == 0 and M.mixed(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["doc_id"], r["size"], r["target"], r["taken"]) for r in M.mix_sources(blank).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    ties = spark.createDataFrame([(1, "a b c d", "s")] * 5, "doc_id long, text string, source string")  # one hash for all
    assert sum(r["taken"] for r in M.mix_sources(ties).collect()) in range(25, 31)


def test_encoding_by_units_is_the_librarys(monkeypatch):
    import pyarrow as pa
    r = np.random.default_rng(5)
    letters = list("abcXYZ019'.,-_#<|>éÉèÀÖß×÷ñÿ\xa0\x85\x1c\x7f́İſΣ你🙂²º… \t\n")
    texts = ["", " ", "\n", "it's 's '' ''s I'LL don't", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b É's", "É÷È ×× AÀ1É2 foo_bar"]
    texts += ["".join(r.choice(letters, r.integers(1, 40))) for _ in range(1500)] + ["ab12" * 3000]
    monkeypatch.setattr(P, "SLICE", 2000)
    monkeypatch.setattr(P, "TOGETHER", 9000)
    monkeypatch.setattr(P, "KEPT_UNITS", 300)  # the table starts anew
    encoder, got = P._Encoder(None), []
    encoder.kept["table"] = P._Table(300)
    for lo, hi, some in P._together(pa.array(texts)):
        for ids, begins in encoder.encode([own for _, own in some]):
            got += [ids[i:j].tolist() for i, j in zip(begins, begins[1:])]
    encoded("")
    assert got == [e.ids + [2] for e in encoded.t.encode_batch(texts, add_special_tokens=False)]
    words = P.Words(*P.text_buffer(pa.array(["Été l'été x1 你好, été."])), lower=True, parts=True)
    begin, end, single = encoder.units(words)
    cut = [(words.data[i:j].tobytes().decode(), s) for i, j, s in zip(begin, end, single.tolist())]
    assert cut == [("Été", True), ("l'été", False), ("x", True), ("1", True), ("你好,", False), ("été", True), (".", True)]  # words were the units before


def test_used_tails_leave_the_index_and_scores_stay():
    r = np.random.default_rng(6)
    terms = [np.unique(r.zipf(1.3, 80) % 500).astype(np.uint32) for _ in range(300)]
    index, whole = (P.Index(terms, [np.ones(len(t), np.uint8) for t in terms]) for _ in range(2))
    used = r.random(300) < 0.5
    before = len(index.doc)
    index.drop(used)
    assert len(index.doc) < before and index.live == (~used).sum()
    for i in np.flatnonzero(~used)[:50]:
        plain = np.zeros(300)
        for j, t in enumerate(terms):
            plain[j] = len(np.intersect1d(t, terms[i]))
        scores = whole.scores(terms[i])
        assert (index.scores_for(i)[~used] == scores[~used]).all() and ((scores > 0) == (plain > 0)).all()


def test_tasks_get_batches_of_some_bytes(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("text"))
    with P.arrow_bytes(spark, 100_000):
        got = [r["n"] for r in texts.mapInArrow(sizes, "n bigint").collect()]
    assert sum(got) == 3000 and max(got) < 200 and spark.conf.get(key) == before


def test_a_shard_takes_few_bytes_for_each_term():
    import tracemalloc
    r = np.random.default_rng(8)
    terms = [np.unique(r.zipf(1.2, 500) % 40_000).astype(np.uint32) for _ in range(1000)]
    counts = [np.ones(len(t), np.uint32) for t in terms]
    tracemalloc.start()
    P.Index(terms, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 55 * sum(map(len, terms))  # 72 before


def test_a_shard_is_packed_without_the_encoders_tables(monkeypatch):
    import sys
    import types
    monkeypatch.setattr(P, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setitem(sys.modules, "sentrel_worker_state", types.ModuleType("sentrel_worker_state"))
    assert list(P._packer(4096, 0, True)(iter([]))) == [] and "sentrel_worker_state" not in sys.modules


def test_plain_pre_tokens_are_encoded_from_bytes(monkeypatch):
    import pyarrow as pa
    texts = ["ÀÉÞ ßÿ Ünder x1 a,b", "plain words, and Été"]
    encoder = P._Encoder(None)
    encoder.kept["table"] = P._Table(300)
    monkeypatch.setattr(encoder.counter, "_split", None)  # no text is cut or put into lower case by Python
    got = [ids[i:j].tolist() for _, _, some in P._together(pa.array(texts)) for ids, begins in encoder.encode([own for _, own in some]) for i, j in zip(begins, begins[1:])]
    assert got == [encoded(t).tolist() for t in texts] and encoder.counter.merges.symbols(np.frombuffer(b"ab", np.uint8), np.array([2]))[1].sum() >= 1
