"""Operators 1, 2, 4: held-out accuracy, brute force, defined edge results."""
import numpy as np
import pytest

from sentrel.llm import lm_scoring as L
from sentrel.llm import quality as Q
from sentrel.llm import toxicity as T
from sentrel.llm.shared import table
from tests.conftest import SF_MID
from tests.llm import brute


@pytest.fixture(scope="module")
def toy():
    """Clean sentences and insults in various forms; a model of them."""
    r = np.random.default_rng(5)
    syl = ["an", "er", "th", "on", "re", "in", "ti", "ou", "st", "le", "na", "mo"]
    word = lambda: "".join(r.choice(syl, r.integers(1, 5)))
    sent = lambda k: [str(word()) for _ in range(k)]
    bad = ["blargface", "zugwump", "krexhead", "vumblepot"]
    texts, labels = [], []
    for i in range(600):
        w = sent(int(r.integers(5, 60)))
        if i % 4 == 0:
            for _ in range(2):
                w[int(r.integers(0, len(w)))] = str(r.choice(bad))
        texts.append(" ".join(w))
        labels.append(int(i % 4 == 0))
    return texts[:400], labels[:400], texts[400:], labels[400:], T.fit(texts[:400], labels[:400], landmarks=96), sent, bad


def test_toxicity_held_out(toy):
    _, _, texts, labels, model, _, _ = toy
    assert ((T.score_texts(texts, model) >= 0.7) == np.array(labels, bool)).mean() >= 0.97


def test_toxicity_tolerates_gaps_and_inserted_characters(toy):
    *_, model, sent, bad = toy
    clean = " ".join(sent(20))
    low = T.score_texts([clean], model)[0]
    assert low < 0.5
    gapped = [clean + " " + " ".join("-".join(b) for b in bad), clean + " " + " ".join(b[:3] + "x" + b[3:] for b in bad),
              clean + " " + " ".join(b[:4] + "." + b[4:] for b in bad)]
    scores = T.score_texts(gapped, model)
    assert (scores > low).all() and (scores[1:] >= 0.7).all(), scores


def test_toxicity_scores_whole_texts(toy):
    *_, model, sent, bad = toy
    long = " ".join(sent(60_000))
    scores = T.score_texts([long, long + " " + " ".join(bad)], model)
    assert scores[1] >= 0.7 and scores[1] > scores[0]


def test_nystrom_folds_into_one_weight_per_subsequence(toy):
    texts, *_ = toy
    codes, begin = T.encode(texts[:20])
    marks = [codes[a:a + 6] for a in begin[:-1]]
    model = T.Nystrom(marks)
    w = np.random.default_rng(0).normal(size=model.root.shape[1])
    windows = [np.concatenate([codes, np.zeros(T.PAD, np.uint8)])[i:i + T.WINDOW + 4] for i in range(200)]
    np.testing.assert_allclose(model.features(windows) @ w, T.margins(codes, model.fold(w))[:200], atol=1e-3)


def test_toxicity_edges(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (4, 1), (4, 0)], "doc_id long, toxic int")
    out = T.toxicity(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    assert all(r["held_out"] == brute.held_out(r["doc_id"], 3) for r in out)
    assert T.toxicity(no_docs, labels).count() == 0
    none = labels.where("toxic > 5")
    assert {r["score"] for r in T.toxicity(docs, none).collect()} == {0.0}
    assert T.drop_toxic(docs, none).count() == len(rows) and T.drop_toxic(docs, none).columns == docs.columns


def test_toxicity_query_separates_held_out_documents(spark):
    t, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    got = T.toxicity(t, labels).join(labels, "doc_id").where("held_out").toPandas()
    y, s = got["toxic"].to_numpy() == 1, got["score"].to_numpy()
    assert (s[y][:, None] > s[~y][None]).mean() >= 0.75  # 34 toxic training texts at this size; the larger tables are in the README


def test_quality_held_out_and_shrinkage(spark, docs, no_docs, rows):
    labels = table(spark, SF_MID, "labels")
    got = Q.quality(table(spark, SF_MID, "documents"), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() >= 0.95
    some = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1)], "doc_id long, quality int")
    out = Q.quality(docs, some).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert Q.quality(no_docs, some).count() == 0
    assert Q.quality(docs, some.where("quality > 5")).count() == len(rows)


def test_sparse_sites_shrink_toward_the_global_share(spark):
    good, junk = "the old house stands near a quiet river and many people come to see it each year ", "spam spam spam spam $$$ $$$ !!! "
    rows = []
    for i in range(300):
        host = f"h{i % 3}"
        bad = i % 10 < (8 if host == "h0" else 1)
        rows.append((i, (junk if bad else good) * (2 + i % 5), "p", host))
    rows.append((1000, junk * 3, "p", "tiny"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(r[0], int(r[1].startswith("the"))) for r in rows if r[0] < 300], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in Q.quality(df, labels).collect()}
    share = lambda h: sum(r[1].startswith("the") for r in rows if r[3] == h) / sum(r[3] == h for r in rows)
    for i in (0, 1, 2):
        assert abs(out[i]["host_rate"] - share(f"h{i}")) < 0.1
    assert out[1000]["host_rate"] > 0.2  # one bad document says little about a host


@pytest.mark.parametrize("options", [{}, {"head_words": 40}, {"filter_bytes": 300}])
def test_lm_base_scores_and_counts(docs, rows, options):
    want = sorted(brute.base_scores([(r[0], r[1]) for r in rows]), key=str)
    out = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in L.lm_scores(docs, **options).collect()), key=str)
    assert [x[:5] for x in sorted(out, key=lambda x: (str(x[:5]), x[5]))] == [x[:5] for x in sorted(want, key=lambda x: (str(x[:5]), x[5]))]
    a, b = (sorted(x[5] for x in y) for y in (out, want))
    assert max(abs(p - q) for p, q in zip(a, b)) < 1e-8


@pytest.mark.parametrize("options", [{}, {"head_words": 40}, {"head_words": 40, "filter_bytes": 300}])
def test_lm_scores_equal_the_plain_model(docs, rows, options):
    want = brute.model_scores([(r[0], r[1]) for r in rows], L.LEVELS.tolist())
    got = L.lm_scores(docs, bits_each=400.0, **options).collect()
    np.testing.assert_allclose(sorted(r["score"] for r in got), sorted(want), rtol=1e-9)


def test_lm_pairs_of_two_words_outside_the_head(spark):
    """Pairs of words that are outside the head, that training saw or not, repeated in one text, and a text without any."""
    rows = [(i, t) for i, t in enumerate(["a a a a a a b", "rare odd rare odd x", "rare odd", "a rare odd b odd rare", "never seen at all", "never seen", "", None] * 6)]
    got = L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), head_words=1, bits_each=400.0).collect()
    np.testing.assert_allclose([r["score"] for r in sorted(got, key=lambda r: r["doc_id"])], brute.model_scores(rows, L.LEVELS.tolist()), rtol=1e-9)


def test_lm_helps_on_held_out_texts_and_is_a_probability(spark, no_docs):
    got = L.lm_scores(table(spark, SF_MID, "documents")).toPandas()
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() and (got["score"] <= 0).all()
    assert L.lm_scores(no_docs).count() == 0


def test_filter_reads_levels_back():
    r = np.random.default_rng(2)
    keys = np.unique(r.integers(0, 2**62, 5000, dtype=np.int64).astype(np.uint64))
    n = r.integers(1, 5000, len(keys))
    from sentrel.llm.shared import bucket_of, mix
    buckets = 4
    b = bucket_of(mix(keys), buckets)
    f = L.Filter({i: L._filter_part(keys[b == i], L.level_of(n[b == i]), 12.0) for i in range(buckets)}, buckets)
    got = f.level(keys)
    assert (got >= L.level_of(n)).all() and (got == L.level_of(n)).mean() > 0.98
    other = np.unique(r.integers(2**62, 2**63 - 1, 20000, dtype=np.int64).astype(np.uint64))
    assert (f.level(other) > 0).mean() < 0.03


def test_probabilities_of_the_next_word_sum_to_one():
    keys = np.arange(1, 31).astype(np.uint64) * np.uint64(2**58)
    r = np.random.default_rng(3)
    head = L.Head(keys, r.integers(20, 50, len(keys)))
    pairs, n = [], []
    for v in range(31):
        for w in r.choice(31, 6, replace=False):
            pairs.append(v << 32 | int(w))
            n.append(int(r.choice([1, 2, 3, 4])))
    pairs, n = np.array(pairs, np.uint64), np.array(n)
    from sentrel.llm.shared import bucket_of, mix
    b = bucket_of(mix(pairs), 1)
    kinds = np.bincount((pairs >> np.uint64(32)).astype(int), minlength=31)
    mass = np.bincount((pairs >> np.uint64(32)).astype(int), L.LEVELS[L.level_of(n) - 1], 31).astype(np.int64)
    docs = 25
    tokens, vocabulary = int(head.counts.sum()) + docs, 31
    model = L.Model(head, L.Filter({0: L._filter_part(pairs[b == 0], L.level_of(n), 40.0)}, 1), kinds, mass, docs, tokens, vocabulary)
    for v in range(31):
        _, logs = model.score(np.full(31, v), np.arange(31))
        unseen = model.rest[v] * 0.5 / (tokens + 0.5 * (vocabulary + 1))  # the word that training never saw
        assert abs((10.0 ** logs).sum() + unseen - 1) < 1e-9


def test_lm_scores_do_not_depend_on_what_is_broadcast(docs):
    whole = L.lm_scores(docs, bits_each=400.0)  # so many bits that no probe is falsely answered
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"])
    want = sorted((r for r in whole.collect()), key=key)
    for options in ({"head_words": 40}, {"filter_bytes": 300}, {"head_words": 40, "filter_bytes": 300}, {"head_words": 0}):
        got = sorted((r for r in L.lm_scores(docs, bits_each=400.0, **options).collect()), key=key)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, err_msg=str(options))


def test_broadcast_objects_need_no_library_on_the_executors(tmp_path):
    """A head that is taken apart, sent and rebuilt in a Python that cannot import this library."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from sentrel.llm.shared import plain, rebuilt
    head = L.Head(np.array([5, 9, 2**63], np.uint64), np.array([1, 2, 3]))
    sent = plain(head)
    (tmp_path / "sent").write_bytes(cloudpickle.dumps(lambda: rebuilt(sent).find(np.array([9, 7], np.uint64)).tolist()))
    code = "import pickle, sys; f = pickle.load(open('sent', 'rb')); print(f()); assert not any(m.startswith('sentrel') for m in sys.modules)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert out.stdout.strip() == str(head.find(np.array([9, 7], np.uint64)).tolist()), out.stderr
