import math

import numpy as np
from pyspark.sql import functions as F

from sentrel.functions.arrays import softmax
from sentrel.operators import features as FT
from sentrel.operators import metrics as M
from sentrel.sources import fixtures as fx
from tests.conftest import SF_MID


def scored(spark):
    return fx.re_scored(spark, SF_MID)


def sk_auprc(z, y):
    """Per-class PR curve (distinct thresholds, closed at recall 0 /
    precision 1), trapezoid area, mean over classes with positives."""
    scores = []
    for c in range(z.shape[1]):
        s, t = z[:, c], (y == c).astype(int)
        if t.sum() == 0:
            continue
        order = np.argsort(-s, kind="mergesort")
        s, t = s[order], t[order]
        idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
        tps, fps = np.cumsum(t)[idx], (1 + idx) - np.cumsum(t)[idx]
        prec = np.r_[1.0, tps / (tps + fps)]
        rec = np.r_[0.0, tps / tps[-1]]
        scores.append(np.sum(np.diff(rec) * (prec[1:] + prec[:-1]) / 2))
    return float(np.mean(scores) * 100)


def test_auprc_matches_numpy(spark):
    rows = scored(spark).collect()
    z, y = np.array([r.z for r in rows]), np.array([r.label_id for r in rows])
    got = M.auprc(scored(spark)).collect()[0].auprc
    assert math.isclose(got, sk_auprc(z, y), rel_tol=1e-9)


def test_softmax_and_losses(spark):
    s = scored(spark)
    sums = s.select(F.aggregate(softmax("z"), F.lit(0.0), lambda a, x: a + x).alias("t")).collect()
    assert all(abs(r.t - 1) < 1e-9 for r in sums)
    ce = M.cross_entropy(s).collect()[0].ce
    ls0 = M.label_smooth(s, smoothing=0.0).collect()[0].label_smooth
    assert math.isclose(ce, ls0, rel_tol=1e-9)
    rows = s.collect()
    z, y = np.array([r.z for r in rows]), np.array([r.label_id for r in rows])
    lse = np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1)
    assert math.isclose(ce, float(np.mean(lse - z[np.arange(len(y)), y])), rel_tol=1e-9)


def test_micro_f1_formula(spark):
    rows = scored(spark).collect()
    z, y = np.array([r.z for r in rows]), np.array([r.label_id for r in rows])
    p = z.argmax(1)
    tp = np.sum((p == y) & (y != 0))
    exp = 200.0 * tp / (np.sum(p != 0) + np.sum(y != 0))
    assert math.isclose(M.micro_f1(scored(spark)).collect()[0].micro_f1, exp, rel_tol=1e-9)


def test_plateau_matches_its_definition(spark):
    """From the whole list of values: a step improves if it beats all earlier ones; the count is the
    distance to the last improvement; a run has stopped once any count so far reached the patience."""
    h = fx.eval_history(spark, SF_MID)
    got = {(r.run, r.step): (r.best, r.patience_cnt, r.stop) for r in M.plateau(h, mode="max", patience=3).collect()}
    runs = {}
    for r in h.collect():
        runs.setdefault(r.run, []).append((r.step, r.value))
    exp = {}
    for run, seq in runs.items():
        seq = [(s, v) for s, v in sorted(seq) if v >= 0]
        values = [v for _, v in seq]
        improves = [all(v > w for w in values[:i]) for i, v in enumerate(values)]
        counts = [i - max(j for j in range(i + 1) if improves[j]) for i in range(len(values))]
        for i, (step, _) in enumerate(seq):
            exp[(run, step)] = (improves[i], counts[i], max(counts[:i + 1]) >= 3)
    assert got == exp


def test_position_ids_general(spark):
    d = spark.createDataFrame([([5, 6, 0, 7, 0, 0],), ([5, 6, 7, 0, 0, 0],)], "ids array<int>")
    out = [r.p for r in d.select(FT.position_ids("ids", pad=0).alias("p")).collect()]
    assert out == [[1, 2, 0, 3, 0, 0], [1, 2, 3, 0, 0, 0]]


def test_pair_truncation_longest_first(spark):
    d = spark.createDataFrame([(300, 10), (10, 300), (200, 200), (5, 5)], "a int, b int")
    ka, kb = FT.pair_lengths(F.col("a"), F.col("b"), 256)
    got = [(r.x, r.y) for r in d.select(ka.alias("x"), kb.alias("y")).collect()]
    assert got == [(243, 10), (10, 243), (127, 126), (5, 5)]
    assert all(x + y + 3 <= 256 for x, y in got)


def test_external_and_native_linear_scores_agree(spark):
    import numpy as np
    from sentrel.operators import scoring as I
    r = np.random.default_rng(1)
    coef, bias = r.normal(size=(5, 8)), r.normal(size=5)
    df = spark.createDataFrame([(i, r.normal(size=8).tolist(), "kept") for i in range(40)], "id long, z array<double>, _mine string")
    a = {x.id: x.logits for x in I.score_external(df, I.linear_loader(coef, bias), "z", ["id"]).collect()}
    out = I.score_linear(df, coef.tolist(), bias.tolist())
    assert "_mine" in out.columns
    for x in out.collect():
        assert np.allclose(a[x.id], x.logits) and x.prediction == int(np.argmax(a[x.id])) and abs(sum(x.probs) - 1) < 1e-9


def test_fitted_text_classifier_beats_the_majority_class(spark):
    from sentrel.operators import scoring as I
    rows = [(i, f"the @*PER*subject{i % 7}@ {'works for' if i % 3 else 'lives in'} #^ORG^object# today", int(i % 3 > 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, sentence string, label_id int")
    out = I.score(df, I.fit_text(df, num_features=1 << 12, max_iter=10)).collect()
    assert sum(r.prediction == r.label_id for r in out) / len(out) > 0.95 > 2 / 3


class _Stop:
    """Plain early stopping over a run's values, for comparison."""

    def __init__(self, patience, better, worst):
        self.patience, self.better, self.best, self.count, self.stop = patience, better, worst, 0, False

    def see(self, v):
        improved = self.better(v, self.best)
        self.best, self.count = (v, 0) if improved else (self.best, self.count + 1)
        self.stop = self.stop or self.count >= self.patience
        return improved, self.count, self.stop


def test_plateau_with_null_runs_nan_and_outliers(spark):
    import math
    import operator
    import random
    r = random.Random(5)
    rows = [(run, s, r.choice([float("nan"), -1.0, None, 1e12, float("inf")]) if r.random() < 0.1 else round(r.random() * 20) / 2)
            for run, n in (("hot", 3000), (None, 60), ("a", 1), ("b", 40)) for s in range(n)]
    rows += [("only", s, float("nan")) for s in range(4)]
    df = spark.createDataFrame(rows, "run string, step long, value double")
    for mode, better, worst in (("min", operator.lt, math.inf), ("max", operator.gt, -math.inf)):
        got = {(x.run, x.step): (x.best, x.patience_cnt, x.stop) for x in M.plateau(df, mode=mode, patience=3).collect()}
        want, best, stops = {}, {}, {}
        for run in ("hot", None, "a", "b", "only"):
            state = _Stop(3, better, worst)
            for _, s, v in sorted((x for x in rows if x[0] == run), key=lambda x: x[1]):
                if v is None or v < 0:
                    continue
                want[run, s] = state.see(v)
                if not math.isnan(v) and (run not in best or better(v, best[run][1])):
                    best[run] = (s, v)
                if state.stop:
                    stops.setdefault(run, s)
        assert got == want, mode
        found = {x.run: (x.best_step, x.best_value, x.stop_step) for x in M.best_step(df, mode=mode, patience=3).collect()}
        assert found == {k: (*best.get(k, (None, None)), stops.get(k)) for k in ("hot", None, "a", "b", "only")}


def test_auprc_empty_value(spark):
    rows = [(i, [0.1 * i, 1.0 - 0.1 * i, 0.5], i % 2) for i in range(8)]  # class 2 has no positives
    df = spark.createDataFrame(rows, "id long, z array<double>, label_id int")
    plain, zero = M.auprc(df).first()[0], M.auprc(df, empty_value=0.0).first()[0]
    assert abs(zero - plain * 2 / 3) < 1e-9


def test_moments_do_not_depend_on_partitioning(spark):
    import numpy as np
    from sentrel.operators import analysis as EA
    r = np.random.default_rng(1)
    a, b = r.random(5000), r.random(5000)
    df = spark.createDataFrame([("m", 0, float(x), float(x + y)) for x, y in zip(a, b)] + [("n", 0, 1e30, 2.0), ("n", 0, 3e30, 1.0), ("n", 0, None, 4.0)], "dataset string, bucket int, a double, b double")
    seen = {tuple(EA.bucket_stats(df.repartition(n), ["a", ("a", "b")]).where("dataset = 'm'").first()) for n in (1, 3, 17)}
    assert len(seen) == 1
    row = seen.pop()
    assert abs(row[4] - a.std(ddof=1)) < 1e-8 and abs(row[5] - np.corrcoef(a, a + b)[0, 1]) < 1e-8
    big = EA.bucket_stats(df, ["a"]).where("dataset = 'n'").first()
    assert abs(big.a_std / (np.sqrt(2) * 1e30) - 1) < 1e-12


def test_whole_vocabulary_and_encoding_of_every_row(spark):
    rows = [(1, "b a a c"), (2, "a b [CLS] z"), (3, ""), (4, None), (5, "[X] c c")]
    df = spark.createDataFrame(rows, "id long, sentence string").withColumn("extra", F.col("id") * 10)
    extra = spark.createDataFrame([("[X]",), ("[A]",), ("[SEP]",), ("[X]",)], "token string")
    vocab = FT.build_vocab(FT.tokens(df), extra=extra)
    got = {r.token: (r.token_id, r["count"]) for r in vocab.collect()}
    assert got == {"[PAD]": (0, None), "[UNK]": (1, None), "[CLS]": (2, None), "[SEP]": (3, None), "[MASK]": (4, None),
                   "[A]": (5, None), "[X]": (6, None), "a": (7, 3), "c": (8, 3), "b": (9, 2), "z": (10, 1)}
    assert {r.token for r in FT.build_vocab(FT.tokens(df), 9, extra).collect()} == set(got) - {"b", "z"}
    e = {r.id: (list(r.input_ids), r.extra) for r in FT.encode(df, vocab, max_len=6, carry=("extra",)).collect()}
    assert e == {1: ([2, 9, 7, 7, 8, 3], 10), 2: ([2, 7, 9, 2, 10, 3], 20), 3: ([2, 3, 0, 0, 0, 0], 30), 4: ([2, 3, 0, 0, 0, 0], 40), 5: ([2, 6, 8, 8, 3, 0], 50)}
    pair = df.withColumn("question", F.when(F.col("id") != 3, F.lit("z")))
    q = {r.id: (list(r.input_ids), list(r.token_type_ids), r.extra) for r in FT.encode_pair(pair, vocab, max_len=7, carry=("extra",)).collect()}
    assert q[1] == ([2, 9, 7, 7, 3, 10, 3], [0, 0, 0, 0, 0, 1, 1], 10) and q[3][2] == 30


def test_encoding_moves_rows_and_distinct_tokens_only(spark):
    """Tokens are not regrouped one by one: a block's distinct tokens meet the vocabulary, and rows that repeat a key become one row."""
    df = spark.createDataFrame([(1, "a b"), (2, "b  c q"), (2, "c"), (3, "")], "id long, sentence string")
    vocab = spark.createDataFrame([("a", 5), ("b", 6), ("c", 7)], "token string, token_id int")
    once = FT.encode(df.where("id != 2"), vocab, max_len=6)
    assert "posexplode" not in once._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: list(r.input_ids) for r in FT.encode(df, vocab, max_len=6).collect()}
    assert got == {1: [2, 5, 6, 3, 0, 0], 2: [2, 6, 7, 7, 1, 3], 3: [2, 3, 0, 0, 0, 0]}
    assert {r.id: list(r.input_ids) for r in once.collect()} == {1: got[1], 3: got[3]}
    pair = FT.encode_pair(df.withColumn("question", F.lit("a c")), vocab, max_len=9).collect()
    assert {r.id: list(r.input_ids) for r in pair}[2] == [2, 6, 7, 7, 1, 3, 5, 5, 7, 7, 3]


def test_token_arrays_equal_plain_lists(spark):
    """Runs of equal numbers give what a look at each element gives: nulls, no padding, pads between, only pads, none."""
    ids = [[5, 6, 0, 0], [5, 6], [], [0, 0], [5, 0, 6], [5, None, 0], None, [None]]
    d = spark.createDataFrame([(x,) for x in ids], "ids array<int>")
    p = d.select("ids", FT.position_ids("ids").alias("p")).collect()
    for r in p:
        n, exp = 0, []
        for x in r.ids or []:
            n += x is not None and x != 0
            exp.append(n if x is not None and x != 0 else 0)
        assert r.p == (None if r.ids is None else exp) or None in (r.ids or [])
    for r in FT.masks(d, "ids").collect():
        assert r.attention_mask == (None if r.ids is None else [None if x is None else int(x != 0) for x in r.ids])
    s = spark.createDataFrame([(t,) for t in ["x @*P*a b@ y #^L^c# z", "#^L^c# @*P*a@ * d @ e", "no marks", "a @ b", "a * b", "* # a ^ b @ #", None]], "sentence string")
    for r in FT.entity_loc_ids(s, max_len=14).collect():
        tok = ["[CLS]", *__import__("re").sub("([@*#^])", r" \1 ", r.sentence or "").split()[:12], "[SEP]"]
        at = {m: max([i for i, t in enumerate(tok) if t == m], default=-1) for m in "*@^#"} if r.sentence is not None else dict.fromkeys("*@^#", -1)
        assert r.entity_loc_ids == [2 if at["^"] < i < at["#"] else 1 if at["*"] < i < at["@"] else 0 for i in range(14)]
