"""I01 and I02: models that are fitted, saved, loaded and applied."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from sentrel.operators import metrics as M
from sentrel.operators import scoring as I
from sentrel.plans.queries import QUERIES
from sentrel.session import scratch_path
from tests.conftest import SF_MID


def points(spark, n=600, classes=4, seed=1):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((classes, 6)) * 2
    rows = [(i, int(c), [float(x) for x in centres[c] + r.standard_normal(6)]) for i, c in enumerate(r.integers(0, classes, n))]
    return spark.createDataFrame(rows, "id long, label_id int, z array<double>")


def test_text_model_beats_the_majority_on_documents_it_has_not_seen(spark):
    out = QUERIES["i01_fit"](spark, SF_MID).where("part = 'valid'").select("label_id", "prediction").collect()
    counts = {k: sum(r.label_id == k for r in out) for k in (0, 1)}
    assert min(counts.values()) >= 5  # a tenth of each label
    right = sum(r.label_id == r.prediction for r in out)
    assert right > max(counts.values()) and right / len(out) > 0.8, (right, counts)


def test_rounds_start_where_the_last_ended_and_the_best_is_kept(spark):
    d = points(spark)
    train, valid = d.where("id % 5 > 0").cache(), d.where("id % 5 = 0").cache()
    history, path = I.fit_rounds(train, valid, 4, scratch_path(spark, "rounds"), rounds=8, iterations=2, patience=2)
    h = history.orderBy("step").collect()
    assert [r.step for r in h] == list(range(1, len(h) + 1)) and sum(r.best for r in h) == 1
    assert h[-1].accuracy > 0.8 and max(r.auprc for r in h) == next(r.auprc for r in h if r.best)
    # the saved best model is the one of the history
    again = M.compute_metrics(I.score(valid, I.load_model(path), "z"), "logits").first()
    best = next(r for r in h if r.best)
    assert math.isclose(again.auprc, best.auprc) and math.isclose(again.accuracy, best.accuracy)
    # two rounds of 3 steps from the first's weights are no worse on the training rows than one of 3
    one = I.linear_classifier(train, 4, iterations=3)
    two = I.linear_classifier(train, 4, iterations=3, weights=one.stages[-1].weights.toArray())
    loss = [M.cross_entropy(I.score(train, m, "z"), "logits").first()[0] for m in (one, two)]
    assert loss[1] < loss[0]


def test_given_weights_survive_saving_and_loading(spark):
    r = random.Random(2)
    coef = [[r.uniform(-1, 1) for _ in range(6)] for _ in range(4)]
    bias = [r.uniform(-1, 1) for _ in range(4)]
    d = points(spark, 50)
    model = I.linear_classifier(d, 4, iterations=0, weights=I.linear_weights(coef, bias))
    loaded = I.load_model(I.save_model(model, scratch_path(spark, "model")))
    native = {x.id: x for x in I.score_linear(d, coef, bias).collect()}
    for x in I.score(d, loaded, "z").select("*", F.size("probs").alias("k")).collect():
        y = native[x.id]
        assert x.k == 4 and x.prediction == y.prediction
        assert np.allclose(x.logits, y.logits) and np.allclose(x.probs, y.probs)
