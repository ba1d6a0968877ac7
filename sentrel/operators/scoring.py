"""I-operators: fit a relation classifier with Spark ML, batch-score tables,
and turn scores into submission / scored-dev tables.

A fitted model is a folder: it is saved with Spark ML's own writer into the shared folder and
loaded from there by the job that scores (:func:`save_model`, :func:`load_model`). Training in rounds
(:func:`fit_rounds`) evaluates each round on the validation part with M04, keeps the history as a table, stops by M09 and
takes the best round by M10.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.functions.arrays import argmax, format_fixed, format_probs, softmax
from sentrel.operators import metrics as M
from sentrel.operators.spans import num_to_label


def fit_text(df: DataFrame, text: str = "sentence", label: str = "label_id",
             num_features: int = 1 << 18, max_iter: int = 50, reg: float = 0.0) -> PipelineModel:
    """I01 relation classifier on (marked) text: tokens -> hashed TF -> IDF ->
    multinomial logistic regression. Distributed fit (Spark ML)."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+|(?=[@*#^])|(?<=[@*#^])"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label, family="multinomial",
                           maxIter=max_iter, regParam=reg, predictionCol="prediction",
                           probabilityCol="_prob", rawPredictionCol="_raw"),
    ]
    return Pipeline(stages=stages).fit(df.withColumn(label, F.col(label).cast("double")))


def fit_vectors(df: DataFrame, features: str = "z", label: str = "label_id",
                max_iter: int = 50, reg: float = 0.0) -> PipelineModel:
    """I01 classifier on an ``array<double>`` feature column."""
    d = _featured(df, features).withColumn(label, F.col(label).cast("double"))
    lr = LogisticRegression(featuresCol="_features", labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=reg, probabilityCol="_prob", rawPredictionCol="_raw")
    return Pipeline(stages=[lr]).fit(d)


def linear_classifier(train: DataFrame, classes: int, features: str = "z", label: str = "label_id", iterations: int = 50,
                      weights: Sequence[float] | None = None) -> PipelineModel:
    """I01 softmax regression on an ``array<double>`` column, fitted from ``weights`` (an earlier round's, or
    given ones with ``iterations=0``) or from random ones. Labels are ``0..classes-1``; their number is
    stated, as a part need not hold them all."""
    d = _featured(train, features).withColumn(label, F.col(label).cast("double"))
    size = d.select(F.size(features)).first()
    start = {} if weights is None else {"initialWeights": Vectors.dense(list(weights))}
    mlp = MultilayerPerceptronClassifier(layers=[size[0] if size else 1, classes], featuresCol="_features", labelCol=label, maxIter=iterations, seed=1,
                                         probabilityCol="_prob", rawPredictionCol="_raw", **start)
    return Pipeline(stages=[mlp]).fit(d)


def linear_weights(coef: Sequence[Sequence[float]], intercept: Sequence[float]) -> list[float]:
    """Weights of :func:`linear_classifier` from one row of coefficients per class: feature by feature, then the intercepts."""
    return [float(row[j]) for j in range(len(coef[0])) for row in coef] + [float(b) for b in intercept]


def _featured(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_features", array_to_vector(features))


def save_model(model: PipelineModel, path: str) -> str:
    """The model as a folder at ``path`` (which must not exist)."""
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_rounds(train: DataFrame, valid: DataFrame, classes: int, path: str, features: str = "z", label: str = "label_id", rounds: int = 20,
               iterations: int = 5, patience: int = 5, metric: str = "auprc", run: str = "fit") -> tuple[DataFrame, str]:
    """I01 in rounds of ``iterations`` each, every one beginning with the weights of the one before. After each,
    the model is saved under ``path`` and evaluated on ``valid`` (M04); rounds end when ``metric`` has not improved
    for ``patience`` of them (M09). Returns the history ``run, step, micro_f1, auprc, accuracy, best`` and the folder
    of the best round's model (M10); ``train`` and ``valid`` are read once per iteration, so pass written tables."""
    spark = train.sparkSession
    history, weights = [], None
    columns = f"run string, step bigint, {', '.join(f'{m} double' for m in ('micro_f1', 'auprc', 'accuracy'))}"
    for step in range(1, rounds + 1):
        model = linear_classifier(train, classes, features, label, iterations, weights)
        weights = model.stages[-1].weights.toArray().tolist()
        save_model(model, f"{path}/round-{step}")
        m = M.compute_metrics(score(valid, model, features), "logits", label).first()
        history.append((run, step, m.micro_f1, m.auprc, m.accuracy))
        table = spark.createDataFrame(history, columns)
        values = table.select("run", "step", F.col(metric).alias("value"))
        if step > patience and not M.plateau(values, mode="max", patience=patience).where("stop").isEmpty():
            break
    best = M.best_step(values, mode="max", patience=patience).first().best_step
    return table.withColumn("best", F.col("step") == best), f"{path}/round-{best}"


def score(df: DataFrame, model: PipelineModel, features: str | None = None) -> DataFrame:
    """I02 batch scoring with a fitted (or loaded) pipeline: adds ``prediction`` (INT),
    ``logits`` and ``probs`` (``array<double>``); rows keep their ids, so no
    order needs preserving."""
    out = model.transform(_featured(df, features) if features else df)
    out = out.withColumn("prediction", F.col("prediction").cast("int")) \
             .withColumn("logits", vector_to_array("_raw")).withColumn("probs", vector_to_array("_prob"))
    return out.drop("_features", "_tokens", "_tf", "_raw", "_prob")


def score_linear(df: DataFrame, coef: Sequence[Sequence[float]], intercept: Sequence[float], features: str = "z") -> DataFrame:
    """I02 with given weights (one row per class), in native expressions: adds
    ``logits``, ``probs`` and ``prediction``; all other columns stay."""
    def logit(row, b):
        terms = F.zip_with(features, F.array(*[F.lit(float(w)) for w in row]), lambda x, w: x * w)
        return F.aggregate(terms, F.lit(float(b)), lambda a, x: a + x)

    d = df.withColumn("logits", F.array(*[logit(row, b) for row, b in zip(coef, intercept, strict=True)]))
    return d.withColumn("probs", softmax("logits")).withColumn("prediction", argmax("logits"))


def score_external(df: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]],
                   features: str, keep: list[str]) -> DataFrame:
    """I02 for a model that is not a Spark ML model: ``load()`` runs once per
    partition in the Python worker and returns a function from a feature
    matrix to a logit matrix; rows move in Arrow batches (``mapInPandas``)."""
    schema = T.StructType([f for f in df.schema.fields if f.name in keep]
                          + [T.StructField("logits", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = load()
        for b in batches:
            x = np.stack(b[features].to_numpy()) if len(b) else np.zeros((0, 0))
            logits = fn(x) if len(b) else np.zeros((0, 0))
            out = b[keep].copy()
            out["logits"] = list(logits)
            yield out

    return df.select(*keep, features).mapInPandas(run, schema)


def linear_loader(coef: np.ndarray, intercept: np.ndarray):
    """A loader for :func:`score_external` applying ``x @ coef.T + b``."""
    def load():
        w, b = np.asarray(coef, dtype=float), np.asarray(intercept, dtype=float)
        return lambda x: x @ w.T + b
    return load


def submission(df: DataFrame, z: str = "z") -> DataFrame:
    """I05 ``id, pred_label, probs`` (probs as ``[p0, p1, ...]`` text)."""
    d = df.withColumn("_pred", argmax(z)).withColumn("_p", softmax(z))
    d = num_to_label(d, "_pred", "pred_label")
    probs = F.concat(F.lit("["), F.array_join(F.transform("_p", lambda x: format_fixed(x, 6)), ", "),
                     F.lit("]"))
    return d.select("id", "pred_label", probs.alias("probs"))


def scored_dev(df: DataFrame, z: str = "z") -> DataFrame:
    """I06 input columns + ``output_prob``: softmax as ``%.3f`` joined by spaces."""
    return df.withColumn("output_prob", format_probs(softmax(z), 3, " "))
