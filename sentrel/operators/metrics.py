"""M-operators: evaluation aggregates, losses and early-stopping state.

Every metric is a grouped aggregate with map-side combine (one pass, partial
aggregation) or, for the PR curve and the plateau detector, a skew-safe
bucketed scan (:mod:`sentrel.operators.scan`): a class or run holding a third of
all rows is still spread over all tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.arrays import argmax, at, log_softmax, logsumexp, softmax
from sentrel.operators.scan import BUCKET, KEY, ranged, running


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def micro_f1_expr(pred, label, no_relation: int = 0) -> Column:
    """Aggregate: micro F1 x 100 over all classes except ``no_relation``."""
    pred, label = _c(pred), _c(label)
    tp = F.sum(((pred == label) & (label != no_relation)).cast("long"))
    den = F.sum((pred != no_relation).cast("long")) + F.sum((label != no_relation).cast("long"))
    return F.coalesce(_div(2.0 * tp, den.cast("double")) * 100.0, F.lit(0.0))


def micro_f1(df: DataFrame, z: str = "z", label: str = "label_id", no_relation: int = 0) -> DataFrame:
    """M01 micro F1 x 100 excluding ``no_relation``; 0 when undefined."""
    return df.agg(micro_f1_expr(argmax(z), label, no_relation).alias("micro_f1"))


def accuracy_expr(pred, label) -> Column:
    return F.avg((_c(pred) == _c(label)).cast("double"))


def accuracy(df: DataFrame, z: str = "z", label: str = "label_id") -> DataFrame:
    """M03 accuracy of the arg-max class."""
    return df.agg(accuracy_expr(argmax(z), label).alias("accuracy"))


def pr_points(df: DataFrame, z: str = "z", label: str = "label_id") -> DataFrame:
    """Per class one-vs-rest PR-curve points at every distinct score (highest
    first): ``cls, score, tp, fp`` cumulative, ``tp_c, fp_c`` at the score, ``tp_total`` positives of the class."""
    long = df.select(F.posexplode(z).alias("cls", "score"), F.col(label).alias("_y"))
    pts = long.groupBy("cls", "score").agg(
        F.sum((F.col("_y") == F.col("cls")).cast("long")).alias("tp_c"),
        F.sum((F.col("_y") != F.col("cls")).cast("long")).alias("fp_c"))
    return running(pts, ["cls"], [F.col("score").desc()], [("tp", "sum", F.col("tp_c")), ("fp", "sum", F.col("fp_c"))], totals=["tp"])


def auprc_per_class(df: DataFrame, z: str = "z", label: str = "label_id", empty_value: float | None = None) -> DataFrame:
    """Area under each class's PR curve (trapezoids over recall, curve closed
    at recall 0 / precision 1). Classes without positives are left out, or have ``empty_value``."""
    r = pr_points(df, z, label)
    n = F.nullif(F.col("tp_total"), F.lit(0))
    tp0, fp0 = F.col("tp") - F.col("tp_c"), F.col("fp") - F.col("fp_c")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prec0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(tp0 / F.nullif(tp0 + fp0, F.lit(0)))
    area = (F.col("tp") - tp0) / n * (prec + prec0) / 2.0
    out = r.groupBy("cls").agg(F.sum(area).alias("auprc"))
    return out.where(F.col("auprc").isNotNull()) if empty_value is None else out.fillna(empty_value, ["auprc"])


def auprc(df: DataFrame, z: str = "z", label: str = "label_id", use_softmax: bool = False, empty_value: float | None = None) -> DataFrame:
    """M02 macro AUPRC x 100 (plain mean over classes with positives; with
    ``empty_value``, over all classes, those without positives counted with it). Scores
    are taken as given (the reference passes logits); ``use_softmax`` first."""
    d = df.withColumn(z, softmax(z)) if use_softmax else df
    return auprc_per_class(d, z, label, empty_value).agg((F.avg("auprc") * 100.0).alias("auprc"))


def compute_metrics(df: DataFrame, z: str = "z", label: str = "label_id",
                    use_softmax: bool = False, empty_value: float | None = None) -> DataFrame:
    """M04 one row: ``micro_f1, auprc, accuracy`` (one pass for F1/accuracy,
    one for the PR curves; combined by a single-row union + aggregate)."""
    a = df.agg(micro_f1_expr(argmax(z), label).alias("micro_f1"),
               accuracy_expr(argmax(z), label).alias("accuracy"))
    b = auprc(df, z, label, use_softmax, empty_value)
    u = a.unionByName(b, allowMissingColumns=True)
    return u.agg(F.max("micro_f1").alias("micro_f1"), F.max("auprc").alias("auprc"),
                 F.max("accuracy").alias("accuracy"))


def cross_entropy(df: DataFrame, z: str = "z", label: str = "label_id") -> DataFrame:
    """M05 mean cross-entropy ``logsumexp(z) - z[y]``."""
    return df.agg(F.avg(logsumexp(z) - at(z, label)).alias("ce"))


def focal(df: DataFrame, z: str = "z", label: str = "label_id", gamma: float = 2.0) -> DataFrame:
    """M06 focal loss: mean of ``-(1 - p_y)^gamma * log p_y``."""
    lp = at(z, label) - logsumexp(z)
    return df.agg(F.avg(-F.pow(1.0 - F.exp(lp), gamma) * lp).alias("focal"))


def label_smooth(df: DataFrame, z: str = "z", label: str = "label_id", smoothing: float = 0.0) -> DataFrame:
    """M07 label-smoothed CE: target ``1-s`` on the label, ``s/(C-1)`` elsewhere."""
    lsm = log_softmax(z)
    c = F.size(z).cast("double")
    lp_y = at(lsm, label)
    total = F.aggregate(lsm, F.lit(0.0), lambda a, x: a + x)
    row = -((1.0 - smoothing) * lp_y + (smoothing / (c - 1.0)) * (total - lp_y))
    return df.agg(F.avg(row).alias("label_smooth"))


def soft_f1(df: DataFrame, z: str = "z", label: str = "label_id", eps: float = 1e-7) -> DataFrame:
    """M08 soft F1 loss over the whole table: per class soft tp/fp/fn from the
    softmax, F1 clamped to ``[eps, 1-eps]``, ``1 - mean``."""
    long = df.select(F.posexplode(softmax(z)).alias("cls", "p"), F.col(label).alias("_y"))
    y = (F.col("_y") == F.col("cls")).cast("double")
    per = long.groupBy("cls").agg(F.sum(y * F.col("p")).alias("tp"),
                                  F.sum((1.0 - y) * F.col("p")).alias("fp"),
                                  F.sum(y * (1.0 - F.col("p"))).alias("fn"))
    prec = F.col("tp") / (F.col("tp") + F.col("fp") + eps)
    rec = F.col("tp") / (F.col("tp") + F.col("fn") + eps)
    f1 = 2.0 * prec * rec / (prec + rec + eps)
    f1 = F.least(F.greatest(f1, F.lit(eps)), F.lit(1.0 - eps))
    return per.agg((1.0 - F.avg(f1)).alias("soft_f1"))


def plateau(df: DataFrame, run: str = "run", step: str = "step", value: str = "value",
            mode: str = "min", patience: int = 5) -> DataFrame:
    """M09 early-stopping state per ``(run, step)`` in step order.

    Negative values and nulls are skipped; a NaN is a step without improvement. A strict improvement over the best so far
    (lower for ``min``, higher for ``max``) sets ``best`` and resets the
    counter, otherwise the counter grows by one; ``stop`` turns true when the
    counter reaches ``patience`` and stays true."""
    if mode not in ("min", "max"):
        raise ValueError(f"unknown direction {mode!r}: say whether lower (min) or higher (max) values are better")
    # numbers only: a NaN is never an improvement, but counts as a step without one
    number = F.when(~F.isnan(value), F.col(value))
    none, kind = (math.inf, "min") if mode == "min" else (-math.inf, "max")
    d = ranged(df.where(F.col(value) >= 0), [run], [F.col(step)])
    r = running(d, [run], [F.col(step)], [("_prev", kind, number), ("_before", "sum", F.lit(1))], F.col(BUCKET), exclusive=True, keep=True)
    prev = F.coalesce("_prev", F.lit(none))
    r = r.withColumn("rn", (F.col("_before") + 1).cast("long")) \
         .withColumn("best", F.coalesce(number < prev if mode == "min" else number > prev, F.lit(False)))
    # last improvement inside the bucket; the buckets before come as one row each
    upto = Window.partitionBy(KEY, BUCKET).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("best"), F.col("rn"))
    r = r.withColumn("_last", F.max(mark).over(upto))
    pieces = r.groupBy(KEY, BUCKET).agg(F.min(mark).alias("_first"), F.max(mark).alias("_late"), F.max("rn").alias("_end"),
                                        F.max(F.col("rn") - F.col("_last")).alias("_inner"))
    before = Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_carry", F.coalesce(F.max("_late").over(before), F.lit(0)))
    # the longest row of steps without improvement in a bucket: at its begin, or after its first improvement
    longest = F.greatest(F.col("_inner"), F.coalesce(F.col("_first") - 1, F.col("_end")) - F.col("_carry"))
    pieces = pieces.select(KEY, BUCKET, "_carry", F.max((longest >= patience).cast("int")).over(before).alias("_stopped"))
    r = r.join(pieces, [KEY, BUCKET])
    r = r.withColumn("patience_cnt", (F.col("rn") - F.greatest("_last", "_carry")).cast("long"))
    here = F.max((F.col("patience_cnt") >= patience).cast("int")).over(upto)
    r = r.withColumn("stop", F.greatest(here, "_stopped") == 1)
    return r.drop("_prev", "_before", "_last", "_carry", "_stopped", KEY, BUCKET)


def best_step(df: DataFrame, run: str = "run", step: str = "step", value: str = "value",
              mode: str = "max", patience: int = 5) -> DataFrame:
    """M10 per run: the best step (ties -> lowest step; a NaN is never best), its value, and the
    first step at which :func:`plateau` stops (NULL if never)."""
    p = plateau(df, run, step, value, mode, patience)
    v, s = F.col(value), F.col(step)
    rank = F.struct(v, -s) if mode == "max" else F.struct(-v, -s)
    pick = F.max_by(F.struct(s.alias("s"), v.alias("v")), F.when(~F.isnan(value), rank))
    out = p.groupBy(run).agg(pick.alias("_b"), F.min(F.when(F.col("stop"), s)).alias("stop_step"))
    return out.select(run, F.col("_b.s").alias("best_step"), F.col("_b.v").alias("best_value"), "stop_step")
