"""E-operators: error analysis over a catalog of prediction tables.

A catalog is ONE DataFrame with a ``dataset`` column (instead of a dict of
frames): enabling datasets is a filter, per-dataset work is a grouping key,
and every statistic is computed per dataset in one distributed pass. Quantiles
are exact (:func:`sentrel.operators.scan.quantiles`) without sending a group to
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrel.functions.arrays import argmax, at, decode_probs, format_fixed, format_probs, softmax
from sentrel.functions.hashing import h
from sentrel.functions.text import count_spaces, ws_tokens
from sentrel.operators.scan import join_groups, quantiles, quantiles_of_counts, value_counts
from sentrel.operators.spans import num_to_label
from sentrel.schema import LABELS

DS = "dataset"


# --- E01 / E02 / E03 ------------------------------------------------------------

class Catalog:
    """Named prediction tables as one DataFrame (``dataset`` column)."""

    def __init__(self, df: DataFrame, enabled: Sequence[str] | None = None):
        self.df = df
        self.enabled = list(enabled) if enabled is not None else None

    def enable_all(self) -> Catalog:
        return Catalog(self.df, None)

    def enable(self, names: Sequence[str]) -> Catalog:
        """E01 restrict later results to ``names``."""
        return Catalog(self.df, names)

    def view(self) -> DataFrame:
        """Rows of the enabled datasets."""
        return self.df if self.enabled is None else self.df.where(F.col(DS).isin(list(self.enabled)))

    def get(self, name: str) -> DataFrame:
        return self.df.where(F.col(DS) == name)

    def gets(self, names: Sequence[str] | None = None) -> DataFrame:
        return self.df if names is None else self.df.where(F.col(DS).isin(list(names)))

    def datasets(self) -> DataFrame:
        """E02 datasets with their row counts."""
        return self.view().groupBy(DS).agg(F.count(F.lit(1)).alias("n_rows"))

    def columns(self) -> DataFrame:
        """E02 column names and types (same for every dataset)."""
        spark = self.df.sparkSession
        rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(self.df.schema.fields)]
        return spark.createDataFrame(rows, "ordinal int, column string, type string")


def annotate(df: DataFrame, label: str | None = "label_id", probs_text: str | None = "output_prob",
             sentences: Sequence[str] = ("sentence",)) -> DataFrame:
    """E03 derive the analysis columns from column roles: ``label`` (label
    id), ``probs_text`` (space-separated probabilities) and text columns."""
    d = df
    if label and probs_text:
        d = prediction_features(d.withColumn("_probs", decode_probs(probs_text)), "_probs", label).drop("_probs")
    for s in sentences:
        d = text_features(d, s)
    return d


# --- E05 / E06 / E07 ------------------------------------------------------------

def with_output_prob(df: DataFrame, z: str = "z") -> DataFrame:
    """Scored table as the scorer writes it: softmax as ``%.3f`` text."""
    return df.withColumn("output_prob", format_probs(softmax(z), 3, " "))


def prediction_features(df: DataFrame, probs: str = "probs", label: str = "label_id") -> DataFrame:
    """E06 ``num_label, num_pred, pred, pred_confidence, label_confidence, answer``
    (``pred.confidence`` etc. of the reference, with ``_`` for ``.``)."""
    d = df.withColumn("num_label", F.col(label).cast("int")) \
          .withColumn("num_pred", argmax(probs)) \
          .withColumn("pred_confidence", F.array_max(probs)) \
          .withColumn("label_confidence", at(probs, label))
    d = num_to_label(d, "num_pred", "pred")
    d = num_to_label(d, "num_label", "_label_name")
    return d.withColumn("answer", (F.col("pred") == F.col("_label_name")).cast("int")).drop("_label_name")


def text_features(df: DataFrame, col: str = "sentence") -> DataFrame:
    """E07 ``<col>_space`` (spaces), ``<col>_len`` (characters) and
    ``<col>_token_num`` (whitespace tokens)."""
    return df.withColumn(f"{col}_space", count_spaces(col)) \
             .withColumn(f"{col}_len", F.length(col)) \
             .withColumn(f"{col}_token_num", F.size(ws_tokens(col)))


# --- E04 -----------------------------------------------------------------------------

def exact_mean(col: str) -> Column:
    """Mean from an exact decimal sum (nine places), so that it does not depend
    on the order in which partitions are added up; Spark's own mean where a number does not fit."""
    d, n = F.expr(f"try_cast(`{col}` AS decimal(28,9))"), F.count(F.col(col))
    return F.when(F.count(d) == n, F.try_sum(d).cast("double") / F.nullif(n, F.lit(0))).otherwise(F.avg(col))


def _decimal(col: str) -> Column:
    return F.expr(f"try_cast(`{col}` AS decimal(18,9))")


def _exact(cols: Sequence[str], value: Column, otherwise: Column) -> Column:
    """``value`` where all numbers of ``cols`` have a decimal (below 10^9, finite) and no sum overflows, else ``otherwise``."""
    whole = [F.count(_decimal(c)) == F.count(F.col(c)) for c in cols]
    ok = whole[0]
    for w in whole[1:]:
        ok = ok & w
    return F.when(ok & value.isNotNull(), value).otherwise(otherwise)


def _moment(a: str, b: str) -> Column:
    """Sum of ``(a - mean a)(b - mean b)`` from exact decimal sums."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    n = F.sum(both.cast("int"))
    s = [F.try_sum(F.when(both, x)).cast("double") for x in (_decimal(a), _decimal(b), _decimal(a) * _decimal(b))]
    return s[2] - s[0] * s[1] / F.nullif(n, F.lit(0))


def exact_std(col: str) -> Column:
    """Sample deviation (n-1) from exact sums of x and x*x at nine places: the same under any
    partitioning. Numbers that do not fit take Spark's own deviation."""
    n = F.count(F.col(col))
    v = F.when(n >= 2, F.sqrt(F.greatest(F.lit(0.0), _moment(col, col)) / F.nullif(n - 1, F.lit(0))))
    return F.when(n >= 2, _exact([col], v, F.stddev_samp(col)))


def exact_corr(a: str, b: str) -> Column:
    """Pearson correlation from exact sums; null without variance."""
    va, vb = _moment(a, a), _moment(b, b)
    ok = (F.count(F.lit(1)) >= 2) & (F.var_samp(a) > 0) & (F.var_samp(b) > 0)
    return F.when(ok, _exact([a, b], _moment(a, b) / F.nullif(F.sqrt(F.greatest(F.lit(0.0), va * vb)), F.lit(0.0)), F.corr(a, b)))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E04 per dataset and column: count, mean, std (n-1), min, exact
    quartiles, max."""
    long = df.select(DS, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])).alias("_e")) \
        .select(DS, "_e.column", "_e.x")
    g = [DS, "column"]
    base = long.groupBy(*g).agg(F.count("x").alias("count"), exact_mean("x").alias("mean"),
                                exact_std("x").alias("std"), F.min("x").alias("min"),
                                F.max("x").alias("max"))
    q = quantiles(long, g, "x", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return join_groups(base, q, g, "left")


# --- E08 - E11: thresholds and buckets --------------------------------------------------

def iqr_thresholds(df: DataFrame, col: str) -> DataFrame:
    """E08 per dataset ``th = [q1-1.5*IQR, q1, q3, q3+1.5*IQR]`` (exact,
    linear interpolation)."""
    q = quantiles(df, [DS], col, [0.25, 0.75], ["_q1", "_q3"])
    iqr = F.col("_q3") - F.col("_q1")
    return q.select(DS, F.array(F.col("_q1") - 1.5 * iqr, F.col("_q1"), F.col("_q3"),
                                F.col("_q3") + 1.5 * iqr).alias("th"))


def thresholds(df: DataFrame, col: str, values: Sequence[float] | None = None,
               percentile: bool = False) -> DataFrame:
    """E09 explicit thresholds (same for every dataset) or, with
    ``percentile``, the per-dataset quantiles at the given fractions (0-1)."""
    if values is None:
        return iqr_thresholds(df, col)
    if percentile:
        names = [f"_p{i}" for i in range(len(values))]
        q = quantiles(df, [DS], col, list(values), names)
        return q.select(DS, F.array(*[F.col(n) for n in names]).alias("th"))
    return df.select(DS).distinct().withColumn("th", F.array(*[F.lit(float(v)) for v in values]))


def bucket_expr(x, th) -> Column:
    """E10 half-open buckets ``<t0, [t0,t1), ..., >=tk``; NULL stays NULL."""
    x = F.col(x) if isinstance(x, str) else x
    th = F.col(th) if isinstance(th, str) else th
    return F.when(x.isNotNull(), F.size(F.filter(th, lambda t: t <= x)))


def bucketize(df: DataFrame, col: str, th: DataFrame, out: str = "bucket") -> DataFrame:
    """E10 attach per-dataset thresholds (one row per dataset) and bucket."""
    d = join_groups(df, th, [DS])
    return d.withColumn(out, bucket_expr(col, "th"))


def bucket_labels(th: DataFrame, digits: int = 2) -> DataFrame:
    """E11 ``~t0`` for bucket 0, then each bucket's lower bound, ``%.2f``."""
    e = th.select(DS, F.posexplode(F.concat(F.array(F.element_at("th", 1)), F.col("th"))).alias("bucket", "t"))
    label = format_fixed("t", digits)
    return e.select(DS, "bucket", F.when(F.col("bucket") == 0, F.concat(F.lit("~"), label))
                    .otherwise(label).alias("label"))


# --- E12 / E13 / E14 ---------------------------------------------------------------------

def bucket_stats(bucketed: DataFrame, cols: Sequence, bucket: str = "bucket") -> DataFrame:
    """E12/E13 per dataset and non-empty bucket: ``count``; for a column
    ``c``: ``c_mean`` and ``c_std`` (n-1); for a pair ``(a, b)``:
    ``a_b_pearson``."""
    aggs = [F.count(F.lit(1)).alias("count")]
    for c in cols:
        if isinstance(c, tuple):
            a, b = c
            aggs.append(exact_corr(a, b).alias(f"{a}_{b}_pearson"))
        else:
            aggs += [exact_mean(c).alias(f"{c}_mean"), exact_std(c).alias(f"{c}_std")]
    return bucketed.where(F.col(bucket).isNotNull()).groupBy(DS, bucket).agg(*aggs)


def group_stats(df: DataFrame, by: str = "num_label", col: str = "label_confidence",
                n_classes: int = len(LABELS), mode: Sequence[str] = ("count", "mean", "std"),
                sort: str | None = None) -> DataFrame:
    """E14 per dataset and class ``0..n_classes-1`` (every class, count 0 when
    absent): ``count, mean, std`` of ``col`` grouped by ``by`` (those that ``mode``
    names); class names from the label dimension; ``sort`` names one of them to
    order the classes of each dataset by, largest first."""
    agg = df.groupBy(DS, F.col(by).alias("class_id")).agg(
        F.count(F.lit(1)).alias("count"), exact_mean(col).alias("mean"), exact_std(col).alias("std"))
    grid = df.select(DS).distinct().select(DS, F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))).alias("class_id"))
    out = join_groups(grid, agg, [DS, "class_id"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    out = num_to_label(out, "class_id", "class_name")
    out = out.select(DS, "class_id", *[m for m in ("count", "mean", "std") if m in mode], "class_name")
    return out.orderBy(DS, F.col(sort).desc_nulls_last(), "class_id") if sort else out


# --- E15 - E18: distributions ----------------------------------------------------------------

def box_stats(df: DataFrame, group: Sequence[str], col: str) -> DataFrame:
    """Box-plot table per group: n, min, q1, median, q3, max, whiskers (the
    most extreme values within 1.5 IQR of the box) and the outlier count."""
    group = list(group)
    v = value_counts(df, group, col)  # one row per distinct value: all that follows reads these
    q = quantiles_of_counts(v, group, col, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    x, n = F.col(col), F.col("_c")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    return join_groups(v, q, group).groupBy(*group).agg(
        F.sum(n).alias("n"), F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"),
        F.min(F.when(x >= low, x)).cast("double").alias("lower_whisker"),
        F.max(F.when(x <= high, x)).cast("double").alias("upper_whisker"),
        F.sum(F.when((x < low) | (x > high), n).otherwise(0)).alias("n_outliers"),
        *[F.first(c).alias(c) for c in ("q1", "median", "q3")])


def conditional_dist(df: DataFrame, cond: str, show: str, th: DataFrame | None = None) -> DataFrame:
    """E15 distribution of ``show`` per dataset and bucket of ``cond``;
    thresholds per dataset (IQR ones by default)."""
    th = th if th is not None else iqr_thresholds(df, cond)
    return box_stats(bucketize(df, cond, th).where(F.col("bucket").isNotNull()), [DS, "bucket"], show)


def group_dist(df: DataFrame, show: str) -> DataFrame:
    """E16 distribution of ``show`` per dataset."""
    return box_stats(df, [DS], show)


def condition_group_dist(df: DataFrame, cond: str, show: str, th: Sequence[float]) -> DataFrame:
    """E17 as E15 with fixed thresholds shared by all datasets."""
    return conditional_dist(df, cond, show, thresholds(df, cond, th))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """E18 counts of ``col`` in ``bins`` equal-width bins over each dataset's
    range (the last bin is closed)."""
    x = F.col(col).cast("double")
    rng = df.groupBy(DS).agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    b = F.when(w > 0, F.least(F.lit(bins - 1), F.floor((x - F.col("_mn")) / w).cast("int"))).otherwise(F.lit(0))
    return join_groups(df.where(x.isNotNull()), rng, [DS]).groupBy(DS, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


# --- E19 - E22: extracts and filters -------------------------------------------------------------

def scatter_points(df: DataFrame, x: str, y: str, color: str | None = None, size: str | None = None,
                   hover: Sequence[str] = (), fraction: float | None = None, salt: str = "scatter") -> DataFrame:
    """E19 columns behind a scatter plot; ``fraction`` keeps a deterministic
    hash sample of that share of rows (a sampling feature, off by default)."""
    cols = [DS, "id", x, y] + [c for c in (color, size) if c] + list(hover)
    d = df.select(*dict.fromkeys(cols))
    if fraction is not None:
        d = d.where(h(salt, DS, "id") % 1_000_000 < int(fraction * 1_000_000))
    return d


def bar_points(df: DataFrame, x: str, y: str, text: str | None = None) -> DataFrame:
    """E20 columns behind a bar plot (``text`` defaults to ``y``)."""
    return df.select(DS, F.col(x).alias("x"), F.col(y).alias("y"), F.col(text or y).alias("text"))


def filter_contains(df: DataFrame, col: str, pattern: str, ref: str | None = None,
                    mode: str = "contain") -> DataFrame:
    """E21 rows whose ``col`` matches ``pattern`` (regex), in every dataset;
    E22 with ``ref``: ids whose row in dataset ``ref`` matches, kept in every
    dataset (left semi join on id)."""
    if mode != "contain":
        raise ValueError(mode)
    if ref is None:
        return df.where(F.col(col).rlike(pattern))
    ids = df.where((F.col(DS) == ref) & F.col(col).rlike(pattern)).select("id")
    return df.join(ids, "id", "left_semi")

