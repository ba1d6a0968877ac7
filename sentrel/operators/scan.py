"""Skew-safe ordered scans: running aggregates, ranks and exact quantiles.

A window ``PARTITION BY g ORDER BY o`` sends a whole group ``g`` to one task.
When one label, class or run holds a third of all rows that task holds a third
of the data. The helpers here split every group into *buckets* that are
monotone along the order (a hash range, or a value range), run the window per
``(group, bucket)``, and add the totals of all earlier buckets of the group
(a prefix over a table of at most groups x buckets rows). The answer is the
same as the plain window; no task ever holds more than one bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.hashing import TWO_32
from sentrel.session import dealt, materialize

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}

BUCKET = "_bkt"
KEY = "_grp"


def n_buckets(df: DataFrame) -> int:
    """Buckets per group: a few per shuffle partition, so a hot group spreads
    over the whole cluster."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 4 * parts)


def hash_bucket(h: Column, nb: int) -> Column:
    """Bucket of a uniform 32-bit hash; monotone in ``h``."""
    return F.floor(h.cast("double") * nb / TWO_32).cast("int")


def group_key(group: Sequence[str]) -> Column:
    """The group as one column that is never null and joins null groups too."""
    return F.struct(*[F.col(g) for g in group]) if group else F.struct(F.lit(0).alias("all"))


def join_groups(left: DataFrame, right: DataFrame, group: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the group columns, null groups included."""
    group = list(group)
    r = right.select(group_key(group).alias(KEY), *[c for c in right.columns if c not in group])
    return left.withColumn(KEY, group_key(group)).join(r, KEY, how).drop(KEY)


def beside_groups(left: DataFrame, right: DataFrame, group: Sequence[str], block: str) -> DataFrame:
    """``left`` joined with ``right`` (at most one row a group) on the group columns, null groups included, as a left join. Both have
    the column ``block``, one value a group: their rows meet in one exchange by block, and stay dealt by it (:func:`sentrel.session.dealt`)."""
    own = "_own"
    both = left.withColumn(own, F.lit(True)).unionByName(right.withColumn(own, F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(block, *group)
    found = {c: F.max(c).over(w) for c in right.columns if c not in (*group, block)}
    return dealt(both, block).withColumns(found).where(own).drop(own)


def ranged(df: DataFrame, group: Sequence[str], order: Sequence[Column], buckets: int | None = None,
           write: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """``df`` range-sorted into buckets (column ``BUCKET``) of about equally many rows, monotone along ``(group,
    order)``, and written once: later branches must see the same buckets."""
    by = [F.col(g) for g in group] + list(order)
    return write(df.repartitionByRange(buckets or n_buckets(df), *by).withColumn(BUCKET, F.spark_partition_id()))


def running(df: DataFrame, group: Sequence[str], order: Sequence[Column],
            aggs: Sequence[tuple[str, str, Column]], bucket: Column | None = None,
            exclusive: bool = False, totals: Sequence[str] = (), keep: bool = False) -> DataFrame:
    """Add running aggregates along ``order`` inside each ``group``.

    ``aggs`` holds ``(name, kind, expr)`` with kind ``sum``/``max``/``min``.
    The frame is all rows of the group up to the current one (``exclusive``:
    up to the previous one). ``order`` should be unique inside a group, as for
    any ROWS frame. ``bucket`` must be non-decreasing along ``order`` inside
    each group; without it the rows are :func:`ranged` first. ``totals`` names sums that
    also come for the whole group, as ``<name>_total``. ``keep`` leaves ``BUCKET`` and ``KEY`` in the
    result, which is partitioned by both.
    """
    d = ranged(df, group, order) if bucket is None else df.withColumn(BUCKET, bucket)
    d = d.withColumn(KEY, group_key(group))
    keys = [KEY, BUCKET]
    hi = -1 if exclusive else Window.currentRow
    w_local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    local = d.select("*", *[_AGG[k](e).over(w_local).alias(f"_l_{n}") for n, k, e in aggs])
    sums = d.groupBy(*keys).agg(*[_AGG[k](e).alias(f"_t_{n}") for n, k, e in aggs])
    w_carry = Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, *[_AGG[k](F.col(f"_t_{n}")).over(w_carry).alias(f"_c_{n}") for n, k, _ in aggs],
                        *[F.sum(f"_t_{n}").over(Window.partitionBy(KEY)).alias(f"{n}_total") for n in totals])
    out = local.join(carry, keys, "left")
    for n, k, _ in aggs:
        c, loc = F.col(f"_c_{n}"), F.col(f"_l_{n}")
        if k == "sum":
            val = F.coalesce(c, F.lit(0)) + F.coalesce(loc, F.lit(0))
        elif k == "max":
            val = F.greatest(c, loc)
        else:
            val = F.least(c, loc)
        out = out.withColumn(n, val)
    out = out.drop(*[f"_{p}_{n}" for n, _, _ in aggs for p in ("l", "c")])
    return out if keep else out.drop(*keys)


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  bucket: Column | None = None, name: str = "rk") -> DataFrame:
    """1-based row number along ``order`` inside ``group`` (skew-safe)."""
    return running(df, group, order, [(name, "sum", F.lit(1))], bucket) \
        .withColumn(name, F.col(name).cast("bigint"))


def value_counts(df: DataFrame, group: Sequence[str], x: str) -> DataFrame:
    """Each group's distinct non-null values of ``x`` with their number ``_c`` and, along the values, how many
    rows are up to it (``_cum``) and in the group (``_cum_total``). Ties are collapsed
    map-side, so what is sorted is the distinct values."""
    v = df.where(F.col(x).isNotNull()).groupBy(*group, x).agg(F.count(F.lit(1)).alias("_c"))
    return running(v, group, [F.col(x)], [("_cum", "sum", F.col("_c"))], totals=["_cum"])


def quantiles_of_counts(counts: DataFrame, group: Sequence[str], x: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles per group from :func:`value_counts`: one grouped aggregate with a partial one in each task."""
    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank > F.col("_cum") - F.col("_c")) & (rank <= F.col("_cum")), F.col(x).cast("double")))

    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("_cum_total") - 1).cast("double") * F.lit(float(p))
        aggs += [value_at(F.floor(pos) + 1).alias(f"_lo{i}"), value_at(F.ceil(pos) + 1).alias(f"_hi{i}"), F.max(pos - F.floor(pos)).alias(f"_f{i}")]
    out = counts.groupBy(*group).agg(*aggs)
    return out.select(*group, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(n) for i, n in enumerate(names)])


def quantiles(df: DataFrame, group: Sequence[str], x: str, probs: Sequence[float],
              names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group that has a value.

    Same definition as SQL ``percentile``/``quantile_cont``: position
    ``(n-1)*p`` in the sorted non-null values, interpolated between floor and
    ceiling. No group is ever sorted in one task."""
    group = list(group)
    if not group:
        raise ValueError("quantiles needs at least one group column")
    return quantiles_of_counts(value_counts(df, group, x), group, x, probs, list(names or [f"q{i}" for i in range(len(probs))]))
