"""Operator 10, mixing sources to target weights by hash-threshold histograms.

Targets: sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ...
and share ``budget`` (1.5) times the sum of all sizes. A target stops at
``ceiling`` (2) times its source's size; what is above is shared again among
the others by weight until no target is above.

Choice: each document has a fixed 60-bit hash of its id. A source whose target
reaches its size takes every document once; the rest of the target goes to the
documents whose hash lies below the source's threshold. The threshold is found
by histograms: sizes are summed by source and the first 12 bits of the hash, the
bucket in which the running sum reaches the rest is the boundary, and only
that bucket is summed again by the next 12 bits, until it holds one hash. The
documents are then filtered by their hash; they are never sorted. The document
at the threshold is taken in part, so a source ends within one word of its target.

Defined results: size is the number of words (null text: 0). Rows with the same
id share one hash; at the threshold each takes its share by size (rounded
down). Documents of size 0 take 0. Targets of an empty table: no rows; with no
words at all every target is 0. Null ids hash as the text "null".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sentrel.llm.shared import WORD, small, text_of, written

WEIGHTS = (5, 2, 1)
BITS, STEP = 60, 12


def size_of(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint")


def hash_of(id_col: str) -> Column:
    digest = F.md5(F.concat(F.lit("mix "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, ceiling: int = 2) -> DataFrame:
    """``(key, source_size, weight, target)`` per source. Ranks come from a range
    sort whose partitions are numbered by their counts; the resharing is a few
    aggregates over the sources, so any number of sources will do."""
    ordered = (sizes.groupBy("key", "nul", "source").agg(F.sum("size").alias("source_size"))
               .repartitionByRange("nul", "source").sortWithinPartitions("nul", "source")
               .withColumn("at", F.monotonically_increasing_id()))
    ordered = written(ordered, "sources").withColumn("part", F.shiftright("at", 33))
    before = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))  # a row per partition
    rank = F.coalesce("before", F.lit(0)) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    src = written(ordered.join(before, "part").select("key", "source_size", weight.cast("bigint").alias("weight")), "weights")

    total = src.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.col("source_size") * ceiling, 0.0
    while True:
        above = cap < F.lit(level) * F.col("weight")
        r = src.agg(F.sum(F.when(above, cap).otherwise(0)).alias("full"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("w")).first()
        if not r["w"]:
            break
        new = (budget * total - r["full"]) / r["w"]
        if new <= level:
            break
        level = new
    target = F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight"))
    return written(src.select("key", "source_size", "weight", target.alias("target")), "targets")


def thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(key, at, got, bucket)`` per source of ``wanted`` (``key, rest``) with
    a rest: the hash at which the running sum of sizes in hash order reaches the
    rest, the sum below it, and the size at it."""
    state = wanted.where("rest > 0").select("key", "rest", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("got"))
    for left in range(BITS - STEP, -1, -STEP):
        inside = (sizes.join(state, "key").where(F.shiftright("h", left + STEP) == F.col("prefix"))
                  .groupBy("key", "rest", "got", F.shiftright("h", left).alias("prefix"))
                  .agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).where("n > 0"))
        upto = F.sum("n").over(W.partitionBy("key").orderBy("prefix"))  # 4,096 buckets a source at most
        state = written(inside.withColumn("upto", F.col("got") + upto)
                        .where("upto >= rest and upto - n < rest")
                        .select("key", "rest", "prefix", (F.col("upto") - F.col("n")).alias("got"), "n", "lo", "hi"), "boundary")
        if state.where("lo < hi").isEmpty():
            break
    return state.select("key", F.col("lo").alias("at"), "got", F.col("n").alias("bucket"))


def _keys(df: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    source = F.col(source_col).cast("string")
    return [size_of(text_col).alias("size"), hash_of(id_col).alias("h"),
            F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source)).alias("key")]


def mix_plan(sizes: DataFrame, weights: tuple[int, ...], budget: float, ceiling: int) -> DataFrame:
    """One row per source: its target, whether all its documents are taken once
    (``whole``), and the threshold for the rest."""
    targets = source_targets(sizes, weights, budget, ceiling)
    whole = F.col("target") >= F.col("source_size")
    plan = written(targets.withColumn("whole", whole.cast("bigint"))
                   .withColumn("rest", F.floor("target") - F.when(whole, F.col("source_size")).otherwise(0)), "rests")
    return written(plan.join(thresholds(sizes, plan), "key", "left")
                   .withColumn("share", F.col("rest") - F.col("got"))
                   .select("key", "source_size", "target", "whole", "at", "bucket", "share"), "plan")


def _taken() -> Column:
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    part = (F.when(F.col("at").isNull() | (F.col("h") > F.col("at")), F.lit(0).cast("bigint"))
            .when(F.col("h") < F.col("at"), F.col("size"))
            .when(F.col("size") == F.col("bucket"), F.col("share"))
            .otherwise(F.floor(wide("size") * wide("share") / wide("bucket")).cast("bigint")))
    return (F.col("whole") * F.col("size") + part).cast("bigint")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, ceiling: int = 2) -> DataFrame:
    """One row per row of ``df``: ``doc_id, size, source_size, target, taken, source``."""
    source = F.col(source_col).cast("string")
    sizes = written(df.select(F.col(id_col).alias("doc_id"), source.isNull().alias("nul"), source.alias("source"),
                              *_keys(df, id_col, text_col, source_col)), "sizes")
    plan = mix_plan(sizes, weights, budget, ceiling)
    return sizes.join(plan, "key").select("doc_id", "size", "source_size", "target", _taken().alias("taken"), "source")


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, ceiling: int = 2) -> DataFrame:
    """``df`` as the mix has it, all columns kept: a document appears as often
    as the mix takes its words (0, 1 or 2 times; one at a source's threshold,
    taken in part, by rounding). The rows meet one plan row per source only."""
    source = F.col(source_col).cast("string")
    keys = _keys(df, id_col, text_col, source_col)
    sizes = written(df.select(source.isNull().alias("nul"), source.alias("source"), *keys), "sizes")
    plan = small(mix_plan(sizes, weights, budget, ceiling), 100_000)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"), *keys)
    times = F.when(F.col("size") > 0, F.floor(_taken() / F.col("size") + 0.5)).otherwise(0).cast("int")
    taken = rows.join(plan, "key").select("doc", times.alias("times")).where("times > 0")
    return taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")).select("doc.*")
