"""Helpers of the corpus operators: tables in the shared folder, checked
broadcasts, words of Arrow text columns as 64-bit numbers, exchange of packed
key arrays, connected components.

Words
-----
A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``. Inside
tasks a word is its 64-bit hash: a polynomial over a random byte table, mixed.
All arithmetic is numpy over the bytes of the Arrow buffer, a slice of
documents at a time, so memory is bounded by the slice (or by one document).
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.session import scratch_path, work_dir

#: The separator class of every operator here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task turns into arrays at once.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts
    the lineage, survives lost executors, and Spark knows its size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_bytes(spark: SparkSession, most: int = 4_000_000) -> Iterator[None]:
    """What is run inside sends rows to Python workers in Arrow batches of some ``most`` bytes (10,000 long rows
    at once are held by the executor and by the worker, with the batch before them)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most
    ``max_rows`` rows; beyond that unchanged, and Spark shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def without(df: DataFrame, marks: DataFrame, id_col: str, mark: Column, max_broadcast: int = 200_000) -> DataFrame:
    """``df`` without the rows that ``marks`` (``doc_id, mark, kept``, a row for each row of ``df``) drops. Rows
    are found by id and ``mark`` (the same function of the row); of identical ones the first stays."""
    keys = marks.groupBy("doc_id", "mark").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = written(keys.where("not kept or n > 1"), "marks")
    gone = keys.where("not kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"), F.col(id_col).alias("id"), mark.alias("mark"))
    left = rows.join(small(gone, max_broadcast), F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left_anti")
    if not keys.where("kept").isEmpty():  # identical rows: the same id and mark more than once
        left = left.dropDuplicates(["id", "mark"])
    return left.select("doc.*")


def spread(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` rows of ``per_task`` each, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_task))


def text_of(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


# --- broadcasts by value ------------------------------------------------------------------

def plain(x):
    """``x`` without references to this library: an object of one of its classes becomes its class (by value) and attributes."""
    if not type(x).__module__.startswith(__name__.split(".")[0] + "."):
        return x
    return _PLAIN, cloudpickle.dumps(type(x)), {k: plain(v) for k, v in vars(x).items()}


def rebuilt(x):
    """The object that :func:`plain` took apart; its arrays are not copied."""
    if not (isinstance(x, tuple) and len(x) == 3 and x[0] == _PLAIN):
        return x
    kind = pickle.loads(x[1])
    out = kind.__new__(kind)
    out.__dict__.update({k: rebuilt(v) for k, v in x[2].items()})
    return out


_PLAIN = "object by value"


class Sent:
    """A broadcast object of this library; executors need no copy of the library to read ``value``."""

    def __init__(self, spark: SparkSession, value):
        self.broadcast, self._value = spark.sparkContext.broadcast(plain(value)), value

    def __getstate__(self):
        return {"broadcast": self.broadcast}

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = rebuilt(self.broadcast.value)
        return self._value


# --- words of a text column ---------------------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def looked_up(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``table[data]`` for bytes and a table of 256 one-byte values, without an index of 8 bytes for each."""
    return np.frombuffer(bytearray(data).translate(table.tobytes()), table.dtype)


class Powers:
    """Powers of the base and of its inverse, modulo 2**64."""

    def __init__(self):
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.size <= n:
            self.size = n + 1
            self.up, self.down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
            for p in (self.up, self.down):
                p[0] = 1
                np.multiply.accumulate(p, out=p)
        return self.up, self.down


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (length ``len(h) - k + 1``)."""
    n = len(h) - k + 1
    out = np.full(max(n, 0), 0x2545F4914F6CDD1D ^ (seed * 0x9E3779B97F4A7C15 & _MASK), np.uint64)
    for j in range(k if n > 0 else 0):
        out = mix(out + h[j:j + n]) * np.uint64(0xD6E8FEB86659FD93)
    return out


def _hash(sums: np.ndarray, down: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


class Words:
    """Words of the documents ``lo`` to ``hi`` of a batch: ``h`` their hashes,
    ``first`` the index of each document's first word (one more at the end),
    ``begin`` and ``end`` their byte ranges in ``data``. With ``parts``, parts of words can be hashed too (:meth:`hash`)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, powers: Powers | None = None, separators: np.ndarray = _IS_SPACE, parts: bool = False):
        self.data, self.offsets = (looked_up(_LOWER, data) if lower else data), offsets
        n = len(data)
        if n == 0:
            self.h, self.begin, self.end = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        solid = ~looked_up(separators, data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begin = solid.copy()
        begin[1:] &= ~solid[:-1] | edge[1:n]
        end = solid.copy()
        end[:-1] &= ~solid[1:] | edge[1:n]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        up, down = (powers or Powers()).upto(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[self.data] * up[:n], out=sums[1:])
        self.h = _hash(sums, down, self.begin, self.end)
        self.first = np.searchsorted(self.begin, offsets).astype(np.int64)
        if parts:
            self.sums, self.down = sums, down

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges."""
        return _hash(self.sums, self.down, begin, end)

    def doc(self) -> np.ndarray:
        """For each word its document's index."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) and column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, lower: bool, separators: np.ndarray = _IS_SPACE, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """The column's documents, some ``size`` bytes at a time (a longer document alone). ``separators`` marks
    the bytes that are outside words."""
    data, offsets = text_buffer(column)
    lo, n, powers = 0, len(offsets) - 1, Powers()
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lower, powers, separators)
        lo = hi


# --- packed keys ------------------------------------------------------------------------

def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``keys`` (uint64 hashes) by bucket, and where each bucket begins
    in it (``buckets + 1`` entries). The bucket is the high part of the hash."""
    b = bucket_of(keys, buckets)
    order = np.argsort(b, kind="stable")
    return order, np.searchsorted(b[order], np.arange(buckets + 1))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def joined(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """All values of a binary column of packed arrays, one after another."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype)


# --- connected components -----------------------------------------------------------------

#: Edges a partition in :func:`components`, where there are few.
FEW_EDGES = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph of long ids by alternating large-star
    and small-star steps: returns ``(id, component)`` with the smallest id of
    each component, for every id that has an edge. Each round is a join on the
    node with a pre-aggregated minimum; rounds are written, so a lost executor
    repeats one round only. Raises if it has not settled after ``max_rounds``.
    """
    e = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    # a short list of edges stays in a few partitions, each round with three exchanges; a long one is left to AQE, which splits hot nodes
    few = math.ceil((e.count() + 1) / FEW_EDGES)
    on = (lambda t: t.repartition(few, "u")) if few <= 8 else (lambda t: t)
    hint = (lambda t: t.hint("merge")) if few <= 8 else (lambda t: t)
    for _ in range(max_rounds):
        both = on(e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(hint(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = on(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        e = written(on(down.join(hint(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(low.select("u", F.col("m").alias("v"))).where("u <> v")).distinct(), "edges")
        seen = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            stars = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return stars.union(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
        before = tuple(seen)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
