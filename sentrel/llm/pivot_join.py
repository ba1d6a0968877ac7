"""Operator 9, near-duplicate embeddings by a pivot-permutation index.

Reference points (pivots) are up to ``n_pivots`` of the vectors, chosen from
the ``8 * n_pivots`` with the smallest hashes such that no two are near: a bounded sample, fitted only. Every vector is described by its
``prefix`` nearest pivots. Inverted lists are kept by groups of ``depth`` pivots:
a vector is on the list of each such group of its nearest pivots, so two vectors
meet when they share at least ``depth`` pivots. Pairs that meet are verified by
cosine in double precision. Their shared-pivot counts (a matrix product within
the list) name the one list that is responsible for a pair: that of their
``depth`` smallest shared pivots; so each pair counts once and no pairs are
written: a list yields link counts per vector and a spanning forest of its links.

Scale: copies are collapsed first (a class per distinct vector). Lists longer
than ``chunk`` are cut into chunks by hash and each pair of chunks is a task.
``depth`` is ``DEPTH`` at every size, so a link that a small table shows is not lost
in a larger one; longer lists cost more pairs of chunks. Vectors of each length are a table of their own. Recall
against brute force on the test tables is in the README (and tested).

Defined results: vectors that are null, zero, or hold null or non-finite components
link with nothing; vectors of different lengths do not link. Copies link with
one another. Repeated ids are different vectors. A null id is never a component
id unless all of its component are null. Only the two named columns are read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import components, written

#: Pivots that two vectors must share to meet.
DEPTH = 2
OUT = "cls bigint, other bigint, n bigint"


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pack(column) -> list[bytes]:
    return [np.asarray(v, np.float64).tobytes() for v in column.to_pylist()]


def describe(classes: DataFrame, pivots: np.ndarray, prefix: int, depth: int) -> DataFrame:
    """Adds ``vec`` (packed doubles), ``near`` (packed sorted pivot numbers) and
    ``lists`` (numbers of the inverted lists) to ``(cls, size, v)``."""
    dim, count, prefix = pivots.shape[1], len(pivots), min(prefix, len(pivots))
    combos = np.array(list(itertools.combinations(range(prefix), depth)))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            packed = _pack(b.column("v"))
            near = np.sort(np.argsort(-(_unit(pa.array(packed), dim) @ pivots.T), axis=1, kind="stable")[:, :prefix], axis=1)
            lists = np.zeros((len(near), len(combos)), np.int64)
            for j in range(depth):
                lists = lists * count + near[:, combos[:, j]]
            yield pa.RecordBatch.from_arrays(
                [b.column("cls"), b.column("size"), pa.array(packed, pa.binary()),
                 pa.array([x.tobytes() for x in near.astype(np.uint16)], pa.binary()), pa.array(list(lists), pa.list_(pa.int64()))],
                names=["cls", "size", "vec", "near", "lists"])

    return classes.select("cls", "size", "v").mapInArrow(run, "cls bigint, size bigint, vec binary, near binary, lists array<bigint>")


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    free, edges = np.ones(len(links), bool), []
    for root in range(len(links)):
        if not free[root]:
            continue
        free[root], todo = False, [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(links[at] & free)
            free[new] = False
            edges += [(at, int(x)) for x in new]
            todo += new.tolist()
    return edges


def _links_of(dim: int, count: int, depth: int, least: float):
    def run(key, t):
        group, i, j = (k.as_py() for k in key)
        if i != j and len(t.column("side").unique()) < 2:
            return pa.table({"cls": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        t = t.sort_by("cls")
        cls, size = t.column("cls").to_numpy(), t.column("size").to_numpy()
        side = t.column("side").to_numpy()
        x = _unit(t.column("vec").combine_chunks(), dim)
        near = np.frombuffer(b"".join(t.column("near").to_pylist()), np.uint16).reshape(len(cls), -1)
        own, rest = [], group
        for _ in range(depth):
            rest, d = divmod(rest, count)
            own.append(d)
        has = np.zeros((len(cls), max(own) + 1), np.float32)
        rows, cols = np.nonzero(near <= max(own))
        has[rows, near[rows, cols]] = 1
        shared = has @ has.T  # shared pivots up to the group's last: its own and no other
        links = (shared == depth) & (x @ x.T >= least)
        np.fill_diagonal(links, False)
        if i != j:
            links &= side[:, None] != side[None, :]
        n = links @ size
        hit = np.flatnonzero(n)
        edges = _forest(links)
        return pa.table({"cls": pa.array(np.concatenate([cls[hit], cls[[a for a, _ in edges]]]).astype(np.int64)),
                         "other": pa.array([None] * len(hit) + [int(cls[b]) for _, b in edges], pa.int64()),
                         "n": pa.array(np.concatenate([n[hit], np.zeros(len(edges), np.int64)]).astype(np.int64))})

    return run


def choose_pivots(sample: np.ndarray, count: int, apart: float = 0.8) -> np.ndarray:
    """The first ``count`` of the sample that are no neighbours of one another: of
    pivots from one dense group, its members would have any as their nearest."""
    chosen = sample[:0]
    for x in sample:
        if len(chosen) < count and not (chosen @ x >= apart).any():
            chosen = np.vstack([chosen, x])
    return chosen


def links_of_length(classes: DataFrame, dim: int, least: float, n_pivots: int, prefix: int, chunk: int) -> DataFrame:
    """``OUT`` of classes whose vectors have ``dim`` components."""
    sample = classes.select("v", F.xxhash64("v").alias("h"), "cls").orderBy("h", "cls").limit(8 * n_pivots).collect()
    pivots = choose_pivots(_unit(pa.array([np.asarray(r["v"], np.float64).tobytes() for r in sample]), dim), n_pivots)
    prefix = min(prefix, len(pivots))
    depth = min(DEPTH, prefix)
    points = written(describe(classes, pivots, prefix, depth), "points")
    sizes = points.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    sizes = written(sizes.select("list", F.ceil(F.col("rows") / chunk).cast("int").alias("parts")), "lists")
    on = (points.select("cls", "size", "vec", "near", F.explode("lists").alias("list")).join(sizes, "list")
          .withColumn("side", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
          .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
          .select("list", F.least("side", "with").alias("i"), F.greatest("side", "with").alias("j"), "cls", "size", "side", "vec", "near"))
    return on.groupBy("list", "i", "j").applyInArrow(_links_of(dim, len(pivots), depth, least), OUT)


def embedding_links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95,
                    n_pivots: int = 128, prefix: int = 8, list_rows: int = 2_000, chunk: int = 1_500) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``. ``list_rows`` has no effect (it raised the depth)."""
    spark = df.sparkSession
    v = F.col("v")
    good = F.coalesce(F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    rows = written(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
                             F.col(vec_col).cast("array<double>").alias("v")).withColumn("good", good), "vectors")
    classes = written(rows.where("good").groupBy("v").agg(F.min("row").alias("cls"), F.count(F.lit(1)).alias("size")), "classes")
    member = written(rows.where("good").join(classes, "v").select("row", "cls", "size"), "members")
    found = spark.createDataFrame([], OUT)
    for r in classes.groupBy(F.size("v").alias("dim")).count().where("count > 1").orderBy("dim").collect():  # a row per length
        found = found.union(links_of_length(classes.where(F.size("v") == r["dim"]), r["dim"], least, n_pivots, prefix, chunk))
    found = written(found, "links")
    counts = found.where("other is null").groupBy("cls").agg(F.sum("n").alias("n"))
    comp = components(found.where("other is not null").select("cls", "other").distinct(), "cls", "other")
    named = member.join(counts, "cls", "left").join(comp.withColumnRenamed("id", "cls"), "cls", "left")
    named = named.select("row", F.coalesce("component", "cls").alias("comp"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    full = written(rows.select("row", "vec_id").join(named, "row", "left"), "named")
    least_id = full.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    out = full.join(least_id, "comp", "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
