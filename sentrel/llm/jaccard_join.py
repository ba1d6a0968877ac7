"""Operator 8, Jaccard join of 5-word shingle sets by a count-vector R-tree.

A document's shingles are hashed into ``GROUPS`` groups; its group counts are a
point. Two sets overlap by at most the sum of the coordinate minima of their
points, and a link needs 4/9 of the sum of their sizes (Jaccard 0.8), so points
whose bound is lower are no candidates; neither are nodes of an R-tree whose
upper corner (coordinate maxima) bounds lower. What survives is verified on the sets.

Routing, so that no tree holds the whole table: with all shingles in one global order,
two linked sets share one of the first ``n - ceil(0.8 n) + 1`` shingles of
each. The order is rare first (by a count sketch of fixed size over all
documents, then by hash), so common lines and passages come last and route
nothing. Documents meet in the blocks of these shingles; every pair that can link meets.

Copies are collapsed first (a class per distinct set). Then links are found in
three steps, each exact for what it leaves out: (1) each class is verified with
one earlier class of its blocks, the one it shares most blocks with; (2) with the first classes of its
other blocks, if they are in other components by then; (3) blocks that still hold several
components get an R-tree (one for all blocks with the same first class) that returns pairs of different components within the bound.
Pairs inside one component need no verification, as the result is the component.
Blocks of more than ``CHUNK`` documents are cut into chunks by hash, a task per pair of chunks.

Sets are 64-bit shingle hashes. Defined results: a null text is empty; a text
without words has ``n_shingles`` 0 and its own id as component; with fewer than
five words its words are its one shingle. Identical texts link. A null id comes
after all others. Rows that repeat an id are different documents. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import Words, by_bucket, chain, components, joined, slices, small, spread, text_of, without, written

SHINGLE = 5
GROUPS = 512
CELL_BITS = 24
CELLS = 1 << CELL_BITS
SLICES = 256
SLICE = 1_000_000
LEAF = 32
CHUNK = 1_500
FLUSH = 1_000_000


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a slice's documents, by document and hash: hashes, and where each document begins."""
    docs = len(words.first) - 1
    n = np.diff(words.first)
    doc = words.doc()
    h = chain(words.h, SHINGLE)
    inside = doc[:len(h)] == doc[SHINGLE - 1:] if len(h) else np.zeros(0, bool)
    h, owner = h[inside], doc[:len(h)][inside]
    short = [(int(d), chain(words.h[words.first[d]:words.first[d + 1]], int(n[d]), 77)[0]) for d in np.flatnonzero((n > 0) & (n < SHINGLE))]
    if short:
        h = np.concatenate([h, np.array([x for _, x in short], np.uint64)])
        owner = np.concatenate([owner, np.array([d for d, _ in short], np.int64)])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])) if len(h) else np.zeros(0, bool)
    h, owner = h[first], owner[first]
    return h, np.searchsorted(owner, np.arange(docs + 1))


def prefix_size(n):
    """Shingles of a set of ``n`` of which a linked set shares one: ``n - ceil(0.8 n) + 1``."""
    return n - -(-4 * n // 5) + 1


def linked(overlap, a, b):
    return 100 * overlap >= 80 * (a + b - overlap)


def needed(a, b):
    """Least overlap of linked sets: ``9 * overlap >= 4 * (a + b)``."""
    return -(-4 * (a + b) // 9)


# --- count sketch, classes --------------------------------------------------------------

def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _sketch(batches):
    cells = np.zeros(CELLS, np.uint16)
    for b in batches:
        for _, _, words in slices(b.column("text"), lower=True, size=SLICE):
            cell, n = np.unique(_cell(shingle_sets(words)[0]), return_counts=True)
            cells[cell] = np.minimum(cells[cell] + n, 65535)
    parts = np.minimum(cells, 255).astype(np.uint8).reshape(SLICES, -1)  # a task's count of a cell; beyond that it is common anyway
    full = np.flatnonzero(parts.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([parts[p].tobytes() for p in full], pa.binary())], names=["slice", "cells"])


def _add_sketch(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, number = np.zeros(CELLS // SLICES, np.int64), key[0].as_py()
    for b in batches:
        for x in b.column("cells"):
            total += np.frombuffer(x.as_buffer(), np.uint8)
    level = np.floor(np.log2(np.maximum(total, 1))).astype(np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["slice", "levels"])


def rarity(docs: DataFrame) -> np.ndarray:
    """Level (binary logarithm) of the number of documents per cell of the shingle hash; 16 MB at any size of the table."""
    rows = docs.select("text").mapInArrow(_sketch, "slice int, cells binary").groupBy("slice").applyInArrow(_add_sketch, "slice int, levels binary").collect()
    levels = np.zeros((SLICES, CELLS // SLICES), np.uint8)
    for r in rows:
        levels[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.ravel()


def pack_point(p: np.ndarray) -> bytes:
    """A point's group counts, compressed: points travel several times, most counts are small."""
    kind = np.uint8 if p.max(initial=0) < 256 else np.uint32
    return bytes([np.dtype(kind).itemsize]) + pa.compress(p.astype(kind).tobytes(), codec="zstd", asbytes=True)


def unpack_points(packed: list[bytes]) -> np.ndarray:
    """A row of ``GROUPS`` counts for each packed point."""
    out = np.empty((len(packed), GROUPS), np.uint32)
    for i, x in enumerate(packed):
        out[i] = np.frombuffer(pa.decompress(x[1:], GROUPS * x[0], codec="zstd", asbytes=True), np.uint8 if x[0] == 1 else np.uint32)
    return out


POINTS = "doc_id bigint, raw bigint, n bigint, sig binary, point binary, keys binary"


def _points(shared):
    def run(batches):
        levels = shared.value
        for b in batches:
            for lo, hi, words in slices(b.column("text"), lower=True, size=SLICE):
                h, at = shingle_sets(words)
                owner = np.repeat(np.arange(hi - lo), np.diff(at))
                group = (h >> np.uint64(20) & np.uint64(GROUPS - 1)).astype(np.int64)
                points = np.bincount(owner * GROUPS + group, minlength=(hi - lo) * GROUPS).reshape(-1, GROUPS).astype(np.uint32)
                key = levels[_cell(h)].astype(np.uint64) << np.uint64(58) | h >> np.uint64(6)
                key = key[np.lexsort((key, owner))]
                n = np.diff(at)
                first = prefix_size(n)
                sig = [hashlib.blake2b(h[at[i]:at[i + 1]].tobytes(), digest_size=16).digest() for i in range(hi - lo)]
                keys = [key[at[i]:at[i] + (first[i] if n[i] else 0)].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("raw").slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                                                  pa.array(sig, pa.binary()), pa.array([pack_point(p) for p in points], pa.binary()), pa.array(keys, pa.binary())],
                                                 names=["doc_id", "raw", "n", "sig", "point", "keys"])
    return run


# --- blocks --------------------------------------------------------------------------------

def _postings(buckets: int):
    def run(batches):
        held, n = [], 0

        def flush():
            k, c, s = (np.concatenate(x) for x in zip(*held, strict=True))
            order, at = by_bucket(_spreading(k), buckets)
            full = np.flatnonzero(np.diff(at))
            pack = lambda x: pa.array([x[order[at[p]:at[p + 1]]].tobytes() for p in full], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pack(k), pack(c), pack(s)], names=["bucket", "keys", "cls", "sizes"])

        for b in batches:
            for cls, size, kb in zip(*(b.column(c).to_pylist() for c in ("cls", "n", "keys")), strict=True):
                k = np.frombuffer(kb, np.uint64)
                held.append((k, np.full(len(k), cls, np.int64), np.full(len(k), size, np.int32)))
                n += len(k)
                if n >= FLUSH:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()
    return run


def _spreading(k: np.ndarray) -> np.ndarray:
    return (k & np.uint64((1 << 58) - 1)) << np.uint64(6)


def _live(key, t):
    """Postings of the blocks (one per routing shingle) that hold more than one class, each with the first class of its block."""
    k, c, s = joined(t.column("keys"), np.uint64), joined(t.column("cls"), np.int64), joined(t.column("sizes"), np.int32)
    order = np.lexsort((c, k))
    k, c, s = k[order], c[order], s[order]
    first = np.append(True, k[1:] != k[:-1])
    group = np.cumsum(first) - 1
    live = (np.bincount(group) > 1)[group]
    lead = np.flatnonzero(first)[group]
    return pa.table({"cls": pa.array(c[live]), "n": pa.array(s[live].astype(np.int64)),
                     "lead": pa.array(c[lead][live]), "lead_n": pa.array(s[lead][live].astype(np.int64))})


# --- R-tree --------------------------------------------------------------------------------

class RTree:
    """Points (group counts) in leaves of ``LEAF``, sorted by size and then by their largest groups; the nodes'
    upper corners are coordinate maxima, level by level."""

    def __init__(self, points: np.ndarray):
        self.size = points.sum(1).astype(np.int64)
        slab = max(1, LEAF * int(np.sqrt(max(len(points) // LEAF, 1))))
        by_size = np.argsort(self.size, kind="stable")
        self.order = np.concatenate([s[np.lexsort((points[s].argmax(1),))] for s in (by_size[i:i + slab] for i in range(0, len(by_size), slab))])
        self.points = points[self.order]
        self.levels = []  # from the leaves up: (corners, least sizes, largest sizes)
        at = np.arange(0, len(points), LEAF)
        top, lo, hi = np.maximum.reduceat(self.points, at), np.minimum.reduceat(self.size[self.order], at), np.maximum.reduceat(self.size[self.order], at)
        self.levels.append((top, lo, hi))
        while len(top) > LEAF:
            at = np.arange(0, len(top), LEAF)
            top, lo, hi = np.maximum.reduceat(top, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            self.levels.append((top, lo, hi))

    def search(self, q: np.ndarray) -> np.ndarray:
        """Points whose overlap with ``q`` may suffice."""
        n = int(q.sum())
        nodes = np.arange(len(self.levels[-1][0]))
        for top, lo, hi in reversed(self.levels):
            nodes = nodes[nodes < len(top)]
            fits = (5 * hi[nodes] >= 4 * n) & (4 * lo[nodes] <= 5 * n)
            nodes = nodes[fits]
            nodes = nodes[np.minimum(top[nodes], q).sum(1) >= needed(n, lo[nodes])]
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
        nodes = nodes[nodes < len(self.points)]
        return self.order[nodes[np.minimum(self.points[nodes], q).sum(1) >= needed(n, self.size[self.order[nodes]])]]


def _candidates(cls: np.ndarray, comp: np.ndarray, side: np.ndarray, points: np.ndarray, across: bool) -> tuple[list, list]:
    """Pairs of different components (and of different sides, if ``across``) within the bound."""
    a, b = [], []
    if len(cls) <= LEAF:  # one leaf: all at once
        n = points.sum(1)
        ok = np.minimum(points[:, None], points[None]).sum(2) >= needed(n[:, None], n[None])
        ok &= (comp[:, None] != comp[None]) & ((side[:, None] != side[None]) | (not across))
        x, y = np.nonzero(np.triu(ok, 1))
        return cls[x].tolist(), cls[y].tolist()
    tree = RTree(points)
    for x in range(len(cls)):
        found = tree.search(points[x])
        found = found[(found > x) & (comp[found] != comp[x]) & ((side[found] != side[x]) | (not across))]
        a += [int(cls[x])] * len(found)
        b += cls[found].tolist()
    return a, b


def _search_blocks(key, t):
    """Candidate pairs of some blocks, or of two chunks of a block."""
    t = t.sort_by([("lead", "ascending"), ("cls", "ascending")])
    lead, cls, comp, side = (t.column(c).to_numpy() for c in ("lead", "cls", "comp", "side"))
    points = unpack_points(t.column("point").to_pylist()).astype(np.int64)
    across = key[1].as_py() != key[2].as_py()
    a, b = [], []
    at = np.append(np.unique(lead, return_index=True)[1], len(lead))
    for i, j in zip(at, at[1:]):
        if j - i > 1:
            x, y = _candidates(cls[i:j], comp[i:j], side[i:j], points[i:j], across)
            a += x
            b += y
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


# --- verification ----------------------------------------------------------------------------

def _sets(batches):
    for b in batches:
        for lo, hi, words in slices(b.column("text"), lower=True, size=SLICE):
            h, at = shingle_sets(words)
            yield pa.RecordBatch.from_arrays([b.column("cls").slice(lo, hi - lo), pa.array([h[at[i]:at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())], names=["cls", "hashes"])


def _verify(batches):
    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        ok = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            ok.append(bool(linked(int((y[at] == x).sum()), len(x), len(y))))
        ok = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], names=["a", "b"])


def _within_bound(batches):
    for batch in batches:
        p, q = (unpack_points(batch.column(c).to_pylist()) for c in ("point_a", "point_b"))
        ok = np.minimum(p, q).sum(1, dtype=np.int64) >= needed(p.sum(1, dtype=np.int64), q.sum(1, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])


PAIR = "a bigint, b bigint"


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_broadcast: int = 500_000) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_shingles, component_id, kept, raw``
    (``kept``: one row of each component; ``raw``: xxhash64 of the text)."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(F.col(text_col).cast("string")).alias("text")).withColumn("raw", F.xxhash64("text"))
    levels = spark.sparkContext.broadcast(rarity(docs))
    every = written(docs.mapInArrow(_points(levels), POINTS).withColumn("row", F.monotonically_increasing_id()), "points")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    classes = written(every.where("n > 0").groupBy("sig").agg(rep.alias("rep")).select("sig", F.col("rep.row").alias("cls")), "classes")
    own = every.join(small(classes.select(F.col("cls").alias("row")), max_broadcast), "row", "left_semi").withColumnRenamed("row", "cls")
    own = own.select("cls", "doc_id", "raw", "n", "point", "keys")
    total = own.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    buckets = spread(spark, total // 8, 500_000)
    live = written(own.select("cls", "n", "keys").mapInArrow(_postings(buckets), "bucket int, keys binary, cls binary, sizes binary")
                   .groupBy("bucket").applyInArrow(_live, "cls bigint, n bigint, lead bigint, lead_n bigint"), "live")

    met = live.select("cls").distinct()
    found = own.select("cls", "doc_id", "raw", "n", "point").join(small(written(met, "met"), max_broadcast), "cls", "left_semi")
    found = written(found, "met_points")
    points = found.select("cls", "n", "point")
    places = found.select("cls", F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"))

    def bounded(pairs: DataFrame) -> DataFrame:
        both = pairs.join(points.select(F.col("cls").alias("a"), F.col("point").alias("point_a")), "a")
        both = both.join(points.select(F.col("cls").alias("b"), F.col("point").alias("point_b")), "b")
        return both.mapInArrow(_within_bound, PAIR)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(pairs, "candidates")
        ids = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
        where = small(written(places.join(ids, "cls"), "places"), max_broadcast)
        text = docs.join(where, docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["raw"] == F.col("_raw"))).select("cls", "text")
        sets = written(text.mapInArrow(_sets, "cls bigint, hashes binary"), "sets")  # of the candidates only
        if not sets.groupBy("cls").count().where("count > 1").isEmpty():  # rows that repeat id and text
            sets = written(sets.dropDuplicates(["cls"]), "sets")
        both = pairs.join(sets.select(F.col("cls").alias("b"), F.col("hashes").alias("set_b")), "b")
        both = both.join(sets.select(F.col("cls").alias("a"), F.col("hashes").alias("set_a")), "a")
        return written(both.mapInArrow(_verify, PAIR), name)

    def component_of(edges: DataFrame) -> DataFrame:
        return written(components(edges), "components").select(F.col("id").alias("cls"), F.col("component").alias("comp"))

    def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
        pairs = pairs.join(comp.select(F.col("cls").alias("a"), F.col("comp").alias("comp_a")), "a", "left")
        pairs = pairs.join(comp.select(F.col("cls").alias("b"), F.col("comp").alias("comp_b")), "b", "left")
        return pairs.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")

    fits = (5 * F.col("n") >= 4 * F.col("lead_n")) & (4 * F.col("n") <= 5 * F.col("lead_n")) & (F.col("cls") != F.col("lead"))
    stars = written(live.where(fits).groupBy(F.col("lead").alias("a"), F.col("cls").alias("b")).agg(F.count(F.lit(1)).alias("blocks")), "stars")
    best = stars.groupBy("b").agg(F.max(F.struct("blocks", (-F.col("a")).alias("a"))).alias("best")).select((-F.col("best.a")).alias("a"), "b")
    edges = verified(bounded(best), "first_links")
    comp = component_of(edges)
    edges = written(edges.union(verified(bounded(apart(stars.select("a", "b"), comp)), "more_links")), "links")
    comp = component_of(edges)

    # blocks with the same first class are searched as one: they hold much the same classes
    members = live.select("lead", "cls").distinct().join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    named = written(members, "named")
    several = named.groupBy("lead").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo < hi")
    several = written(several.select("lead", F.ceil(F.col("rows") / CHUNK).cast("int").alias("parts"), "rows"), "several")
    bundles = spread(spark, several.agg(F.sum("rows")).first()[0] or 0, 5_000)
    on = (named.join(several, "lead").withColumn("side", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
          .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
          .join(points.select("cls", "point"), "cls")
          .select(F.when(F.col("parts") > 1, F.col("lead")).otherwise(-1 - F.pmod(F.xxhash64("lead"), F.lit(bundles))).alias("bundle"),
                  F.least("side", "with").alias("i"), F.greatest("side", "with").alias("j"), "lead", "cls", "comp", "side", "point"))
    rest = on.groupBy("bundle", "i", "j").applyInArrow(_search_blocks, PAIR).distinct()
    edges = edges.union(verified(rest, "last_links"))
    comp = component_of(edges)

    full = every.select("row", "doc_id", "raw", "n", "sig").join(classes, "sig", "left")
    full = full.join(comp, "cls", "left").select("row", "doc_id", "raw", "n", F.coalesce("comp", "cls").alias("comp"))
    full = written(full.withColumn("comp", F.when(F.col("n") > 0, F.col("comp"))), "named")
    first = full.where("comp is not null").groupBy("comp").agg(rep.alias("rep"))
    out = full.join(first, "comp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("component_id"),
                      F.coalesce(F.col("rep.row") == F.col("row"), F.lit(True)).alias("kept"), "raw")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each component, all columns kept."""
    marks = near_duplicates(df, id_col, text_col).select("doc_id", F.col("raw").alias("mark"), "kept")
    return without(df, marks, id_col, F.xxhash64(text_of(F.col(text_col).cast("string"))))
