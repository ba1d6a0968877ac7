"""Operator 12, ranked lexical search by geometric blocks of each posting list.

Documents become sparse vectors of integer impacts over the words that the queries use,
and are dealt into tasks by a range sort on a minimum hash of their words, so that similar ones meet
(ties are broken by id: a group of copies spreads over tasks). A task takes its documents some thousands at
a time. For those it builds, for every term, the posting list, and *blocks* of it: some of its documents
are centres, every other joins the centre that is nearest by a random projection of the vectors. A block
keeps a summary, the greatest impact of its documents in each coordinate that a query has together with the term.

A query goes through its terms from the rarest on. A document is met first in the list of its rarest query
term, where only this term and commoner ones can add to its score; so the product of the query with a
block's summary, over those coordinates, bounds the score of each document that was not met before. A
block is skipped only when its bound is below the score of the 20th document so far (a bound that equals it
is not skipped: a smaller id may win); the documents of the others are scored in full. The score that a task
starts with is the 20th of a bounded sample of documents, itself searched in blocks (``SAMPLE`` documents: they only
decide how early blocks can be skipped, never what is found), and a task carries its best documents from one index to the next.
Each task returns at most 20 documents a query, and a window ranks them.

Everything but the weight's logarithm is integer, so results are exact. Words are told by 64-bit hashes.

Queries are taken ``QUERY_BYTES`` of their texts at a time (one pass over the vectors for each), and by groups
of at most ``COLUMNS`` terms within a task (a longer query alone), so memory doesn't grow with their number.

Defined results: a null or empty text has no terms and matches nothing, and does not count in ``N``. Each row of documents and of
queries stands for itself, repeated rows too. A null document id comes last among equal scores. A query without
terms, or an empty table on either side, gives no rows. A text of any length is one document. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentrel.llm.shared import Words, mix, slices, spread, text_buffer, written

#: Bytes outside terms: ASCII but for digits and letters (a byte from 128 on belongs to a longer character).
SEPARATORS = np.zeros(256, bool)
SEPARATORS[:128] = [not chr(c).isalnum() for c in range(128)]

QUERY_BYTES = 8_000_000
COLUMNS = 6144
#: Documents of one index, and cells of its matrix.
INDEXED, CELLS = 4096, 1 << 24
#: Documents of a block, on average, and dimensions of the projection that tells near ones.
BLOCK, SKETCH = 32, 16
SAMPLE = 8192
LAST = np.iinfo(np.int64).max
VECTORS = "doc_id bigint, n bigint, terms binary, counts binary, near bigint"


def vectors(df: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """One row per document: its number of terms, the distinct terms of the (sorted) ``vocabulary``
    that it holds, by number, their counts, and the sort key."""
    def run(batches):
        for b in batches:
            for lo, hi, words in slices(b.column("text"), True, SEPARATORS):
                docs = hi - lo
                at = np.minimum(np.searchsorted(vocabulary, words.h), len(vocabulary) - 1)
                known = vocabulary[at] == words.h
                key, counts = np.unique(words.doc()[known].astype(np.uint64) << np.uint64(32) | at[known].astype(np.uint64), return_counts=True)
                cut = np.searchsorted(key, np.arange(docs + 1).astype(np.uint64) << np.uint64(32)).tolist()
                term, count = key.astype(np.uint32), counts.astype(np.uint32)
                near, n = np.zeros(docs, np.int64), np.diff(words.first)
                full = np.flatnonzero(n)
                if len(full):
                    near[full] = (np.minimum.reduceat(mix(words.h ^ np.uint64(0x5EA2C4)), words.first[full]) >> np.uint64(1)).astype(np.int64)
                packed = [pa.array([x[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()) for x in (term, count)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, docs), pa.array(n), *packed, pa.array(near)], names=["doc_id", "n", "terms", "counts", "near"])

    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, VECTORS)


def _holders(batches):
    """How many documents hold each term."""
    for b in batches:
        terms, n = np.unique(np.frombuffer(b"".join(x for x in b.column("terms").to_pylist() if x), np.uint32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int64)), pa.array(n.astype(np.int64))], names=["term", "df"])


class Query:
    """Columns (ascending, so rarest terms first) and weights of a query in its group."""

    def __init__(self, number: int, columns: np.ndarray, weights: np.ndarray):
        self.number, self.columns, self.weights = number, columns, weights


class Group:
    """Queries that are searched with one index, over the terms ``terms`` (rarest first)."""

    def __init__(self, queries: list[tuple[int, np.ndarray, np.ndarray]], order: np.ndarray):
        """``queries``: number, terms and weights of each; ``order``: each term's place by rarity."""
        used = np.unique(np.concatenate([t for _, t, _ in queries]))
        self.terms = used[np.argsort(order[used])]
        column = np.full(len(order), -1, np.int64)
        column[self.terms] = np.arange(len(self.terms))
        self.column, self.queries, partners = column, [], [[] for _ in self.terms]
        for number, terms, weights in queries:
            by = np.argsort(column[terms])
            q = Query(number, column[terms][by], weights[by])
            self.queries.append(q)
            for i, c in enumerate(q.columns):
                partners[c].append(q.columns[i:])
        #: Coordinates of each term's summaries: the term and the commoner ones that a query has with it.
        self.coordinates = [np.unique(np.concatenate(p)) for p in partners]
        for q in self.queries:
            q.places = [np.searchsorted(self.coordinates[c], q.columns[i:]) for i, c in enumerate(q.columns)]


class Index:
    """Posting lists of some documents in blocks, with their summaries."""

    def __init__(self, group: Group, rows: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, ids: np.ndarray, projection: np.ndarray):
        self.ids = ids
        column = group.column[term]
        here = column >= 0
        doc, column, impact = doc[here], column[here], impact[here]
        self.matrix = np.zeros((rows, len(group.terms)), np.int32)
        self.matrix[doc, column] = impact
        sketch = self.matrix.astype(np.float32) @ projection[:len(group.terms)]
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        order = np.lexsort((doc, column))
        lists, begin = doc[order], np.searchsorted(column[order], np.arange(len(group.terms) + 1))
        self.blocks = [self._blocked(lists[i:j], sketch, c) if j > i else None for c, i, j in zip(group.coordinates, begin, begin[1:])]

    def _blocked(self, docs: np.ndarray, sketch: np.ndarray, coordinates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The list's documents block by block, where each block begins (and the end), and the summaries."""
        begin = np.zeros(1, np.int64)
        if len(docs) > BLOCK:
            centres = docs[:: BLOCK]
            own = (sketch[docs] @ sketch[centres].T).argmax(axis=1)
            by = np.argsort(own, kind="stable")
            docs, own = docs[by], own[by]
            begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        values = self.matrix[docs[:, None], coordinates]
        return docs, np.append(begin, len(docs)), np.maximum.reduceat(values, begin, axis=0)

    def search(self, q: Query, best: Best) -> tuple[int, int]:
        """Adds the documents of this index to the best of a query; returns the blocks met and scored."""
        met = np.zeros(len(self.ids), bool)
        blocks = scored = 0
        for i, (c, places) in enumerate(zip(q.columns.tolist(), q.places)):
            if self.blocks[c] is None:
                continue
            docs, begin, summary = self.blocks[c]
            bound = summary[:, places].astype(np.int64) @ q.weights[i:]
            open_ = np.flatnonzero(bound >= max(best.least, 1))
            blocks += len(bound)
            scored += len(open_)
            if not len(open_):
                continue
            size = begin[open_ + 1] - begin[open_]
            inside = np.repeat(begin[open_] - np.cumsum(size) + size, size) + np.arange(size.sum())
            new = docs[inside]
            new = new[~met[new]]
            met[new] = True
            if len(new):
                best.add(self.matrix[new[:, None], q.columns].astype(np.int64) @ q.weights, self.ids[new])
        return blocks, scored


class Best:
    """The ``top`` best documents of a query: by score, then by id. ``least`` is the score below
    which a document cannot be among them; at the start a score that ``top`` documents are known to have."""

    def __init__(self, top: int, least: int):
        self.top, self.least = top, least
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= max(self.least, 1)
        if not good.any():
            return
        score, ids = np.append(self.score, score[good]), np.append(self.id, ids[good])
        by = np.lexsort((ids, -score))[:self.top]
        self.score, self.id = score[by], ids[by]
        if len(by) == self.top:
            self.least = max(self.least, int(self.score[-1]))


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 12 m)`` with ``m = 75 + (25 n docs) div terms``, in 64 bits."""
    wide = n if not len(n) or int(n.max()) < (1 << 62) // (25 * docs) else n.astype(object)
    m = (75 + 25 * wide * docs // terms).astype(np.int64)
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf // (1000 * tf + 12 * m)).astype(np.int32)


def _searcher(groups: list[Group], docs: int, terms: int, top: int, least: dict[int, int]):
    projection = np.random.default_rng(11).standard_normal((max(len(g.terms) for g in groups), SKETCH)).astype(np.float32)
    size = max(64, min(INDEXED, CELLS // max(len(g.terms) for g in groups)))

    def search(rows: list[pa.Table], best: dict[int, Best]):
        t = pa.concat_tables(rows)
        binary = [[np.frombuffer(x, np.uint32) for x in t.column(c).to_pylist()] for c in ("terms", "counts")]
        length = np.array([len(x) for x in binary[0]], np.int64)
        term, tf = (np.concatenate(x).astype(np.int64) for x in binary)
        doc = np.repeat(np.arange(len(t)), length)
        impact = impacts(tf, t.column("n").to_numpy()[doc], docs, terms)
        ids = t.column("doc_id").fill_null(int(LAST)).to_numpy()
        for g in groups:
            index = Index(g, len(t), doc, term, impact, ids, projection)
            for q in g.queries:
                index.search(q, best[q.number])

    def run(batches):
        best = {q.number: Best(top, least.get(q.number, 0)) for g in groups for q in g.queries}
        held, n = [], 0
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                part = b.slice(lo, size - n)
                held.append(pa.Table.from_batches([part]))
                lo, n = lo + part.num_rows, n + part.num_rows
                if n == size:
                    search(held, best)
                    held, n = [], 0
        if n:
            search(held, best)
        found = [(k, b) for k, b in best.items() if len(b.score)]
        if found:
            ids = np.concatenate([b.id for _, b in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([k for k, _ in found], [len(b.id) for _, b in found]).astype(np.int64)),
                 pa.array(ids, mask=ids == LAST), pa.array(np.concatenate([b.score for _, b in found]))], names=["query", "doc_id", "score"])

    return run


def _query_terms(texts: list[str | None]) -> list[np.ndarray]:
    """Term hashes of each text, repeats included."""
    data, offsets = text_buffer(pa.array(texts, pa.large_string()))
    words = Words(data, offsets, True, separators=SEPARATORS)
    return [words.h[i:j] for i, j in zip(words.first, words.first[1:])]


def _groups(queries: list[tuple[int, np.ndarray, np.ndarray]], order: np.ndarray) -> list[Group]:
    out, held, terms = [], [], set()
    for q in queries:
        more = terms | set(q[1].tolist())
        if held and len(more) > COLUMNS:
            out.append(Group(held, order))
            held, more = [], set(q[1].tolist())
        held.append(q)
        terms = more
    return [*out, Group(held, order)] if held else out


def search(df: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           top: int = 20, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """One row per query and found document: ``item_id, rank, doc_id, score``."""
    spark = df.sparkSession
    items = queries.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    items = written(items.withColumn("query", F.monotonically_increasing_id()), "queries")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / query_bytes))
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == part)
        rows = _search_part(spark, df, own.select("query", "text").collect(), id_col, text_col, top)
        found = rows if found is None else found.union(rows)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(items.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def _search_part(spark: SparkSession, df: DataFrame, queries: list, id_col: str, text_col: str, top: int) -> DataFrame:
    empty = spark.createDataFrame([], "query bigint, doc_id bigint, score bigint")
    asked = [(r.query, *np.unique(h, return_counts=True)) for r, h in zip(queries, _query_terms([r.text for r in queries])) if len(h)]
    if not asked:
        return empty
    vocabulary = np.unique(np.concatenate([t for _, t, _ in asked]))
    docs = written(vectors(df, id_col, text_col, vocabulary), "vectors")
    n, total = docs.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n:
        return empty
    held = docs.select("terms").mapInArrow(_holders, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect()
    holders = np.zeros(len(vocabulary), np.int64)
    for term, count in held:
        holders[term] = count
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in holders.tolist()], np.int64)
    # a term that no document holds, or of weight 0, adds to no score
    worth = (holders > 0) & (weight > 0)
    order = np.argsort(np.argsort(holders, kind="stable"), kind="stable")
    numbered = [(q, np.searchsorted(vocabulary, t), c) for q, t, c in asked]
    groups = _groups([(q, t[worth[t]], weight[t[worth[t]]] * c[worth[t]]) for q, t, c in numbered if worth[t].any()], order)
    if not groups:
        return empty
    rows = docs.where(F.length("terms") > 0)
    step = max(1, n // SAMPLE)
    sample = rows.where(F.pmod(F.xxhash64("near", "doc_id", "n"), F.lit(step)) == 0) if step > 1 else None
    least = {}
    if sample is not None:
        tops = sample.mapInArrow(_searcher(groups, n, total, top, {}), "query bigint, doc_id bigint, score bigint")
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
        least = dict(tops.withColumn("place", place).where(F.col("place") == top).select("query", "score").collect())
    dealt = rows.repartitionByRange(spread(spark, n, 4 * INDEXED), "near", "doc_id", F.monotonically_increasing_id())
    return written(dealt.mapInArrow(_searcher(groups, n, total, top, least), "query bigint, doc_id bigint, score bigint"), "found")
