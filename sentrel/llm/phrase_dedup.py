"""Operator 5, substring deduplication by repeated-phrase automata.

A window is ``WINDOW`` (20) consecutive words of one document; a word goes if a
window that covers it also starts earlier (smaller id, or same document and
earlier start). Windows are judged on the input.

1. Copies. Documents with the same words in the same order are found by the
   SHA-256 of their words; only the first goes on (all windows of the others
   start earlier there).
2. Recurring phrases. In each window the 8-word phrase with the smallest hash is its
   anchor; equal windows have equal anchors. Anchor hashes, combined by task, meet in
   buckets; those that occur more than once are sent to the document blocks that hold them.
3. Automata. A block is a few MB of documents. It looks its recurring anchors up
   in its own texts, compiles their phrases into Aho-Corasick automata (at most
   ``PATTERNS`` phrases each) and streams its documents through them: every
   occurrence is located by its text. So each shard of the automata is
   bounded by its block, and each document is streamed through its own block's shards only.
4. Windows around the occurrences are hashed (96 bits) and meet in buckets, where all
   but the first start of each go back to their documents.

No step gathers the occurrences of one phrase with their texts; a phrase of all
documents sends one number per block to one bucket, and a number per occurrence
of each of its windows to the windows' buckets (spread by hash).

Defined results: a null text has no words. Documents under 20 words lose nothing.
A document is told by its id and the SHA-256 of its words: identical rows (same id, same words) count as
one document and get the same result, rows of one id with other words are documents of their own, in the order
of these hashes; a null id comes last, and null ids too are told apart by their words. An empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import Words, by_bucket, chain, joined, mix, slices, small, spread, text_buffer, text_of, written

WINDOW = 20
PHRASE = 8
PATTERNS = 12_000
FLUSH = 2_000_000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
EMPTY = hashlib.sha256(b"").hexdigest()


def _words_of(data: np.ndarray, offsets: np.ndarray, i: int) -> list[bytes]:
    return data[offsets[i]:offsets[i + 1]].tobytes().split()


def _identities(batches):
    for b in batches:
        data, offsets = text_buffer(b.column("text"))
        words = [_words_of(data, offsets, i) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("raw"), pa.array([len(w) for w in words], pa.int64()),
                                          pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])], names=["doc_id", "raw", "n_words", "sha"])


def _sliding(x: np.ndarray, k: int, op) -> np.ndarray:
    """``op`` over each ``k`` consecutive values (length ``len(x) - k + 1``)."""
    out, width = x, 1
    while width * 2 <= k:
        out, width = op(out[:-width], out[width:]), width * 2
    return op(out[:len(x) - k + 1], out[k - width:]) if width < k else out


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors (of documents of at least ``WINDOW`` words) and their hashes, never ``NONE``."""
    h, inner = words.h, WINDOW - PHRASE + 1
    if len(h) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = words.doc()
    g = chain(h, PHRASE)
    g[(doc[:len(g)] != doc[PHRASE - 1:]) | (g == NONE)] = NONE
    least = _sliding(g, inner, np.minimum)
    least[doc[:len(least)] != doc[WINDOW - 1:]] = 0
    back = np.concatenate([np.zeros(inner - 1, np.uint64), least, np.zeros(inner - 1, np.uint64)])
    at = np.flatnonzero((_sliding(back, inner, np.maximum) == g) & (g != NONE))
    return at, g[at]


def _anchor_rows(buckets: int):
    def run(batches):
        held, blocks, n = [], [], 0

        def flush():
            k, block = np.concatenate(held), np.concatenate(blocks)
            order = np.lexsort((block, k))
            k, block = k[order], block[order]
            first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (block[1:] != block[:-1])))
            many = np.diff(np.append(first, len(k))) > 1
            k, block = k[first], block[first]
            order, at = by_bucket(k, buckets)
            full = np.flatnonzero(np.diff(at))
            pack = lambda x: pa.array([x[order[at[p]:at[p + 1]]].tobytes() for p in full], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pack(k), pack(block), pack(many)], names=["bucket", "keys", "blocks", "many"])

        for b in batches:
            block = b.column("block").to_numpy()
            for lo, _, words in slices(b.column("text"), lower=False):
                at, keys = anchors(words)
                held.append(keys)
                blocks.append(block[lo + words.doc()[at]].astype(np.int32))
                n += len(keys)
                if n >= FLUSH:
                    yield flush()
                    held, blocks, n = [], [], 0
        if n:
            yield flush()
    return run


def _recurring(key, t):
    """Anchors that occur more than once, for each block that holds them."""
    k, block, many = joined(t.column("keys"), np.uint64), joined(t.column("blocks"), np.int32), joined(t.column("many"), bool)
    order = np.argsort(k, kind="stable")
    k, block, many = k[order], block[order], many[order]
    first = np.append(True, k[1:] != k[:-1])
    group = np.cumsum(first) - 1
    hot = (np.bincount(group) > 1) | (np.bincount(group, many) > 0)
    k, block = k[hot[group]], block[hot[group]]
    order = np.argsort(block, kind="stable")
    k, block = k[order], block[order]
    b, at = np.unique(block, return_index=True)
    at = np.append(at, len(k))
    return pa.table({"block": pa.array(b.astype(np.int32)), "keys": pa.array([k[at[i]:at[i + 1]].tobytes() for i in range(len(b))], pa.binary())})


def _tie(sha: str) -> int:
    """What tells documents of one id apart."""
    return int(sha[:16], 16)


FOUND = "doc_id bigint, sha string, block int, text string, bucket int, high binary, low binary, docs binary, ties binary, starts binary"


def _automata(phrases: list[str]):
    import ahocorasick
    for lo in range(0, len(phrases), PATTERNS):
        a = ahocorasick.Automaton()
        for p in phrases[lo:lo + PATTERNS]:
            a.add_word(p, len(p))
        a.make_automaton()
        yield a


def _locate(buckets: int):
    """Windows around the occurrences of a block's recurring phrases."""
    def run(key, texts, known):
        hot = np.unique(joined(known.column("keys"), np.uint64))
        n = texts.num_rows
        docs, shas = texts.column("doc_id").to_pylist(), texts.column("sha").to_pylist()
        column = texts.column("text").combine_chunks() if n else pa.array([], pa.string())
        data, offsets = text_buffer(column)
        plain, phrases = [], set()
        for lo, hi, words in slices(column, lower=False):
            at, keys = anchors(words)
            owner = words.doc()
            own = [_words_of(data, offsets, i) for i in range(lo, hi)]
            plain += own
            for p in at[np.isin(keys, hot)].tolist():
                d = int(owner[p])
                s = p - int(words.first[d])
                phrases.add(b" " + b" ".join(own[d][s:s + PHRASE]) + b" ")
        spots = [[] for _ in range(n)]
        for a in _automata([p.decode("latin-1") for p in sorted(phrases)]):
            for i, w in enumerate(plain):
                if len(w) >= WINDOW:
                    spots[i] += [end - size + 1 for end, size in a.iter((b" " + b" ".join(w) + b" ").decode("latin-1"))]
        high, low, who, start, hit = [], [], [], [], []
        for i, w in enumerate(plain):
            if not spots[i]:
                continue
            hit.append(i)
            begins = np.cumsum([0, *[len(x) + 1 for x in w]])[:-1]
            p = np.searchsorted(begins, np.unique(spots[i]))
            marks = np.zeros(len(w) + 1, np.int64)
            np.add.at(marks, np.maximum(p - (WINDOW - PHRASE), 0), 1)
            np.add.at(marks, p + 1, -1)
            s = np.flatnonzero(np.cumsum(marks)[:len(w) - WINDOW + 1])
            text = np.frombuffer(b" ".join(w), np.uint8)
            h = Words(text, np.array([0, len(text)]), lower=False).h
            high.append(chain(h, WINDOW, 1)[s])
            low.append((chain(h, WINDOW, 2)[s] >> np.uint64(32)).astype(np.uint32))
            who.append(np.full(len(s), i, np.int64))
            start.append(s.astype(np.int32))
        none = lambda m, kind: pa.array([None] * m, kind)
        block = key[0].as_py()
        rows = [[pa.array([docs[i] for i in hit], pa.int64()), pa.array([shas[i] for i in hit], pa.string()), pa.array([block] * len(hit), pa.int32()),
                 pa.array([b" ".join(plain[i]) for i in hit], pa.binary()).cast(pa.string()), none(len(hit), pa.int32()), *[none(len(hit), pa.binary())] * 5]]
        if hit:
            high, low, who, start = (np.concatenate(x) for x in (high, low, who, start))
            # ids as they sort: null last
            ids = np.array([np.iinfo(np.int64).max if d is None else d for d in docs], np.int64)[who]
            ties = np.array([_tie(x) for x in shas], np.uint64)[who]
            order, at = by_bucket(high, buckets)
            full = np.flatnonzero(np.diff(at))
            pack = lambda x: pa.array([x[order[at[p]:at[p + 1]]].tobytes() for p in full], pa.binary())
            m = len(full)
            rows.append([none(m, pa.int64()), none(m, pa.string()), pa.array([block] * m, pa.int32()), none(m, pa.string()), pa.array(full.astype(np.int32)),
                         pack(high), pack(low), pack(ids), pack(ties), pack(start)])
        names = [x.split()[0] for x in FOUND.split(", ")]
        return pa.concat_tables([pa.table(dict(zip(names, r, strict=True))) for r in rows])
    return run


def _later(key, t):
    """All starts but the first of each window, by block."""
    high, low = joined(t.column("high"), np.uint64), joined(t.column("low"), np.uint32)
    docs, ties, starts = joined(t.column("docs"), np.int64), joined(t.column("ties"), np.uint64), joined(t.column("starts"), np.int32)
    size = [len(x) // 8 for x in t.column("high").to_pylist()]
    block = np.repeat(np.array(t.column("block").to_pylist(), np.int32), size)
    order = np.lexsort((starts, ties, docs, low, high))
    high, low, docs, ties, starts, block = (x[order] for x in (high, low, docs, ties, starts, block))
    first = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
    lead = np.flatnonzero(first)[np.cumsum(first) - 1]
    again = (docs != docs[lead]) | (ties != ties[lead]) | (starts != starts[lead])  # identical rows start at the same place
    docs, ties, starts, block = (x[again] for x in (docs, ties, starts, block))
    order = np.argsort(block, kind="stable")
    docs, ties, starts, block = (x[order] for x in (docs, ties, starts, block))
    b, at = np.unique(block, return_index=True)
    at = np.append(at, len(docs))
    cut = lambda x: pa.array([x[at[i]:at[i + 1]].tobytes() for i in range(len(b))], pa.binary())
    return pa.table({"block": pa.array(b.astype(np.int32)), "docs": cut(docs), "ties": cut(ties), "starts": cut(starts)})


def _remove(key, texts, later):
    """Covered words go: ``(doc_id, sha, n_removed, kept_text)``."""
    docs, ties, starts = joined(later.column("docs"), np.int64), joined(later.column("ties"), np.uint64), joined(later.column("starts"), np.int32)
    order = np.lexsort((ties, docs))
    docs, ties, starts = docs[order], ties[order], starts[order]
    begin = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (ties[1:] != ties[:-1]))) if len(docs) else np.zeros(0, np.int64)
    of = dict(zip(zip(docs[begin].tolist(), ties[begin].tolist()), np.split(starts, begin[1:])))
    out = []
    for d, sha, text in zip(*(texts.column(c).to_pylist() for c in ("doc_id", "sha", "text")), strict=True):
        s = of.get((np.iinfo(np.int64).max if d is None else d, _tie(sha)))
        if s is None:
            continue
        w = text.encode().split()
        marks = np.zeros(len(w) + WINDOW + 1, np.int64)
        s = s[s <= len(w) - WINDOW]
        np.add.at(marks, s, 1)
        np.add.at(marks, s + WINDOW, -1)
        kept = np.flatnonzero(np.cumsum(marks)[:len(w)] == 0).tolist()
        out.append((d, sha, len(w) - len(kept), b" ".join([w[i] for i in kept]).decode("utf-8", "replace")))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string())
    return pa.table({n: pa.array([r[k] for r in out], kind) for k, (n, kind) in enumerate(zip(("doc_id", "sha", "n_removed", "kept_text"), kinds, strict=True))})


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1_500_000, max_broadcast: int = 500_000) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_words, n_removed, kept_sha256, kept_text``
    (``kept_text``: the kept words joined by one space where words were removed, else null)."""
    spark = df.sparkSession
    raw = F.xxhash64("text")
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(F.col(text_col).cast("string")).alias("text")).withColumn("raw", raw)
    ids = written(docs.mapInArrow(_identities, "doc_id bigint, raw bigint, n_words bigint, sha string"), "identities")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id"))
    groups = written(ids.where(F.col("n_words") >= WINDOW).groupBy("sha").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select("sha", F.col("first.doc_id").alias("first_id")), "copies")
    marked = ids.join(groups, "sha", "left")
    copy = F.col("first_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    copies = written(marked.where(copy).select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw")).distinct(), "copies")

    own = docs.join(small(copies, max_broadcast), docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["raw"] == F.col("_raw")), "left_anti")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = spread(spark, size, block_bytes)
    buckets = spread(spark, size // 40, 1_000_000)
    own = own.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "raw", F.lit(5)), F.lit(blocks)).cast("int").alias("block"))
    known = (own.mapInArrow(_anchor_rows(buckets), "bucket int, keys binary, blocks binary, many binary")
             .groupBy("bucket").applyInArrow(_recurring, "block int, keys binary"))
    named = own.mapInArrow(_with_sha, "doc_id bigint, sha string, text string, block int")
    found = written(named.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_locate(buckets), FOUND), "found")
    later = found.where("bucket is not null").groupBy("bucket").applyInArrow(_later, "block int, docs binary, ties binary, starts binary")
    cut = found.where("bucket is null").groupBy("block").cogroup(later.groupBy("block")).applyInArrow(
        _remove, "doc_id bigint, sha string, n_removed bigint, kept_text string")
    cut = cut.dropDuplicates(["doc_id", "sha"]).select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"), "n_removed", "kept_text")
    out = marked.withColumn("copy", copy)
    out = out.join(cut, out["doc_id"].eqNullSafe(F.col("_id")) & (out["sha"] == F.col("_sha")), "left")
    removed = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text"))
    return out.select("doc_id", "n_words", removed.cast("bigint").alias("n_removed"),
                      F.when(kept.isNull(), F.col("sha")).otherwise(F.sha2(kept, 256)).alias("kept_sha256"), kept.alias("kept_text"))


def _with_sha(batches):
    for b in batches:
        data, offsets = text_buffer(b.column("text"))
        sha = [hashlib.sha256(b" ".join(_words_of(data, offsets, i))).hexdigest() for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sha, pa.string()), b.column("text"), b.column("block")], names=["doc_id", "sha", "text", "block"])
