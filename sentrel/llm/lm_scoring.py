"""Operator 4, language-model scores from a log-frequency Bloom filter.

Corpus counts (all training texts, whole): words are counted by a shuffle of
packed, pre-combined hash arrays; then pairs of consecutive words of the head
vocabulary are counted the same way, pairs with another word as rows. The head holds
the most frequent words (``head_words`` at most, by a count threshold from the count histogram).

Filter: a pair's count is quantised to a level (1, 2, 3, 4, 6, 8, 12, ...) and the pair is
entered once for each level up to its own. The count is read back by probing level
after level until one is missing. The filter has ``filter_bytes`` at most: if
the pairs need more, those of the lowest counts (the smallest count that fits is taken
from the whole histogram) stay in their buckets, and a text's pairs that the filter does
not hold go there. So what is broadcast - filter, head words and their totals - has a
size bound that does not depend on the corpus, and every pair counts at every size.

Model: absolute discounting. P(w|v) = max(n - D, 0) / c(v) for a pair of the training
texts, plus the mass that is left at v times P1(w); P1 is the add-half unigram of the base
score. Contexts that training never saw give P1. The end of a text is a token, its start
a context; so a text's score is log10 of a probability over texts.

Words outside the head are rare by construction. Counts of pairs with such a word lie in the bucket
of that word (of the first, if both are), beside the words' own counts. Texts send what they have of them there,
packed by bucket, and get logarithms back, summed per text; a pair of two such words calls at the second one's bucket first.
If the head holds all words of training, other words have count 0 and no row is needed.

Words are 64-bit hashes throughout (see :mod:`sentrel.llm.shared`).

Defined results: a null text is empty: one token, the end. A null id is never held
out. Repeated rows count as often as they occur. With no training rows every count is 0
and the model is the base. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import bucket_of, by_bucket, mix, Sent, slices, spread, text_of, written

DISCOUNT = 0.75
PROBES = 6
LEVELS = np.unique(np.round(2.0 ** (np.arange(0, 96) / 2)).astype(np.int64))[:80]
COUNTS = "bucket int, keys binary, counts binary"
FLUSH = 3_000_000
#: Text bytes that a task turns into arrays at once, beside the model.
SLICE = 500_000
#: Tokens that a scoring task holds for the buckets before it sends them (32 bytes each, copied a few times).
ASKED = 250_000


def held_out(id_col: str = "doc_id", of: int = 5):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == 1, F.lit(False))


def pack(x: np.ndarray) -> bytes:
    """An array, all first bytes, then all second ones and so on: sorted or small numbers compress by far better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def joined(column, kind) -> np.ndarray:
    """All values of a column of packed arrays, one after another."""
    return np.concatenate([unpack(x, kind) for x in column.to_pylist() if x] or [np.zeros(0, kind)])


# --- counting ---------------------------------------------------------------------------

def _packed(keys: list[np.ndarray], buckets: int, by=None):
    """Rows of ``COUNTS``: the keys combined, dealt by the hash of the key."""
    if not keys:
        return
    k, n = np.unique(np.concatenate(keys), return_counts=True)
    order, at = by_bucket(k if by is None else by(k), buckets)
    k, n = k[order], n[order].astype(np.uint32)
    full = np.flatnonzero(np.diff(at))
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([pack(k[at[b]:at[b + 1]]) for b in full], pa.binary()),
                                      pa.array([pack(n[at[b]:at[b + 1]]) for b in full], pa.binary())], names=["bucket", "keys", "counts"])


def _counter(keys_of, buckets: int, by=None):
    def run(batches):
        pending, held = [], 0
        for b in batches:
            for _, _, words in slices(b.column("text"), lower=True, size=SLICE):
                pending.append(keys_of(words))
                held += len(pending[-1])
                if held >= FLUSH:
                    yield from _packed(pending, buckets, by)
                    pending, held = [], 0
        yield from _packed(pending, buckets, by)
    return run


def _merge(key, t):
    k, n = joined(t.column("keys"), np.uint64), joined(t.column("counts"), np.uint32).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([pack(k[first])], pa.binary()),
                     "counts": pa.array([pack(np.add.reduceat(n, first))], pa.binary())})


def counted(texts: DataFrame, keys_of, buckets: int, name: str, by=None) -> DataFrame:
    """A row per bucket: its sorted distinct keys and their counts (int64)."""
    return written(texts.mapInArrow(_counter(keys_of, buckets, by), COUNTS).groupBy("bucket").applyInArrow(_merge, COUNTS), name)


def _bins(n: np.ndarray) -> np.ndarray:
    """Counts below 1,024 as they are, larger ones by 64 bins a doubling (lower edge kept in order)."""
    return np.where(n < 1024, n, 1024 + np.floor(64 * (np.log2(np.maximum(n, 1)) - 10)).astype(np.int64))


def histogram(counts: DataFrame) -> list[tuple[int, int, int]]:
    """``(bin, distinct keys, sum of counts)`` over all buckets: a few thousand rows at most."""
    def run(batches):
        for b in batches:
            n = joined(b.column("counts"), np.int64)
            bins, which, keys = np.unique(_bins(n), return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(keys), pa.array(np.bincount(which, n, len(bins)).astype(np.int64))], names=["bin", "keys", "total"])
    rows = counts.mapInArrow(run, "bin bigint, keys bigint, total bigint").groupBy("bin").agg(F.sum("keys"), F.sum("total")).collect()
    return sorted(tuple(r) for r in rows)


def least_bin(hist: list[tuple[int, int, int]], room: float, cost=lambda b: 1) -> int:
    """The smallest bin from which on all keys fit into ``room``."""
    least = max((b for b, *_ in hist), default=0) + 1
    for b, keys, _ in reversed(hist):
        room -= keys * cost(b)
        if room < 0:
            break
        least = b
    return least


# --- head vocabulary --------------------------------------------------------------------

class Head:
    """Head words by hash: sorted ``keys``, their ``counts``, and a directory by high bits."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bits: int = 20):
        order = np.argsort(keys)
        self.keys, self.counts, self.shift = keys[order], counts[order], np.uint64(64 - bits)
        self.at = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1).astype(np.uint64)).astype(np.int32)
        self.deep = int(np.diff(self.at).max(initial=0))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each word in the head, or -1."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys):
            return out
        slot = (h >> self.shift).astype(np.int64)
        lo, n = self.at[slot], self.at[slot + 1] - self.at[slot]
        live = np.flatnonzero(n)
        for j in range(self.deep):
            live = live[n[live] > j]
            where = lo[live] + j
            hit = self.keys[where] == h[live]
            out[live[hit]] = where[hit]
            live = live[~hit]
        return out


def head_of(unigrams: DataFrame, least: int) -> Head:
    def run(batches):
        for b in batches:
            k, n = joined(b.column("keys"), np.uint64), joined(b.column("counts"), np.int64)
            top = _bins(n) >= least
            yield pa.RecordBatch.from_arrays([pa.array([k[top].tobytes()], pa.binary()), pa.array([n[top].tobytes()], pa.binary())], names=["keys", "counts"])
    rows = unigrams.mapInArrow(run, "keys binary, counts binary").collect()  # head_words at most
    return Head(*(np.frombuffer(b"".join(bytes(r[c]) for r in rows), kind) for c, kind in (("keys", np.uint64), ("counts", np.int64))))


def token_ids(words, head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and tokens as head numbers (-1: not in the head; ``len(head.keys)``: start or end), and where
    each text's tokens begin. Every text has an end, so it has one token more than words."""
    size, texts = len(head.keys), len(words.first) - 1
    at = words.first + np.arange(texts + 1)  # texts' first tokens
    ids = np.full(len(words.h) + texts, size, np.int64)
    place = np.ones(len(ids), bool)
    place[at[1:] - 1] = False
    ids[place] = head.find(words.h)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[at[:-1]] = size
    return before, ids, at


def pair_keys(before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pairs within the head, and which they are."""
    both = np.flatnonzero((before >= 0) & (ids >= 0))
    return before[both].astype(np.uint64) << np.uint64(32) | ids[both].astype(np.uint64), both


# --- pairs with a word outside the head ----------------------------------------------------

EDGE = np.uint64(0x5851F42D4C957F2D)  # the start and the end of a text, among word hashes


def tail_tokens(words, before: np.ndarray, ids: np.ndarray, at: np.ndarray):
    """The tokens that are or follow a word outside the head: where they are, the hashes of their
    pairs, contexts and words."""
    h = np.full(len(ids), EDGE, np.uint64)
    place = np.ones(len(ids), bool)
    place[at[1:] - 1] = False
    h[place] = words.h
    context = np.append(EDGE, h[:-1])[:len(h)]
    context[at[:-1]] = EDGE
    where = np.flatnonzero((before < 0) | (ids < 0))
    v, w = context[where], h[where]
    return where, mix(mix(v) + w), v, w


TAIL_PAIRS = "bucket int, p binary, owner binary, head binary, n binary"
TAIL = "bucket int, words binary, word_counts binary, rest binary, p binary, q binary, v binary, kinds binary, mass binary"


def _by_bucket_rows(buckets: np.ndarray, columns: dict, extra: dict | None = None):
    """A batch of packed rows: ``columns`` (name to array) cut by ``buckets``."""
    order = np.argsort(buckets, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(buckets[order]) != 0)) if len(order) else order
    ends = np.append(cut[1:], len(order))
    packed = {c: pa.array([pack(x[order[i:j]]) for i, j in zip(cut, ends)], pa.binary()) for c, x in columns.items()}
    return {"bucket": pa.array(buckets[order[cut]].astype(np.int32)), **packed, **{c: pa.array([x] * len(cut), kind) for c, (x, kind) in (extra or {}).items()}}


def _tail_counter(seen, buckets: int):
    """Pairs with a word outside the head, in the bucket of that word (``owner``): the pair's hash, its context as a
    head number (-1: the owner), its count."""
    def run(batches):
        pending, held = [], 0

        def flush():
            p, owner, head = (np.concatenate(x) for x in zip(*pending))
            p, first, n = np.unique(p, return_index=True, return_counts=True)
            owner, head = owner[first], head[first]
            columns = _by_bucket_rows(bucket_of(owner, buckets), {"p": p, "owner": owner, "head": head, "n": n.astype(np.int32)})
            return pa.RecordBatch.from_pydict(columns)

        for b in batches:
            for _, _, words in slices(b.column("text"), lower=True, size=SLICE):
                before, ids, at = token_ids(words, seen.value)
                where, p, v, w = tail_tokens(words, before, ids, at)
                head = before[where]
                pending.append((p, np.where(head < 0, v, w), head.astype(np.int32)))
                held += len(p)
                if held >= FLUSH // 2:
                    yield flush()
                    pending, held = [], 0
        if held:
            yield flush()
    return run


def _tail_bucket(least: int):
    """A bucket's words outside the head with their counts and left-over mass, its pairs, and what they add to head contexts."""
    def run(key, pairs, unigrams):
        k, c = joined(unigrams.column("keys"), np.uint64), joined(unigrams.column("counts"), np.int64)
        low = _bins(c) < least
        k, c = k[low], c[low]
        p, owner = joined(pairs.column("p"), np.uint64), joined(pairs.column("owner"), np.uint64)
        head, n = joined(pairs.column("head"), np.int32), joined(pairs.column("n"), np.int32)
        p, first, which = np.unique(p, return_index=True, return_inverse=True)
        q = LEVELS[level_of(np.bincount(which, n, len(p)).astype(np.int64)) - 1]
        owner, head = owner[first], head[first]
        own = np.searchsorted(k, owner[head < 0])  # all are there: training has counted them
        kinds, mass = np.bincount(own, minlength=len(k)), np.bincount(own, q[head < 0], len(k))
        rest = np.clip((c - mass + DISCOUNT * kinds) / np.maximum(c, 1), 1e-12, 1.0)
        out = [dict(zip(_names(TAIL), (key[0].as_py(), *map(pack, (k, c, rest, p, q)))))]
        out += _context_rows(head[head >= 0].astype(np.int64), q[head >= 0])
        return pa.table({x: pa.array([r.get(x) for r in out], pa.int32() if x == "bucket" else pa.binary()) for x in _names(TAIL)})
    return run


def tail_counts(texts: DataFrame, seen, unigrams: DataFrame, buckets: int, least: int) -> DataFrame:
    """Rows of ``TAIL``: one per bucket of ``unigrams``, and (below 0) parts of the head contexts' sums."""
    found = texts.mapInArrow(_tail_counter(seen, buckets), TAIL_PAIRS)
    return written(found.groupBy("bucket").cogroup(unigrams.groupBy("bucket")).applyInArrow(_tail_bucket(least), TAIL), "tail")


# --- contexts: how many pairs, and what mass ------------------------------------------------

PARTS = 64


def _context_rows(v: np.ndarray, q: np.ndarray) -> list[dict]:
    """Packed rows (``bucket`` -1 and less, a part of the contexts each) of the number of pairs and the quantised mass of contexts."""
    if not len(v):
        return []
    v, which, kinds = np.unique(v, return_inverse=True, return_counts=True)
    columns = _by_bucket_rows(-1 - v % PARTS, {"v": v.astype(np.int32), "kinds": kinds.astype(np.int64), "mass": np.bincount(which, q, len(v)).astype(np.int64)})
    return pa.table(columns).to_pylist()


CONTEXTS = "bucket int, v binary, kinds binary, mass binary"


def _context_batch(held: list):
    rows = _context_rows(*(np.concatenate(x) for x in zip(*held))) if held else []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int32() if c == "bucket" else pa.binary()) for c in _names(CONTEXTS)], names=_names(CONTEXTS))


def add_contexts(rows: DataFrame, kinds: np.ndarray, mass: np.ndarray) -> None:
    """Adds up the rows of :func:`_context_rows`, part by part."""
    def add(key, t):
        v, kinds, mass = joined(t.column("v"), np.int32), joined(t.column("kinds"), np.int64), joined(t.column("mass"), np.int64)
        u, which = np.unique(v, return_inverse=True)
        return pa.table({"v": [pack(u)], "kinds": [pack(np.bincount(which, kinds, len(u)).astype(np.int64))], "mass": [pack(np.bincount(which, mass, len(u)).astype(np.int64))]})
    rows = rows.where("bucket < 0").select("bucket", "v", "kinds", "mass")
    for r in rows.groupBy("bucket").applyInArrow(add, "v binary, kinds binary, mass binary").collect():  # a number per head word
        v = unpack(bytes(r["v"]), np.int32)
        kinds[v] += unpack(bytes(r["kinds"]), np.int64)
        mass[v] += unpack(bytes(r["mass"]), np.int64)


# --- filter -------------------------------------------------------------------------------

def level_of(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, n, side="right")


def _salt(level: int) -> np.uint64:
    return np.uint64(0x9E3779B97F4A7C15 * level & 0xFFFFFFFFFFFFFFFF)


def _places(key: np.ndarray, level, bits: np.ndarray):
    """Successive bit places of (key, level) in filters of ``bits`` bits."""
    h = mix(key + _salt(level))
    step = mix(h) | np.uint64(1)
    for _ in range(PROBES):
        yield h % bits
        h = h + step


class Filter:
    """Log-frequency Bloom filter, one part per bucket of the pair's hash."""

    def __init__(self, parts: dict[int, bytes], buckets: int):
        self.buckets = buckets
        size = np.array([len(parts.get(b, b"")) for b in range(buckets)], np.int64)
        self.begin, self.bits = np.cumsum(np.append(0, size)) * 8, (size * 8).astype(np.uint64)
        self.data = np.frombuffer(b"".join(parts.get(b, b"") for b in range(buckets)), np.uint8)

    def level(self, key: np.ndarray) -> np.ndarray:
        """Levels of the pairs by repeated probes; 0 for pairs that were not entered."""
        out = np.zeros(len(key), np.int64)
        bucket = bucket_of(mix(key), self.buckets)
        live = np.flatnonzero(self.bits[bucket])
        level = 1
        while len(live):
            k, begin, bits = key[live], self.begin[bucket[live]], self.bits[bucket[live]]
            alive = np.arange(len(live))
            h = mix(k + _salt(level))
            step = mix(h) | np.uint64(1)
            for j in range(PROBES):
                place = begin[alive] + ((h[alive] + np.uint64(j) * step[alive]) % bits[alive]).astype(np.int64)
                alive = alive[self.data[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1]
            live = live[alive]
            out[live] = level
            level += 1
            if level > len(LEVELS):
                break
        return out


def _filter_part(keys: np.ndarray, levels: np.ndarray, bits_each: float) -> bytes:
    size = max(8, math.ceil(levels.sum() * bits_each / 8))
    bits = np.zeros(size * 8, bool)
    width = np.full(1, size * 8, np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in _places(keys[levels >= level], level, width):
            bits[place.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def build_filter(pairs: DataFrame, buckets: int, least: int, bits_each: float, size: int) -> tuple[Filter, np.ndarray, np.ndarray]:
    """The filter of all pairs from bin ``least`` on, and for each context (``size`` head words and the start) how many pairs
    and what (quantised) mass it has, entered or not."""
    def each(batches):
        for b in batches:
            for bucket, kb, nb in zip(*(b.column(c).to_pylist() for c in ("bucket", "keys", "counts")), strict=True):
                yield bucket, unpack(kb, np.uint64), unpack(nb, np.int64)

    def enter(batches):
        for bucket, k, n in each(batches):
            on = _bins(n) >= least
            if on.any():
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([_filter_part(k[on], level_of(n[on]), bits_each)], pa.binary())], names=["bucket", "filter"])

    def contexts(batches):
        held, n_held = [], 0
        for _, k, n in each(batches):
            held.append(((k >> np.uint64(32)).astype(np.int64), LEVELS[level_of(n) - 1]))
            n_held += len(k)
            if n_held >= FLUSH:
                yield from _context_batch(held)
                held, n_held = [], 0
        yield from _context_batch(held)

    filt = Filter({r["bucket"]: bytes(r["filter"]) for r in pairs.mapInArrow(enter, "bucket int, filter binary").collect()}, buckets)  # filter_bytes at most
    kinds, mass = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    add_contexts(pairs.mapInArrow(contexts, CONTEXTS), kinds, mass)
    return filt, kinds, mass


# --- scoring ------------------------------------------------------------------------------

class Model:
    """What is broadcast: head words, filter, left-over mass of each context, totals."""

    def __init__(self, head: Head, filt: Filter, kinds: np.ndarray, mass: np.ndarray, docs: int, tokens: int, vocabulary: int, low: int = 1, whole: bool = False):
        self.filter = filt
        self.low, self.whole = low, whole  # the lowest level in the filter; whether the head holds all words
        self.counts = np.append(head.counts, docs).astype(np.float64)  # the last: start and end
        self.unit = math.log10(tokens + 0.5 * (vocabulary + 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.where(self.counts > 0, (self.counts - mass + DISCOUNT * kinds) / self.counts, 1.0)
        self.rest = np.clip(rest, 1e-12, 1.0)
        self.head = Head.__new__(Head)  # the words; their counts are above
        vars(self.head).update({k: x for k, x in vars(head).items() if k != "counts"})

    def base(self, w: np.ndarray) -> np.ndarray:
        """log10 P1 of head words by their numbers."""
        return np.log10(self.counts[w] + 0.5) - self.unit

    def seen(self, v: np.ndarray, w: np.ndarray, level: np.ndarray) -> np.ndarray:
        """log10 P of pairs of head words by the level of their count (1 at least)."""
        c = self.counts[v]
        n = np.minimum(LEVELS[level - 1], np.minimum(c, self.counts[w]))  # no pair is more frequent than its words
        return np.log10(np.maximum(n - DISCOUNT, 0) / np.maximum(c, 1) + self.rest[v] * 10.0 ** self.base(w))

    def score(self, before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P1 and log10 P per token, as ``score_and_rest``."""
        return self.score_and_rest(before, ids)[:2]

    def score_and_rest(self, before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 P1 and log10 P per token, without P1 of tokens outside the head and P after or of them (0), unless the
        head holds all words; and the pairs that the filter does not hold (keys and places; P is the back-off there)."""
        base = np.where(ids >= 0, self.base(ids), math.log10(0.5) - self.unit if self.whole else 0.0)
        rest = np.where(before >= 0, self.rest[before], 1.0)
        out = base + np.log10(rest)
        if not self.whole:
            out[(before < 0) | (ids < 0)] = 0
        keys, both = pair_keys(before, ids)
        distinct, which = np.unique(keys, return_inverse=True)  # a frequent pair is probed up to its level, once a slice
        level = self.filter.level(distinct)[which]
        hit, miss = np.flatnonzero(level >= self.low), np.flatnonzero(level < self.low) if self.low > 1 else np.zeros(0, np.int64)
        at = both[hit]
        out[at] = self.seen(before[at], ids[at], level[hit])
        return base, out, keys[miss], both[miss]


SCORED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, kind int, bucket int, p binary, word binary, other binary, rows binary"
#: Kinds of packed rows that a text sends to buckets: pairs that the filter does not hold; tokens outside the head after a
#: head word, after a word outside it (both to the token's bucket); head words after a word outside it (to that word's bucket).
RARE, NEW_AFTER_HEAD, NEW_AFTER_NEW, HEAD_AFTER_NEW = range(4)
#: What buckets send: sums of texts (known, base and score in ``p``, ``word`` and ``other``) to the texts' own buckets; tokens
#: outside the head after a word outside the head, with their log10 P1 (``other``), to the bucket of that word.
SUMS, ONWARD = 4, 5


def _scorer(shared, buckets: int):
    def run(batches):
        model = shared.value
        held, n = {k: [] for k in range(4)}, 0

        def flush():
            for kind, parts in held.items():
                if parts:
                    p, word, other, rows = (np.concatenate(x) for x in zip(*parts))
                    bucket = bucket_of(mix(p) if kind == RARE else word, buckets)
                    of_word = {"word": word, "other": other} if kind != RARE else {}
                    extra = {"kind": (kind, pa.int32()), **{c: (None, pa.binary()) for c in ("word", "other") if c not in of_word}}
                    columns = _by_bucket_rows(bucket, {"p": p, **of_word, "rows": rows}, extra)
                    none = pa.nulls(len(columns["kind"]))
                    yield pa.RecordBatch.from_arrays([*[none.cast(t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())],
                                                      *[columns[c] for c in _names(SCORED)[7:]]], names=_names(SCORED))
                    parts.clear()

        for b in batches:
            row_ids = b.column("row").to_numpy()
            for lo, hi, words in slices(b.column("text"), lower=True, size=SLICE):
                before, ids, at = token_ids(words, model.head)
                base, score, keys, places = model.score_and_rest(before, ids)
                add = lambda x: np.add.reduceat(x, at[:-1])  # noqa: E731,B023
                known = add((ids >= 0) & (model.counts[ids] > 0)).astype(np.int64)
                none = pa.nulls(hi - lo)
                yield pa.RecordBatch.from_arrays([pa.array(row_ids[lo:hi]), b.column("doc_id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(known), pa.array(add(base)), pa.array(add(score)),
                                                  none.cast(pa.int32()), pa.array((row_ids[lo:hi] % buckets).astype(np.int32)), *[none.cast(pa.binary())] * 4], names=_names(SCORED))
                row_of = lambda x: row_ids[lo:hi][np.searchsorted(at, x, side="right") - 1]  # noqa: E731,B023
                if len(keys):
                    held[RARE].append((keys, np.zeros(0, np.uint64), np.zeros(0, np.int64), row_of(places)))
                if not model.whole:
                    where, p, v, w = tail_tokens(words, before, ids, at)
                    rows, cv, cw = row_of(where), before[where], ids[where]
                    for kind, on, word, other in ((NEW_AFTER_HEAD, (cv >= 0) & (cw < 0), w, cv), (NEW_AFTER_NEW, (cv < 0) & (cw < 0), w, v.view(np.int64)), (HEAD_AFTER_NEW, (cv < 0) & (cw >= 0), v, cw)):
                        if on.any():
                            held[kind].append((p[on], word[on], other[on], rows[on]))
                    n += len(where)
                n += len(keys)
                if n >= ASKED:
                    yield from flush()
                    n = 0
        yield from flush()
    return run


def _summed(buckets: int, rows: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> dict:
    """Columns of packed sums by row, dealt to the rows' own buckets."""
    u, which = np.unique(rows, return_inverse=True)
    add = lambda x: np.bincount(which, x, len(u))
    return _by_bucket_rows(u % buckets, {"rows": u, "p": add(known).astype(np.int64), "word": add(base).astype(np.float64), "other": add(score).astype(np.float64)}, {"kind": (SUMS, pa.int32())})


def _rare(model: Model, least: int, t: pa.Table, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """What pairs below the filter's smallest count add to their texts' scores."""
    k, n = joined(t.column("keys"), np.uint64), joined(t.column("counts"), np.int64)
    low = _bins(n) < least
    k, n = k[low], n[low]
    at = np.minimum(np.searchsorted(k, h), max(len(k) - 1, 0))
    hit = np.flatnonzero(k[at] == h) if len(k) else np.zeros(0, np.int64)
    v, w = (h[hit] >> np.uint64(32)).astype(np.int64), (h[hit] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    none = np.zeros(len(hit))
    return rows[hit], none, none, model.seen(v, w, level_of(n[at[hit]])) - model.base(w) - np.log10(model.rest[v])


class _Tail:
    """A bucket's row of ``TAIL``."""

    def __init__(self, t: pa.Table, unit: float):
        self.words, self.counts, self.rest = (joined(t.column(c), kind) for c, kind in (("words", np.uint64), ("word_counts", np.int64), ("rest", np.float64)))
        self.p, self.q, self.unit = joined(t.column("p"), np.uint64), joined(t.column("q"), np.int64), unit

    def word(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and left-over mass of words; 0 and 1 for those that training never saw."""
        if not len(self.words):
            return np.zeros(len(h)), np.ones(len(h))
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        own = self.words[at] == h
        return np.where(own, self.counts[at], 0).astype(np.float64), np.where(own, self.rest[at], 1.0)

    def unigram(self, c: np.ndarray) -> np.ndarray:
        return np.log10(c + 0.5) - self.unit

    def score(self, p: np.ndarray, c: np.ndarray, rest: np.ndarray, lw: np.ndarray) -> np.ndarray:
        """log10 P of pairs from their contexts' counts and left-over mass and their words' log10 P1."""
        out = lw + np.log10(rest)
        if len(self.p):
            at = np.minimum(np.searchsorted(self.p, p), len(self.p) - 1)
            hit = np.flatnonzero(self.p[at] == p)
            out[hit] = np.log10(np.maximum(self.q[at[hit]] - DISCOUNT, 0) / np.maximum(c[hit], 1) + rest[hit] * 10.0 ** lw[hit])
        return out


def _asked(t: pa.Table, other=np.int64) -> tuple[np.ndarray, ...]:
    return tuple(joined(t.column(c), kind) for c, kind in (("p", np.uint64), ("word", np.uint64), ("other", other), ("rows", np.int64)))


TABLES = ["keys", "counts", "words", "word_counts", "rest", "p", "q"]


def _answers(shared, unit: float, least: int, buckets: int):
    """Rows of documents as they are, what a bucket's counts add to the sums of their texts, and (packed, for another
    bucket) tokens outside the head after a word outside the head, with their log10 P1; their base is added here."""
    def run(key, asked, tables):
        model, tail = shared.value, _Tail(tables, unit)
        kind = asked.column("kind")
        docs = asked.filter(kind.is_null())
        kind, out, onward = kind.fill_null(-1).to_numpy(), [], None
        for k in range(4):
            p, word, other, rows = _asked(asked.filter(pa.array(kind == k)))
            none = np.zeros(len(rows))
            if k == RARE:
                out.append(_rare(model, least, tables, p, rows))
                continue
            c, rest = tail.word(word)
            lw = tail.unigram(c)
            if k == NEW_AFTER_HEAD:
                out.append((rows, c > 0, lw, tail.score(p, model.counts[other], model.rest[other], lw)))
            elif k == NEW_AFTER_NEW:
                out.append((rows, c > 0, lw, none))
                before = other.view(np.uint64)
                onward = _by_bucket_rows(bucket_of(before, buckets), {"p": p, "word": before, "other": lw, "rows": rows}, {"kind": (ONWARD, pa.int32())})
            else:
                out.append((rows, none, none, tail.score(p, c, rest, model.base(other))))
        parts = [docs, pa.table(_summed(buckets, *(np.concatenate(x) for x in zip(*out)))), pa.table(onward)]
        return pa.concat_tables([_filled(t) for t in parts])
    return run


def _filled(t: pa.Table) -> pa.Table:
    """``t`` with the columns of ``SCORED``; nulls where it has none."""
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.table({c: t.column(c).cast(kinds[k]) if c in t.column_names else pa.nulls(t.num_rows, kinds[k]) for c, k in (x.split() for x in SCORED.split(", "))})


def _after_new(unit: float, buckets: int):
    def run(key, asked, tail):
        p, word, lw, rows = _asked(asked, np.float64)
        tail, none = _Tail(tail, unit), np.zeros(len(rows))
        return _filled(pa.table(_summed(buckets, rows, none, none, tail.score(p, *tail.word(word), lw))))
    return run


def _total(key, t):
    """The documents of a bucket with the sums that came for them."""
    kind = t.column("kind")
    docs, sums = t.filter(kind.is_null()), t.filter(kind.is_valid())
    rows = docs.column("row").to_numpy()
    order = np.argsort(rows)
    at = order[np.searchsorted(rows, joined(sums.column("rows"), np.int64), sorter=order)]
    out = {c: docs.column(c) for c in ("doc_id", "held_out", "n_tokens")}
    for c, packed, dtype in (("known", "p", np.int64), ("base", "word", np.float64), ("score", "other", np.float64)):
        more = np.bincount(at, joined(sums.column(packed), dtype), len(rows)) if len(rows) else np.zeros(0)
        out[c] = pa.array(docs.column(c).to_numpy() + more.astype(dtype))
    return pa.table(out)


def whole_scores(scored: DataFrame, shared, pairs: DataFrame | None, tail: DataFrame | None, least: int, buckets: int) -> DataFrame:
    """The rows of documents with what is added by pairs that the filter does not hold (if ``pairs``), and by tokens that
    are or follow words outside the head (if ``tail``)."""
    unit, none = shared.value.unit, F.lit(None).cast("binary")
    tables = [t.select("bucket", *[F.col(c) if c in t.columns else none.alias(c) for c in TABLES])
              for t in (pairs, None if tail is None else tail.where("bucket >= 0").drop("v", "kinds", "mass")) if t is not None]
    both = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    answers = written(scored.groupBy("bucket").cogroup(both.groupBy("bucket")).applyInArrow(_answers(shared, unit, least, buckets), SCORED), "answers")
    out = answers.where(F.col("kind").isNull() | (F.col("kind") == SUMS))
    if tail is not None:
        asked = answers.where(F.col("kind") == ONWARD).select("bucket", "p", "word", "other", "rows")
        out = out.union(asked.groupBy("bucket").cogroup(tables[-1].groupBy("bucket")).applyInArrow(_after_new(unit, buckets), SCORED))
    return out.groupBy("bucket").applyInArrow(_total, "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double")


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_words: int = 1_000_000,
              filter_bytes: int = 64_000_000, bits_each: float = 10.0) -> DataFrame:
    """One row per row of ``df``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(F.col(text_col).cast("string")).alias("text"))
    train = docs.where(~held_out())
    r = train.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_docs, size = r[0], r[1] or 0
    buckets = spread(spark, size // 6, 1_000_000)

    unigrams = counted(train.select("text"), lambda w: w.h, buckets, "unigrams")
    hist = histogram(unigrams)
    tokens, vocabulary = sum(t for *_, t in hist) + n_docs, sum(k for _, k, _ in hist) + (n_docs > 0)
    least_word = least_bin(hist, head_words)
    head, whole = head_of(unigrams, least_word), all(b >= least_word for b, *_ in hist)
    seen = Sent(spark, head)
    pairs = counted(train.select("text"), lambda w: pair_keys(*token_ids(w, seen.value)[:2])[0], buckets, "pairs", by=mix)
    lowest = lambda b: b if b < 1024 else math.ceil(2 ** (10 + (b - 1024) / 64))  # noqa: E731  the smallest count of a bin
    pair_hist = histogram(pairs)
    least = least_bin(pair_hist, filter_bytes * 8 / bits_each, lambda b: int(level_of(np.array([lowest(b)]))[0] + (b >= 1024)))
    low = 1 if all(b >= least for b, *_ in pair_hist) else int(level_of(np.array([lowest(least)]))[0])
    filt, kinds, mass = build_filter(pairs, buckets, least, bits_each, len(head.keys))
    if not whole:
        tail = tail_counts(train.select("text"), seen, unigrams, buckets, least_word)
        add_contexts(tail, kinds, mass)
    shared = Sent(spark, Model(head, filt, kinds, mass, n_docs, tokens, vocabulary, low, whole))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out().alias("held_out"), "text")
    out = rows.mapInArrow(_scorer(shared, buckets), SCORED)
    if low > 1 or not whole:
        out = whole_scores(out, shared, pairs if low > 1 else None, None if whole else tail, least, buckets)
    return out.select("doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(int(tokens)).cast("bigint").alias("train_tokens"),
                      F.col("base").alias("base_score"), "score")
