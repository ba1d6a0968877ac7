"""Operator 6, packing documents into fixed windows by lexical retrieval.

A document becomes token ids (a public tokenizer, ids of its text, then the
end id). Full windows of ``length`` ids at its start are sequences of their own;
the rest (its tail, shorter than a window) is packed with tails of similar documents.
The corpus is dealt into shards by a range sort on a minimum hash of each
document's words, which puts similar documents side by side and, ties being broken by
id, never puts a group of copies into one shard. Every shard builds a BM25
inverted index of its tails. The longest unused tail is the seed of a sequence;
the index ranks the unused tails for it, and they fill its window greedily in that
order. This first round keeps the sequences whose fillers score ``NEAR``
of their seed's own score for half of their ids; the tails of the others meet again in a second
round, dealt by another minimum hash, where every filled sequence is kept; what is left of the shards' last
windows is packed in a third. A tail that does not fit is cut at a multiple of ``GRAIN`` ids and its rest stays in
the pool, so padding is under ``GRAIN`` ids a sequence (but for the last of a shard of the last round).

Only checksums travel, never ids: a tail carries the CRC-32 of its prefixes at
each multiple of ``GRAIN``, from which the CRC-32 of any piece follows (CRC is linear).

White space never joins two tokens of this tokenizer (its pattern has no
alternative that matches white space, and it drops it; it lower-cases). Words of ASCII and Latin-1 letters, digits and signs are cut into the
pattern's matches by numpy; these, and other words as they are, are the units of encoding. A distinct unit (told by its 64-bit hash) is encoded once by a
worker and reused, by the merges of operator 13, all new ones of some texts at once; what
holds a special token goes to the library. Tests compare that with the library on whole texts.

Defined results: a null or empty text has the end id only. Repeated rows are
packed as often as they occur. A null id stays null. An empty table, shard or round has no
pieces. Only the two named columns are read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import Powers, Words, arrow_bytes, looked_up, mix, text_buffer, written
from sentrel.llm.token_counts import TokenCounter

GRAIN = 32
END = 2
#: A tail is like a seed from this part of the seed's score for itself on.
NEAR = 0.5
#: Shard numbers of the second round begin here.
SECOND = 1 << 29
TOKENS = "doc_id bigint, doc_tokens bigint, full_crcs binary, tail_crcs binary, terms binary, counts binary, near bigint"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"

#: Distinct units whose ids a worker keeps, and how many ids; beyond that it starts anew.
KEPT_UNITS, KEPT_IDS = 800_000, 16_000_000

#: Bytes of text that a task turns into arrays at once (they stay in the processor's cache), and that it encodes at once.
SLICE, TOGETHER = 64_000, 1_000_000


class _Table:
    """Ids of units (words or pre-tokens) by the units' hashes, looked up for whole arrays by open addressing."""

    def __init__(self, units: int = KEPT_UNITS):
        slots = 1 << math.ceil(math.log2(2.5 * units))
        self.keys, self.number = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        self.at, self.n = np.zeros(units, np.int64), np.zeros(units, np.int32)  # by number: frequent units, which come early, lie together
        self.ids, self.used, self.units, self.room, self.mask = np.zeros(1 << 16, np.uint32), 0, 0, units, slots - 1

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash's unit (0 is no hash here), or -1."""
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == h, self.number[slot], -1)
        live = np.flatnonzero((key != h) & (key != 0))
        slot = slot[live]
        while len(live):
            slot = slot + 1 & self.mask
            key = self.keys[slot]
            hit = key == h[live]
            out[live[hit]] = self.number[slot[hit]]
            on = ~hit & (key != 0)
            live, slot = live[on], slot[on]
        return out

    def add(self, h: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Distinct units that are not in the table, with all their ids one after another."""
        at = self.used + np.cumsum(n) - n
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.ids[self.used:self.used + len(ids)] = ids
        number = np.arange(self.units, self.units + len(h), dtype=np.int32)
        self.at[number], self.n[number] = at, n
        self.used, self.units = self.used + len(ids), self.units + len(h)
        live, slot = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(live):
            free = np.flatnonzero(self.keys[slot] == 0)
            place, first = np.unique(slot[free], return_index=True)  # one unit to a free slot
            who = live[free[first]]
            self.keys[place], self.number[place] = h[who], number[who]
            on = self.keys[slot] != h[live]
            live, slot = live[on], slot[on] + 1 & self.mask


#: The pre-tokens of the public vocabulary file; :meth:`_Encoder.units` cuts plain words as this pattern does.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Kinds of bytes in plain words: letters (those of U+00C0 to U+00FF have two bytes), digits, others; 0: between words.
_LETTER, _DIGIT, _OTHER = 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[32, *range(9, 14)]] = 0
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
#: Bytes that no plain word has: controls, the apostrophe (it begins some pre-tokens) and bytes of other characters.
_STRANGE = np.ones(256, bool)
_STRANGE[[32, *range(9, 14), *range(33, 39), *range(40, 127), *range(128, 192), 0xC3]] = False


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs, one run after another."""
    upto = np.cumsum(size)
    return np.repeat(begin - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


def _lower(data: np.ndarray) -> np.ndarray:
    """Bytes of plain words, those of ASCII in lower case already: the letters of U+00C0 to U+00DE in lower case."""
    if (data > 127).any():
        data[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 32
    return data


class _Encoder:
    """Ids of texts from those of their words or, in plain words, their pre-tokens ("units"), kept by the units'
    hashes. A Python worker serves many tasks; vocabulary and ids stay with it, in a module of their own."""

    def __init__(self, path: str | None):
        import sys
        from types import ModuleType
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        kept = sys.modules.setdefault("sentrel_worker_state", ModuleType("sentrel_worker_state")).__dict__
        if path not in kept:
            try:
                counter = TokenCounter(path)
            except (KeyError, TypeError, ValueError):  # another kind of vocabulary: the library encodes its words
                counter = None
            kept[path] = {"counter": counter, "table": _Table()}
        self.path, self.kept = path, kept[path]
        self.counter = self.kept["counter"]
        self.plain = self.counter is not None and self.counter.pattern.pattern == PATTERN and self.counter.lower

    def units(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begins and ends of a slice's units, and which of them are single pre-tokens."""
        data, n = words.data, len(words.data)
        if not self.plain or not len(words.h) or b"<|" in data.tobytes():
            return words.begin, words.end, np.zeros(len(words.h), bool)
        kind, strange = looked_up(_KIND, data), looked_up(_STRANGE, data)
        start = np.empty(n, bool)
        start[0], start[1:] = True, (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start &= kind > 0
        start[words.begin] = True
        if (data > 127).any():
            second, lead = data >> 6 == 2, data == 0xC3
            follows = np.zeros(n, bool)
            follows[1:] = second[1:] & lead[:-1]
            follows[words.begin] = False
            strange |= second & ~follows | lead & ~np.append(follows[1:], False) | follows & ((data == 0x97) | (data == 0xB7))  # the last: two signs
        whole = np.zeros(len(words.h), bool)
        whole[np.searchsorted(words.begin, np.flatnonzero(strange), side="right") - 1] = True
        begin = np.flatnonzero(start)
        first = (np.cumsum(start) - 1)[words.begin]
        many = np.diff(np.append(first, len(begin)))
        single = ~np.repeat(whole, many)
        keep = single.copy()
        keep[first] = True
        begin, single, end = begin[keep], single[keep], np.repeat(words.end, np.where(whole, 1, many))
        end[:-1] = np.minimum(end[:-1], begin[1:])
        return begin, end, single

    def _encoded(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of units (byte ranges), and how many each has. Single pre-tokens are taken as bytes, the others as texts."""
        counter, parts, special = self.counter, [], {}
        n = single.astype(np.int64)  # pre-tokens of each unit
        for i in np.flatnonzero(~single).tolist():
            unit = data[begin[i]:end[i]].tobytes().decode("utf-8", "replace")
            if counter is None or counter.added is not None and counter.added.search(unit):
                special[i] = np.array(self._library().encode(unit, add_special_tokens=False).ids, np.uint32)
            else:
                own = counter._split(unit)
                n[i] = len(own)
                parts += [x.encode() for x in own]
        size = (end - begin)[single]
        plain = _lower(data[_runs(begin[single], size)])
        if len(plain) or parts:
            size = np.concatenate([size, np.fromiter(map(len, parts), np.int64, len(parts))])
            ids, size = counter.merges.symbols(np.concatenate([plain, np.frombuffer(b"".join(parts), np.uint8)]), size)
        else:
            ids = np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(size)])  # single ones come first
        last = np.cumsum(n)
        first, many = np.empty(len(n), np.int64), np.cumsum(single)
        first[single], first[~single] = np.arange(single.sum()), (last - n - many + single.sum())[~single]
        lo, size = upto[first], upto[first + n] - upto[first]
        ids = ids[_runs(lo, size)].astype(np.uint32)
        if special:
            cut = np.concatenate([[0], np.cumsum(size)])
            ids = np.concatenate([special[i] if i in special else ids[cut[i]:cut[i + 1]] for i in range(len(n))])
            size[list(special)] = [len(x) for x in special.values()]
        return ids, size

    def _library(self):
        if "library" not in self.kept:
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            self.kept["library"] = Tokenizer.from_file(self.path)
        return self.kept["library"]

    def encode(self, some: list[Words]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each slice all ids, each document's followed by ``END``, and where each document begins."""
        cut = [self.units(w) for w in some]
        hashes = [np.maximum(w.hash(begin, end), 1) if len(begin) else np.zeros(0, np.uint64) for w, (begin, end, _) in zip(some, cut, strict=True)]
        table = self.kept["table"]
        found = [table.find(h) for h in hashes]
        if any((f < 0).any() for f in found):
            new = self._unknown(some, cut, hashes, [f < 0 for f in found])
            if table.units + len(new[0]) > table.room or table.used > KEPT_IDS:
                new = self._unknown(some, cut, hashes, [np.ones(len(h), bool) for h in hashes])
                table = self.kept["table"] = _Table(max(KEPT_UNITS, len(new[0])))
            table.add(new[0], *self._encoded(*new[1:]))
            found = [table.find(h) for h in hashes]
        return [self._texts(w, begin, f, table) for w, (begin, _, _), f in zip(some, cut, found, strict=True)]

    def _unknown(self, some: list[Words], cut: list, hashes: list, which: list) -> tuple[np.ndarray, ...]:
        """The distinct units among ``which``: hashes, bytes of all slices, begins and ends in them, and whether they are single pre-tokens."""
        h, base = np.concatenate([x[k] for x, k in zip(hashes, which, strict=True)]), np.cumsum([0, *[len(w.data) for w in some]])
        begin, end = (np.concatenate([c[j][k] + at for c, k, at in zip(cut, which, base)]) for j in range(2))
        single = np.concatenate([c[2][k] for c, k in zip(cut, which, strict=True)])
        h, first = np.unique(h, return_index=True)
        return h, np.concatenate([w.data for w in some]), begin[first], end[first], single[first]

    @staticmethod
    def _texts(words: Words, begin: np.ndarray, found: np.ndarray, table: _Table) -> tuple[np.ndarray, np.ndarray]:
        n = table.n[found].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat(table.at[found] - upto[:-1], n) + np.arange(upto[-1])
        docs = len(words.first) - 1
        begins = upto[np.searchsorted(begin, words.offsets)] + np.arange(docs + 1)
        out = np.full(begins[-1], END, "<u4")
        inner = np.ones(len(out), bool)
        inner[begins[1:] - 1] = False
        out[inner] = table.ids[place]
        return out, begins


def _terms(words: Words) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Each document's distinct word hashes (32 bits) and their counts, and the minimum of its mixed hashes."""
    docs = len(words.first) - 1
    key, counts = np.unique(words.doc().astype(np.uint64) << np.uint64(32) | words.h >> np.uint64(32), return_counts=True)
    cut = np.searchsorted(key, np.arange(docs + 1).astype(np.uint64) << np.uint64(32)).tolist()
    term, count = key.astype(np.uint32), counts.astype(np.uint32)
    near = np.zeros(docs, np.int64)
    full = np.flatnonzero(np.diff(words.first))
    if len(full):
        near[full] = (np.minimum.reduceat(mix(words.h ^ np.uint64(0xA5A5A5A5)), words.first[full]) >> np.uint64(1)).astype(np.int64)
    return [term[i:j].tobytes() for i, j in zip(cut, cut[1:])], [count[i:j].tobytes() for i, j in zip(cut, cut[1:])], near


def _together(column: pa.Array):
    """The documents of a column, some ``TOGETHER`` bytes at a time: first and last, and slices of them, each
    as lower-case words and as those that are encoded (a special token is told by its case)."""
    some, begin, size, powers = [], 0, 0, Powers()
    data, offsets = text_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1))
        part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        words = Words(part, at, True, powers, parts=True)
        some.append((words, Words(part, at, False, powers, parts=True) if b"<|" in part.tobytes() else words))
        size += len(part)
        lo = hi
        if size >= TOGETHER or lo == n:
            yield begin, lo, some
            some, begin, size = [], lo, 0


def _checksums(ids: np.ndarray, begins: np.ndarray, length: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """Each document's number of ids, checksums of its full windows and of its tail's prefixes."""
    data, full_crcs, tail_crcs, crc32 = memoryview(ids).cast("B"), [], [], zlib.crc32
    for i, j in zip((4 * begins).tolist(), (4 * begins[1:]).tolist()):
        full = (j - i) // (4 * length) * 4 * length
        full_crcs.append(array("I", [zlib.crc32(data[k:k + 4 * length]) for k in range(i, i + full, 4 * length)]).tobytes())
        tail, at, left = [], 0, data[i + full:j]
        for k in range(0, len(left), 4 * GRAIN):
            at = crc32(left[k:k + 4 * GRAIN], at)
            tail.append(at)
        tail_crcs.append(array("I", tail).tobytes())
    return np.diff(begins).tolist(), full_crcs, tail_crcs


def tokenized(df: DataFrame, id_col: str, text_col: str, length: int, tokenizer: str | None) -> DataFrame:
    """One row per document: its number of ids, checksums of its full windows and
    of its tail's prefixes, its words' hashes and counts, and the sort key."""
    def run(batches):
        encoder = _Encoder(tokenizer)
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, some in _together(b.column("text")):
                columns = [_checksums(*e, length) for e in encoder.encode([own for _, own in some])]
                terms = [_terms(words) for words, _ in some]
                n, full_crcs, tail_crcs = (sum((c[j] for c in columns), []) for j in range(3))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), *[pa.array(c, pa.binary()) for c in (full_crcs, tail_crcs, sum((t[0] for t in terms), []), sum((t[1] for t in terms), []))],
                     pa.array(np.concatenate([t[2] for t in terms]))],
                    names=["doc_id", "doc_tokens", "full_crcs", "tail_crcs", "terms", "counts", "near"])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, TOKENS)


def slice_crc(prefix_a: int, prefix_b: int, n_bytes: int) -> int:
    """CRC-32 of the last ``n_bytes`` of a string, from those of its prefix before them and of the whole."""
    zeros = bytes(n_bytes)
    return prefix_b ^ zlib.crc32(zeros, prefix_a) ^ zlib.crc32(zeros)


class Index:
    """BM25 inverted index of a shard's tails."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        self.n = len(terms)
        sizes = np.array([len(t) for t in terms], np.int64)
        doc = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        term = np.concatenate(terms) if self.n else np.zeros(0, np.uint32)
        tf = np.concatenate(counts).astype(np.float32) if self.n else np.zeros(0, np.float32)
        norm = np.bincount(doc, tf, self.n)
        norm = (k1 * (1 - b + b * norm / max(norm.mean(), 1e-9) if self.n else norm)).astype(np.float32)
        order = term.astype(np.uint64)  # arrays as long as the shard has terms: few at a time
        order <<= np.uint64(32)
        order |= np.arange(len(term), dtype=np.uint32)
        order.sort()
        order = order.astype(np.uint32)
        term, self.doc, tf = term[order], doc[order], tf[order]
        del doc
        first = np.append(True, term[1:] != term[:-1])[:len(term)]
        begin = np.flatnonzero(first)
        self.term, self.begin = term[begin], np.append(begin, len(term))
        del term
        df = np.diff(self.begin)
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.weight = np.repeat(idf, df)
        self.weight *= tf * np.float32(k1 + 1) / (tf + norm[self.doc])
        self.number = np.empty(len(order), np.int32)  # of each tail's terms, one tail after another
        self.number[order] = np.cumsum(first, dtype=np.int32) - 1
        self.at, self.live, self.on = np.concatenate([[0], np.cumsum(sizes)]), self.n, np.arange(self.n)
        common = np.flatnonzero(df > self.n / 4)  # their weights as rows over all tails, not as postings
        self.row = np.full(len(df), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n))
        for k, i, j in zip(range(len(common)), self.begin[common], self.begin[common + 1]):
            self.rows[k, self.doc[i:j]] = self.weight[i:j]
        self._keep(np.repeat(self.row < 0, df))

    def _keep(self, stay: np.ndarray) -> None:
        self.begin = np.concatenate([[0], np.cumsum(stay)])[self.begin]
        self.doc, self.weight = self.doc[stay], self.weight[stay]

    def drop(self, used: np.ndarray) -> None:
        """Leaves out the postings and rows of used tails; the scores of the others stay."""
        self._keep(~used[self.doc])
        self.rows, self.on = self.rows[:, ~used[self.on]], self.on[~used[self.on]]
        self.live = len(self.on)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        return self._scores(np.searchsorted(self.term, terms))

    def scores_for(self, tail: int) -> np.ndarray:
        """:meth:`scores` of a tail's own terms."""
        return self._scores(self.number[self.at[tail]:self.at[tail + 1]])

    def _scores(self, number: np.ndarray) -> np.ndarray:
        """Sums of weights (float32 values, summed in double precision, where their order hardly matters)."""
        lo = self.begin[number]
        n = self.begin[number + 1] - lo
        upto = np.cumsum(n)
        where = np.repeat(lo - (upto - n), n) + np.arange(upto[-1] if len(n) else 0)
        row = self.row[number]
        on = np.zeros(len(self.rows))
        on[row[row >= 0]] = 1
        out = np.bincount(self.doc[where], self.weight[where], self.n).astype(np.float64, copy=False)  # whole numbers if there are none
        out[self.on] += on @ self.rows
        return out


def _ranked(free: np.ndarray, left: np.ndarray, scores: np.ndarray, some: int = 64):
    """The free tails by score, then length, then number: the best are sorted first, the rest if space is left for them."""
    if len(free) > 2 * some:
        s = scores[free]
        best = s >= s[np.argpartition(s, len(s) - some)[len(s) - some]]
        parts = (free[best], free[~best])
    else:
        parts = (free,)
    for p in parts:
        yield from p[np.lexsort((p, -left[p], -scores[p]))].tolist()


def fill_windows(lengths: np.ndarray, index: Index, terms: list[np.ndarray], length: int, begins: np.ndarray | None = None, rest: list | None = None, near: float = NEAR):
    """Sequences of ``(tail, begin, n)``: all ids of all tails, each in one piece. With ``rest``, the pieces of
    sequences that are not filled, or not by tails that are like the seed (``near``), go there instead."""
    begin = np.zeros(len(lengths), np.int64) if begins is None else begins.copy()
    left = lengths.copy()
    seeds = [(-int(n), i) for i, n in enumerate(left) if n]
    heapq.heapify(seeds)
    while seeds:
        negative, seed = heapq.heappop(seeds)
        if left[seed] != -negative:
            continue  # used, or shorter by now (then it is in the heap again)
        pieces, space, like = [(seed, int(begin[seed]), int(left[seed]))], length - int(left[seed]), 0
        left[seed] = 0
        if space:
            free = np.flatnonzero(left)
            if len(free) < 0.85 * index.live:
                used = left == 0
                used[seed] = False
                index.drop(used)
            scores = index.scores_for(seed)
            for i in _ranked(free, left, scores):
                n = int(left[i]) if left[i] <= space else space // GRAIN * GRAIN
                if n:
                    pieces.append((i, int(begin[i]), n))
                    begin[i] += n
                    left[i] -= n
                    space -= n
                    like += n if scores[i] >= near * scores[seed] else 0
                    if left[i]:
                        heapq.heappush(seeds, (-int(left[i]), i))
                if space < GRAIN:
                    break
        if rest is None or space < GRAIN and 2 * like >= sum(n for *_, n in pieces[1:]):
            yield pieces
        else:
            rest += pieces


def _whole(rest: list) -> list[tuple[int, int, int]]:
    """Pieces, those that follow one another in their tail joined."""
    out = []
    for i, begin, n in sorted(rest):
        if out and out[-1][0] == i and sum(out[-1][1:]) == begin:
            out[-1] = (i, out[-1][1], out[-1][2] + n)
        else:
            out.append((i, begin, n))
    return out


def _near(terms: np.ndarray) -> int:
    """The second round's minimum hash."""
    return int(mix(terms.astype(np.uint64) ^ np.uint64(0x3C3C3C3C3C)).min() >> np.uint64(1)) if len(terms) else 0


REST = [("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("windows", pa.int64()), ("tail_crcs", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary()),
        ("begin", pa.int64()), ("n", pa.int64()), ("near", pa.int64()), ("at", pa.int64())]
#: The order of a shard's rows, and the rows of ``rest`` that go out at once.
SORTED, TOGETHER_ROWS = ["doc_id", "doc_tokens", "at", "begin"], 256
ROUND = f"{PIECES}, rest struct<{', '.join(f'{c}: {dict(int64='bigint', binary='binary')[str(t)]}' for c, t in REST)}>"


def _arrays(column: pa.Array, kind: str) -> list[np.ndarray]:
    """The packed arrays of a binary column, as views of its bytes; nulls are empty."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].tolist() if len(column) else [0]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8) if len(column) else np.zeros(0, np.uint8)
    return [data[i:j].view(kind) for i, j in zip(offsets, offsets[1:])]


def _packer(length: int, first: int, more: bool, near: float = 0):
    """Packs a shard's tails from ``begin`` on, and whole windows if ``full_crcs`` has them; with ``more``,
    what is to meet again in the next round comes in ``rest``."""
    def run(batches):
        import sys
        sys.modules.pop("sentrel_worker_state", None)  # a worker that has encoded texts needs room for a shard now
        shard = first + TaskContext.get().partitionId()
        t = [b for b in batches if b.num_rows]
        if not t:
            return
        t = pa.Table.from_batches(t)
        t = t.take(pc.sort_indices(t.select(SORTED), [(c, "ascending") for c in SORTED]))
        col = {c: t.column(c).combine_chunks() for c in t.column_names}
        col = {c: x if isinstance(x, pa.Array) else x.chunk(0) for c, x in col.items()}
        del t
        ids, total, windows = (col[c].to_pylist() for c in ("doc_id", "doc_tokens", "windows"))
        tail, terms = _arrays(col["tail_crcs"], "<u4"), _arrays(col["terms"], "<u4")
        out, sequence = [], 0
        for i, crcs in enumerate(_arrays(col["full_crcs"], "<u4")):
            for k, crc in enumerate(crcs):
                out.append((ids[i], k * length, length, int(crc), total[i], shard << 32 | sequence, 0))
                sequence += 1
        rest = [] if more else None
        index = Index(terms, _arrays(col["counts"], "<u4"))
        for pieces in fill_windows(col["n"].to_numpy(), index, terms, length, col["begin"].to_numpy(), rest, near):
            offset = 0
            for i, begin, n in pieces:
                a = int(tail[i][begin // GRAIN - 1]) if begin else 0
                crc = slice_crc(a, int(tail[i][-(-(begin + n) // GRAIN) - 1]), 4 * n)
                out.append((ids[i], windows[i] * length + begin, n, crc, total[i], shard << 32 | sequence, offset))
                offset += n
            sequence += 1
        del index
        names = [x.split()[0] for x in PIECES.split(", ")]
        columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns + [pa.nulls(len(out), pa.struct(REST))] * more, names=names + ["rest"] * more)
        again = _whole(rest or [])
        for at in range(0, len(again), TOGETHER_ROWS):
            some = again[at:at + TOGETHER_ROWS]
            which = pa.array([i for i, _, _ in some], pa.int64())
            made = {"begin": [begin for _, begin, _ in some], "n": [n for *_, n in some], "near": [_near(terms[i]) for i, _, _ in some]}
            left = pa.StructArray.from_arrays([pa.array(made[c], kind) if c in made else col[c].take(which) for c, kind in REST], fields=[pa.field(c, kind) for c, kind in REST])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64())] * len(names) + [left], names=names + ["rest"])

    return run


def packed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, tokenizer: str | None = None,
           shard_tokens: int = 3_000_000) -> DataFrame:
    """One row per piece (columns of ``PIECES``). ``tokenizer``: path of a tokenizer file; by default the public one."""
    spark = df.sparkSession
    with arrow_bytes(spark):
        docs = written(tokenized(df, id_col, text_col, length, tokenizer), "tokens")
    total = docs.agg(F.sum(F.col("doc_tokens") % length)).first()[0] or 0
    shards = max(1, math.ceil(total / shard_tokens))
    rows = docs.withColumns({"windows": F.floor(F.col("doc_tokens") / length), "begin": F.lit(0).cast("bigint"), "n": F.col("doc_tokens") % length,
                             "at": F.monotonically_increasing_id()})
    dealt = lambda t, n: t.repartitionByRange(n, "near", "doc_id", "at")
    out = []
    for number, near in enumerate((NEAR, 0)):  # like tails, then all but what is left of a shard's last window
        with arrow_bytes(spark):
            made = written(dealt(rows, shards).mapInArrow(_packer(length, number * SECOND, True, near), ROUND), "round")
        out.append(made.where("rest is null").drop("rest"))
        rows = made.where("rest is not null").select("rest.*").withColumn("full_crcs", F.lit(b""))
        shards = max(1, math.ceil((rows.agg(F.sum("n")).first()[0] or 0) / shard_tokens))
    return out[0].union(out[1]).union(dealt(rows, shards).mapInArrow(_packer(length, SECOND + SECOND // 2, False), PIECES))
