"""Operator 13, token counts by rank-synchronous merging of arrays.

A byte-pair vocabulary is a list of merges; its rank is a merge's place in it.
The pre-tokens of a slice of documents (each distinct one once) are one ragged
array: their symbols one after another, and the size of each sequence. A round
finds the lowest rank among the adjacent pairs of *every* sequence and merges the pairs of that
rank in all sequences at once (in a run of equal symbols every second pair, from the left); only pairs
next to a merge are looked up anew. A sequence without a mergeable pair leaves
the array, and its number of symbols is its number of tokens.

Merging all pairs of the lowest rank together is what merging them one by one
gives as long as no merge makes a symbol that takes part in a merge of lower rank
(a merge could then come before the next pair of the same rank). The few merges
of a vocabulary that do so are found when it is read, and only the first
pair of such a rank is merged in a round.

Normalisation and pre-tokens are those of the vocabulary file: the exact strings of its added tokens are cut out
first (one token each), then NFC, white space to one space and lower case where
the file says so, then its pattern. Python's Unicode tables and the tokenizer
library's differ for some code points, so a text with a character outside
``SAME`` is normalised and split by the library itself.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null id stays
null; repeated rows are counted as often as they occur; a text of any length is counted whole,
in slices (a single longer text is a slice); an empty table gives an empty
table; only the two named columns are read. Bytes that are no UTF-8 count as U+FFFD.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import text_buffer

#: Characters that Python's tables and the library's normalise and class alike: none of them combines with another.
SAME = "\x00-˿Ͱ-҂Ҋ-ԯ‐-‧‰-⁞₠-₿、-〠ぁ-ゖァ-ヺ一-龥가-힣！-～\U0001f300-\U0001f64f"

#: The split of byte-level files that name no pattern of their own (a fixed value of that file format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Text bytes of a slice, and bytes of new pre-tokens merged together.
SLICE_BYTES = 2_000_000
#: Pre-tokens up to this many characters are kept by a task, up to so many characters in all.
KEPT_LENGTH, KEPT_CHARS = 40, 8_000_000

NO_RANK = np.iinfo(np.int32).max
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def _byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(own)))
    return [out[b] for b in range(256)]


class Merges:
    """The merges of a byte-level BPE model, as arrays."""

    def __init__(self, model: dict):
        for key in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"):
            if model.get(key):
                raise ValueError(f"vocabularies with {key} are not supported")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = _byte_characters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.new = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._enter(left << 32 | right)
        used = np.full(max(vocab.values()) + 1, NO_RANK, np.int64)  # lowest rank that takes a symbol
        for side in (left, right):
            np.minimum.at(used, side, np.arange(len(pairs)))
        self.one_by_one = used[self.new] < np.arange(len(pairs))

    def _enter(self, key: np.ndarray) -> None:
        """The ranks of pairs by open addressing: a few slots each, a free one (-1) at the end of every search."""
        self.shift = np.uint64(64 - max(4, (8 * len(key)).bit_length()))
        slots = 1 << int(64 - self.shift)
        self.key, self.rank = np.full(slots, -1, np.int64), np.full(slots, NO_RANK, np.int32)
        live, slot = np.arange(len(key)), self._slot(key)
        while len(live):
            free = np.flatnonzero(self.key[slot] < 0)
            place, first = np.unique(slot[free], return_index=True)  # one pair to a free slot
            self.key[place], self.rank[place] = key[live[free[first]]], live[free[first]]
            on = self.key[slot] != key[live]
            live, slot = live[on], slot[on] + 1 & slots - 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        slot = self._slot(key)
        found = self.key[slot]
        out = self.rank[slot]
        live = np.flatnonzero(found != key)
        out[live] = NO_RANK
        live = live[found[live] >= 0]
        slot = slot[live]
        while len(live):
            slot = slot + 1 & len(self.key) - 1
            found = self.key[slot]
            hit = found == key[live]
            out[live[hit]] = self.rank[slot[hit]]
            on = ~hit & (found >= 0)
            live, slot = live[on], slot[on]
        return out

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that are left of each (non-empty) pre-token."""
        out = np.zeros(len(tokens), np.int64)
        for who, size, _, _ in self._merged(*_ragged(tokens)):
            out[who] = size
        return out

    def symbols(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left of each (non-empty) pre-token (bytes of all, and how many each has), one after another, and how many each has."""
        done = [(who, size, symbol[which]) for who, size, symbol, which in self._merged(data, size)]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        who, size, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(who)
        start, n = (np.cumsum(size) - size)[order], size[order]
        return symbol[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(len(symbol))], n

    def _merged(self, data: np.ndarray, size: np.ndarray):
        """Pre-tokens as they are done: their numbers, their numbers of symbols, all symbols, and which of these are theirs."""
        if not len(size):
            return
        symbol, end = self.first[data], np.cumsum(size) - 1
        symbol[end] = self.last[data[end]]
        rank = np.append(self.ranks(symbol[:-1], symbol[1:]), np.int32(NO_RANK))
        rank[end] = NO_RANK
        who = np.arange(len(size))
        while True:
            least = np.minimum.reduceat(rank, np.cumsum(size) - size)
            go = least < NO_RANK
            if not go.all():  # the others are done
                stay = np.repeat(go, size)
                yield who[~go], size[~go], symbol, ~stay
                symbol, rank, who, size, least = symbol[stay], rank[stay], who[go], size[go], least[go]
            if not len(who):
                return
            hit = np.flatnonzero(rank == np.repeat(least, size))
            start = np.append(True, np.diff(hit) != 1)  # pairs that overlap follow one another
            run = hit[start][np.cumsum(start) - 1]
            hit = hit[(hit - run) % 2 == 0]
            place = np.searchsorted(np.cumsum(size), hit, side="right")
            single = self.one_by_one[least[place]]
            if single.any():
                keep = ~single | np.append(True, place[1:] != place[:-1])
                hit, place = hit[keep], place[keep]
            symbol[hit] = self.new[least[place]]
            stay = np.ones(len(symbol), bool)
            stay[hit + 1] = False
            last = np.zeros(len(symbol), bool)
            last[np.cumsum(size) - 1] = True
            ends = last[hit + 1]
            symbol, rank = symbol[stay], rank[stay]
            at = hit - np.arange(len(hit))
            size = size - np.bincount(place, minlength=len(size))
            inner = at[~ends]
            rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
            rank[at[ends]] = NO_RANK
            begins = np.zeros(len(symbol), bool)
            begins[np.cumsum(size) - size] = True
            before = at[~begins[at]] - 1
            rank[before] = self.ranks(symbol[before], symbol[before + 1])


def _ragged(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of tokens, and how many each has."""
    return np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int64, len(tokens))


class TokenCounter:
    """Numbers of tokens of texts, for a ``.json`` file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.merges, self.library = path, Merges(spec["model"]), None
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens are told by their exact strings only")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        steps = _steps(spec.get("normalizer"), "normalizers")
        self.nfc, self.spaces, self.lower = (any(s["type"] == t for s in steps) for t in ("NFC", "Replace", "Lowercase"))
        if any(s["type"] not in ("NFC", "Replace", "Lowercase") or s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": r"\s+"}, " ") for s in steps):
            raise ValueError("normalisers other than NFC, white space and lower case are not supported")
        pattern = BYTE_LEVEL
        for s in _steps(spec.get("pre_tokenizer"), "pretokenizers"):
            if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and "Regex" in s["pattern"]:
                pattern = s["pattern"]["Regex"]
            elif s["type"] != "ByteLevel" or s["add_prefix_space"]:
                raise ValueError("pre-tokenizers other than one pattern and bytes are not supported")
        self.pattern = regex.compile(pattern)
        self.other = regex.compile(f"[^{SAME}]")
        self.space = regex.compile(r"\s+")
        self.known: dict[str, int] = {}
        self.chars = 0

    def _split(self, text: str) -> list[str]:
        if self.other.search(text):
            if self.library is None:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                from tokenizers import Tokenizer
                self.library = Tokenizer.from_file(self.path)
            text = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
            return [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        if self.nfc:
            text = unicodedata.normalize("NFC", text)
        if self.spaces:
            text = self.space.sub(" ", text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()  # each character by itself: no final sigma
        return self.pattern.findall(text)

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many added tokens it has."""
        if self.added is None or not self.added.search(text):
            return self._split(text), 0
        parts = self.added.split(text)
        return [t for p in parts if p for t in self._split(p)], len(parts) - 1

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.pre_tokens(t) for t in texts]
        found = set().union(*(s for s, _ in split))
        new = [t for t in found if t not in self.known]
        if self.chars + sum(map(len, new)) > KEPT_CHARS:
            self.known, self.chars, new = {}, 0, list(found)
        lo = 0
        while lo < len(new):  # some bytes of pre-tokens at a time
            hi, most = lo, SLICE_BYTES
            while hi < len(new) and (hi == lo or most > 0):
                most -= 4 * len(new[hi])
                hi += 1
            self.known.update(zip(new[lo:hi], self.merges.counts([t.encode() for t in new[lo:hi]]).tolist()))
            lo = hi
        of = self.known.__getitem__
        out = [sum(map(of, s)) + n for s, n in split]
        for t in new:
            if len(t) > KEPT_LENGTH:
                del self.known[t]
            else:
                self.chars += len(t)
        return out


def _steps(spec: dict | None, key: str) -> list[dict]:
    return [] if spec is None else spec[key] if spec["type"] == "Sequence" else [spec]


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_bytes, n_tokens``. ``tokenizer``: path of a
    byte-level BPE ``.json`` file on every executor; by default the public one."""
    def run(batches):
        path = tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        counter = TokenCounter(path)
        for b in batches:
            data, offsets = text_buffer(b.column("text"))
            lo = 0
            while lo < b.num_rows:
                hi = min(b.num_rows, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1))
                cut = offsets[lo:hi + 1].tolist()
                texts = [data[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(offsets[lo:hi + 1])), pa.array(counter.counts(texts), pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])
                lo = hi

    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, COUNTS)


def over_limit(df: DataFrame, limit: int = 2048, **kw) -> DataFrame:
    """:func:`token_counts` with ``over_limit``: more than ``limit`` tokens."""
    return token_counts(df, **kw).withColumn("over_limit", F.col("n_tokens") > limit)
