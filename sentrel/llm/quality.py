"""Operator 2, document quality by hierarchical empirical Bayes.

Evidence: a logistic model over a dozen statistics of a text (repetition of words
and pairs, shares of letters, capitals, digits, signs, word and line lengths),
fitted on a bounded sample of labelled rows (``max_rows``, by a hash of the id,
rows with crc32(id as text) mod 3 equal to 1 never), gives each document a likelihood ratio.

Hierarchy: hosts have good shares that are Beta-distributed around the global
one, paths within a host around the host's. Shares are estimated from summed
document probabilities - two grouped aggregations with map-side sums - and the two
concentrations by the method of moments from the spread between hosts and
between paths of a host, so sparse sites shrink toward their parent. A document's posterior is
its likelihood ratio times its path's odds, in which the document itself is left out.

Defined results: null and empty texts have all statistics 0. A null host or path is
a site of its own. With labels of one kind only the evidence is neutral (ratio 1) at that
kind's smoothed share; without labels at one half. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import Words, mix, slices, small, text_buffer, text_of, written
from sentrel.llm.toxicity import held_out

FEATURES = ("words", "word_length", "distinct", "top_word", "same_next", "pairs", "letters", "capitals", "digits", "signs", "lines", "distinct_lines")
_KIND = np.zeros(256, np.int64)  # 0 other, 1 letter (or a byte of one), 2 capital, 3 digit, 4 sign, 5 line feed
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
_KIND[10] = 5


def _distinct_share(keys: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct keys, and of the most frequent key, per document (0 for documents without keys)."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]))) if len(k) else np.zeros(0, np.int64)
    n = np.maximum(np.bincount(owner, minlength=docs), 1)
    top = np.zeros(docs)
    np.maximum.at(top, o[first], np.diff(np.append(first, len(k))))
    return np.bincount(o[first], minlength=docs) / n, top / n


def features(words: Words) -> np.ndarray:
    """The statistics of a slice's documents (lower-cased hashes, original bytes)."""
    docs = len(words.first) - 1
    n, size = np.diff(words.first), np.diff(words.offsets)
    owner, byte_owner = words.doc(), np.repeat(np.arange(docs), size)
    share = lambda x, of: x / np.maximum(of, 1)
    kinds = np.bincount(byte_owner * 6 + _KIND[words.data], minlength=docs * 6).reshape(docs, 6)
    distinct, top = _distinct_share(words.h, owner, docs)
    inner = owner[1:] == owner[:-1]
    pair = mix(words.h[:-1] + mix(words.h[1:]))[inner] if len(words.h) else words.h
    pairs, _ = _distinct_share(pair, owner[1:][inner] if len(words.h) else owner, docs)
    same = np.bincount(owner[1:][inner & (words.h[1:] == words.h[:-1])], minlength=docs) if len(words.h) else np.zeros(docs)
    cuts = np.flatnonzero(words.data == 10) if len(words.data) else np.zeros(0, np.int64)
    line_first = np.unique(np.concatenate([words.offsets[:-1], cuts + 1]))
    line_first = line_first[line_first < len(words.data)]
    at = np.searchsorted(words.begin, line_first)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.h, dtype=np.uint64)])
    line = sums[np.append(at[1:], len(words.h))] - sums[at] if len(at) else np.zeros(0, np.uint64)
    lines, _ = _distinct_share(line, np.searchsorted(words.offsets, line_first, side="right") - 1, docs)
    out = [np.log1p(n), share(np.bincount(owner, words.end - words.begin, docs), n), distinct, top, share(same, n), pairs,
           share(kinds[:, 1], size), share(kinds[:, 2], size), share(kinds[:, 3], size), share(kinds[:, 4], size), share(kinds[:, 5], size), lines]
    return np.column_stack(out) * (n > 0)[:, None]


def statistics(df: DataFrame, id_col: str, text_col: str, host: str, path: str) -> DataFrame:
    kept = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")]

    def run(batches):
        for b in batches:
            found = [features(_cased(words, b.column("text"), lo, hi)) for lo, hi, words in slices(b.column("text"), lower=True)]
            x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "host", "path")], pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "host", "path", "x"])

    return df.select(*kept, text_of(F.col(text_col).cast("string")).alias("text")).mapInArrow(run, "doc_id bigint, host string, path string, x array<double>")


def _cased(words: Words, column: pa.Array, lo: int, hi: int) -> Words:
    data, offsets = text_buffer(column)
    words.data = data[offsets[lo]:offsets[hi]]
    return words


def _design(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / std, -6, 6)
    return np.column_stack([z, z * z, np.ones(len(z))])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> dict:
    """Logistic model of standardised statistics and their squares, as log likelihood ratio: ``prior`` is the log odds of the sample."""
    if not len(y) or y.min() == y.max():
        return {"prior": math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), "w": None}
    mean, std = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = _design(x, mean, std)
    prior = math.log(y.mean() / (1 - y.mean()))
    w = np.zeros(z.shape[1])
    w[-1] = prior
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (y - p) - ridge * np.append(w[:-1], 0)
        h = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + ridge * np.diag(np.append(np.ones(len(w) - 1), 1e-9))
        step = np.linalg.solve(h, g)
        w += step * min(1, 3 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return {"prior": prior, "w": w, "mean": mean, "std": std}


def _evidence(model: dict):
    def run(batches):
        for b in batches:
            x = np.array(b.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
            log = np.zeros(len(x)) if model["w"] is None else np.clip(_design(x, model["mean"], model["std"]) @ model["w"], -30, 30) - model["prior"]
            p = 1 / (1 + np.exp(-(log + model["prior"])))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "host", "path")], pa.array(log), pa.array(p)], names=["doc_id", "host", "path", "evidence", "p"])
    return run


def concentration(between: float, within: float, groups: int, parents: int, rows: float, squares: float, mean: float) -> float:
    """Prior weight (in documents) by the method of moments: mean squares between and within the groups."""
    if groups <= parents or rows <= groups:
        return 100.0
    typical = max((rows - squares) / (groups - parents), 1e-9)
    spread = (between / (groups - parents) - within / (rows - groups)) / typical
    return min(max(mean * (1 - mean) / max(spread, 1e-9) - 1, 1.0), 1e6)


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str = "source", path: str = "lang",
            label_col: str = "quality", max_rows: int = 20_000, threshold: float = 0.5, max_broadcast: int = 200_000) -> DataFrame:
    """One row per document: ``doc_id, held_out, evidence`` (log likelihood ratio), ``host_rate, path_rate`` (posterior means),
    ``score`` (posterior), ``predicted`` (1: good)."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("_id is not null and y in (0, 1)")
             .groupBy("_id").agg(F.max("y").alias("y")).where(~held_out("_id")).orderBy(F.xxhash64("_id", F.lit(13)), "_id").limit(max_rows))
    known = written(known, "known")
    stats = written(statistics(df, id_col, text_col, host, path), "statistics")
    sample = stats.join(F.broadcast(known), stats["doc_id"] == known["_id"]).select("doc_id", "x", "y").orderBy("doc_id").collect()  # max_rows
    model = fit(np.array([r["x"] for r in sample]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in sample], float))
    docs = written(stats.mapInArrow(_evidence(model), "doc_id bigint, host string, path string, evidence double, p double"), "evidence")

    paths = docs.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q"))
    paths = written(paths, "paths")
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"),
                                              F.sum(F.col("n") * F.col("n")).alias("squares"), F.count(F.lit(1)).alias("paths")), "hosts")
    rate, within = F.col("hs") / F.col("hn"), F.col("hq") - F.col("hs") * F.col("hs") / F.col("hn")
    t = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.count(F.lit(1)).alias("k"), F.sum(F.col("hn") * F.col("hn")).alias("sq"),
                  F.sum(F.col("hn") * rate * rate).alias("r2"), F.sum(within).alias("within"), F.sum(F.col("squares") / F.col("hn")).alias("psq"), F.sum("paths").alias("p")).first()
    n, mean = t["n"] or 0.0, (t["s"] + 0.5) / (t["n"] + 1) if t["n"] else 0.5
    host_weight = concentration((t["r2"] or 0) - n * ((t["s"] or 0) / max(n, 1)) ** 2, t["within"] or 0, t["k"], 1, n, (t["sq"] or 0) / max(n, 1), mean)
    u = paths.agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("r2"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within")).first()
    path_weight = concentration((u["r2"] or 0) - (t["r2"] or 0), u["within"] or 0, t["p"] or 0, t["k"], n, t["psq"] or 0, mean)

    host_rate = (F.col("hs") + host_weight * mean) / (F.col("hn") + host_weight)
    sites = paths.join(small(hosts.select(F.col("host").alias("_host"), host_rate.alias("host_rate")), max_broadcast), F.col("host").eqNullSafe(F.col("_host")))
    sites = small(written(sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "s", "host_rate"), "sites"), max_broadcast)
    out = docs.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    rate = (F.col("s") + path_weight * F.col("host_rate")) / (F.col("n") + path_weight)
    others = (F.col("s") - F.col("p") + path_weight * F.col("host_rate")) / (F.col("n") - 1 + path_weight)
    others = F.greatest(F.least(others, F.lit(1 - 1e-6)), F.lit(1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(others / (1 - others)))))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "evidence", "host_rate", rate.alias("path_rate"), score.alias("score"),
                      (score >= threshold).cast("int").alias("predicted"))
