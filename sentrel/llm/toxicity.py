"""Operator 1, toxicity by a subsequence string kernel SVM with Nyström landmarks.

Kernel: strings are compared by their gapped subsequences of three characters;
a subsequence counts ``DECAY`` for each skipped character (gaps up to ``GAPS``).
So a word with inserted characters, or spelt with dots, still shares
most subsequences with the word itself. Characters are folded to 64 classes
(letters without accents, digits, other scripts by code point); separators and
punctuation take part in no subsequence, they are only skipped.

Model: the feature space is explicit, so the Nyström model - a linear SVM on
``K_mm^-1/2 k_m(x)`` over landmark strings - folds into one weight per
subsequence: scoring a window of text is a sum of table look-ups, for any
number of landmarks. Sentences are windows of ``WINDOW`` characters at every position.

Training (bounded sample of labelled rows: ``max_rows`` per label, texts of at
most ``max_chars``, in the driver): landmarks are strings of 4 and 5
characters that tell toxic from clean texts and together cover each toxic text several
times. A text's label holds for its best window only (multiple instances), so
windows are chosen by the model and learned from in turn; windows of toxic texts
are also learned with inserted characters. The two best separate windows of a text
give its score by a logistic fit on the same rows.

Defined results: null or empty texts have no windows and get the score of a text
whose windows are all at the lowest margin. With labels of one kind only, every
score is 0 or 1 accordingly; without labels 0. Labels that repeat for an id count
by their maximum. Only the named columns are read.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.llm.shared import SLICE_BYTES, text_of, written

DECAY = 0.6
GAPS = ((1, 1), (1, 2), (2, 1), (2, 2), (1, 3), (3, 1))
WINDOW = 8
PAD = 16
FLOOR = -2.0
BEST = 2  # separate windows that make a text's score
TRAIN_SLICE = 1_000_000
LETTERS = 37  # classes 1 to 36 are a to z and 0 to 9


def _classes() -> np.ndarray:
    """Class of each code point below 0x250; 0 separates, 63 is punctuation."""
    out = np.full(0x250, 63, np.uint8)
    out[:33] = 0
    for cp in range(0x250):
        base = unicodedata.normalize("NFD", chr(cp).lower())[0]
        if "a" <= base <= "z":
            out[cp] = ord(base) - 96
        elif "0" <= base <= "9":
            out[cp] = ord(base) - 48 + 27
        elif base.isalpha():
            out[cp] = LETTERS + cp % 26
    return out


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of the texts, each followed by ``PAD`` separators, and where they begin."""
    table = _classes()
    sizes = np.array([0, *[len(t or "") + PAD for t in texts]], np.int64)
    cp = np.frombuffer(("".join([(t or "") + "\n" * PAD for t in texts])).encode("utf-32-le", "surrogatepass"), "<u4")
    high = cp >= len(table)
    codes = table[np.where(high, 0, cp)]
    codes[high] = LETTERS + cp[high] % 26
    return codes, np.cumsum(sizes)


def margins(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Kernel part of the decision for the window at each position."""
    n = len(codes)
    c = np.concatenate([codes, np.zeros(PAD, np.uint8)]).astype(np.int32)
    first, second = c << 12, c << 6
    local = np.zeros(n, np.float32)
    for a, b in GAPS:
        at = first[:n] + second[a:a + n] + c[a + b:a + b + n]
        local += np.float32(DECAY ** (a + b - 2)) * weights[at]
    sums = np.concatenate([[0.0], np.cumsum(local, dtype=np.float64)])
    last = np.minimum(np.arange(n) + WINDOW, n)
    return sums[last] - sums[:n]


def best_windows(codes: np.ndarray, begin: np.ndarray, weights: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Margins (texts x count) and positions of each text's best windows that do not overlap."""
    m = np.concatenate([margins(codes, weights), [-np.inf]])
    texts = len(begin) - 1
    best, where = np.full((texts, count), FLOOR), np.zeros((texts, count), np.int64)
    for k in range(count):
        top = np.maximum.reduceat(m, begin[:-1]) if texts else np.zeros(0)
        owner = np.repeat(np.arange(texts), np.diff(begin))
        hits = np.flatnonzero(m[:-1] == top[owner])
        who, first = np.unique(owner[hits], return_index=True)
        where[who, k] = hits[first]
        best[:, k] = np.maximum(top, FLOOR)
        for d in range(-WINDOW + 1, WINDOW):
            at = where[:, k] + d
            at = at[(at >= begin[:-1]) & (at < begin[1:])]
            m[at] = -np.inf
    return best, where


def best_windows_by_slice(codes: np.ndarray, begin: np.ndarray, weights: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`best_windows`, some ``TRAIN_SLICE`` characters at a time (the driver trains in bounded memory)."""
    best, where, lo = [], [], 0
    while lo < len(begin) - 1:
        hi = max(lo + 1, int(np.searchsorted(begin, begin[lo] + TRAIN_SLICE, side="right")) - 1)
        b, w = best_windows(codes[begin[lo]:begin[hi]], begin[lo:hi + 1] - begin[lo], weights, count)
        best.append(b)
        where.append(w + begin[lo])
        lo = hi
    return np.concatenate(best), np.concatenate(where)


def _subsequences(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of the gapped subsequences that begin in the first ``WINDOW`` places of ``s``."""
    c = np.concatenate([s, np.zeros(PAD, np.uint8)]).astype(np.int32)
    i = np.arange(min(WINDOW, len(s)))
    parts = [(c[i], c[i + a], c[i + a + b], DECAY ** (a + b - 2)) for a, b in GAPS]
    code = np.concatenate([x << 12 | y << 6 | z for x, y, z, _ in parts])
    value = np.concatenate([np.full(len(i), w) for *_, w in parts])
    good = np.concatenate([(x > 0) & (x < 63) & (y > 0) & (y < 63) & (z > 0) & (z < 63) for x, y, z, _ in parts])
    return code[good], value[good]


class Nystrom:
    """Features ``K_mm^-1/2 k_m(x)`` over landmark strings (arrays of classes)."""

    def __init__(self, landmarks: list[np.ndarray]):
        subs = [_subsequences(s) for s in landmarks]
        self.codes = np.unique(np.concatenate([c for c, _ in subs]))
        phi = np.zeros((len(landmarks), len(self.codes)))
        for row, (c, v) in zip(phi, subs, strict=True):
            np.add.at(row, np.searchsorted(self.codes, c), v)
        self.phi = phi / np.sqrt((phi ** 2).sum(1, keepdims=True))
        value, vec = np.linalg.eigh(self.phi @ self.phi.T)
        keep = value > 1e-6 * value.max()
        self.root = vec[:, keep] / np.sqrt(value[keep])

    def features(self, windows: list[np.ndarray], step: int = 500) -> np.ndarray:
        out = []
        for lo in range(0, len(windows), step):
            x = np.zeros((len(windows[lo:lo + step]), len(self.codes)))
            for row, s in zip(x, windows[lo:lo + step], strict=True):
                c, v = _subsequences(s)
                at = np.minimum(np.searchsorted(self.codes, c), len(self.codes) - 1)
                np.add.at(row, at[self.codes[at] == c], v[self.codes[at] == c])
            out.append((x @ self.phi.T) @ self.root)
        return np.concatenate(out)

    def fold(self, w: np.ndarray) -> np.ndarray:
        """The linear model ``w`` on the features as a weight per subsequence."""
        out = np.zeros(64 ** 3, np.float32)
        out[self.codes] = (self.root @ w) @ self.phi
        return out


def svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; y in -1, 1, both sides weighing the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = c * np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)) * len(y) / 2
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        on = y * (x @ w) < 1
        xs = x[on] * weight[on, None]
        new = np.linalg.solve(ridge + xs.T @ x[on], xs.T @ y[on])
        if np.abs(new - w).max() < 1e-9:
            break
        w = 0.5 * (w + new) if _ > 15 else new
    return w[:-1], float(w[-1])


def _grams(codes: np.ndarray) -> np.ndarray:
    c = codes.astype(np.int64)
    letter = (c > 0) & (c < 63)
    out = []
    for k in (4, 5):
        n = len(c) - k + 1
        if n > 0:
            good, g = np.ones(n, bool), np.full(n, k, np.int64)
            for j in range(k):
                good &= letter[j:j + n]
                g = g << 6 | c[j:j + n]
            out.append(g[good])
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def choose_landmarks(codes: np.ndarray, begin: np.ndarray, toxic: np.ndarray, most: int, cover: int = 14) -> list[np.ndarray]:
    """Strings that tell toxic texts, chosen such that each toxic text has ``cover`` of them if it can."""
    texts = [codes[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
    grams = [_grams(x) for x, y in zip(texts, toxic, strict=True) if y]
    cand, t = np.unique(np.concatenate(grams), return_counts=True)
    cand, t = cand[t >= 2], t[t >= 2]
    if not len(cand):
        return []
    c = np.zeros(len(cand))
    for x, y in zip(texts, toxic, strict=True):
        if not y and len(g := _grams(x)):
            at = np.minimum(np.searchsorted(g, cand), len(g) - 1)
            c += g[at] == cand
    pos, neg = toxic.sum(), (~toxic).sum()
    odds = np.log((t + 0.5) / (pos - t + 0.5)) - np.log((c + 0.5) / (neg - c + 0.5))
    z = odds / np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    z[odds < 2.5] = 0  # a string that toxic texts hold rather more often is no evidence
    top = np.sort(np.argsort(-z, kind="stable")[:4000])
    top = top[z[top] > 2]
    cand, odds = cand[top], odds[top]
    has = np.zeros((int(pos), len(cand)), bool)
    for row, g in zip(has, grams, strict=True):
        at = np.minimum(np.searchsorted(g, cand), max(len(g) - 1, 0))
        if len(g):
            row[:] = g[at] == cand
    need, picked = np.full(int(pos), cover), []
    for _ in range(most):
        gain = ((need > 0) @ has) * odds ** 2
        if not len(gain) or gain.max() <= 0 or ((need > 0) & has[:, gain.argmax()]).sum() < 2:
            break
        best = int(gain.argmax())
        picked.append(best)
        need -= has[:, best]
        has[:, best] = False
    out = []
    for g in cand[picked]:
        k = 4 if g >> 24 == 4 else 5
        out.append(np.array([g >> 6 * (k - 1 - j) & 63 for j in range(k)], np.uint8))
    return out


def fit(texts: list[str], labels: list[int], landmarks: int = 256, rounds: int = 4, seed: int = 7) -> dict:
    """The model as plain arrays: ``weights`` (per subsequence), ``bias``, ``logit`` (of the best margins)."""
    toxic = np.array(labels, bool)
    if toxic.all() or not toxic.any():
        return {"constant": float(toxic.all() and len(toxic) > 0)}
    rng = np.random.default_rng(seed)
    codes, begin = encode(texts)
    strings = choose_landmarks(codes, begin, toxic, landmarks * 3 // 4)
    some = np.unique(rng.integers(0, max(len(codes) - 5, 1), landmarks))
    negatives = [codes[i:i + 5] for i in some[(codes[some] > 0) & (codes[some] < 63)][:landmarks // 4]]
    strings = [s for s in strings + negatives if len(_subsequences(s)[0])]
    if not strings:
        return {"constant": float(toxic.mean())}
    padded = codes  # every text ends with separators
    model = Nystrom(strings)
    weights = np.zeros(64 ** 3, np.float32)
    n_pos = len(strings) - len(negatives)
    first = model.phi[:max(n_pos, 1)].sum(0)
    weights[model.codes] = first / max(first.max(), 1e-9)
    bad = np.zeros(0, np.int64)
    for _ in range(rounds):
        _, at = best_windows_by_slice(codes, begin, weights, 3)
        good, new = at[toxic][:, :2].ravel(), at[~toxic].ravel()
        bad = np.unique(np.concatenate([bad, new, rng.choice(len(codes), min(len(codes), 2000))]))
        plain = [padded[i:i + WINDOW + 4] for i in good]
        spread = [np.insert(s, np.arange(1, len(s)), 63)[:WINDOW + 4] for s in plain[::4]]
        shifted = [np.insert(s, int(rng.integers(1, 5)), int(rng.integers(1, 27)))[:WINDOW + 4] for s in plain[::3]]
        x = model.features(plain + spread + shifted + [padded[i:i + WINDOW + 4] for i in bad])
        y = np.ones(len(x))
        y[len(x) - len(bad):] = -1
        w, bias = svm(x, y)
        weights = model.fold(w)
    best, _ = best_windows_by_slice(codes, begin, weights, BEST)
    return {"weights": weights, "bias": bias, "logit": _logistic(best + bias, toxic)}


def _design(best: np.ndarray) -> np.ndarray:
    return np.column_stack([np.clip(best, FLOOR, 3.0), np.ones(len(best))])


def _logistic(best: np.ndarray, toxic: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x, y = _design(best), toxic.astype(float)
    weight = np.where(toxic, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_texts(texts: list[str | None], model: dict) -> np.ndarray:
    if "constant" in model or not texts:
        return np.full(len(texts), model.get("constant", 0.0))
    codes, begin = encode(texts)
    best, _ = best_windows(codes, begin, model["weights"], BEST)
    return 1 / (1 + np.exp(-_design(best + model["bias"]) @ model["logit"]))


def held_out(id_col: str, of: int = 3) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == 1, F.lit(False))


def training_rows(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int, max_chars: int) -> list:
    """At most ``max_rows`` labelled rows of either label that are not held out, by a hash of their id."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
             .groupBy("_id").agg(F.max("_y").alias("_y")).where(~held_out("_id")).withColumn("_h", F.xxhash64("_id", F.lit(11))))
    chosen = [known.where(F.col("_y") == y).orderBy("_h", "_id").limit(max_rows) for y in (0, 1)]
    chosen = written(chosen[0].union(chosen[1]), "chosen")
    rows = df.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).where(F.length("_text") <= max_chars)
    return rows.join(F.broadcast(chosen), "_id").select("_id", "_text", "_y").orderBy("_id", "_text").collect()


def _scores(texts: list[str | None], model: dict) -> np.ndarray:
    """Scores of a batch, some ``SLICE_BYTES`` characters at a time."""
    out, at, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t or "") + PAD
        if size >= SLICE_BYTES or i == len(texts) - 1:
            out.append(score_texts(texts[at:i + 1], model))
            at, size = i + 1, 0
    return np.concatenate(out) if out else np.zeros(0)


def score(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row, from its text alone."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # one weight per subsequence: 1 MB

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_scores(b.column("text").to_pylist(), shared.value))], names=["doc_id", "score"])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, score double")


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
               max_rows: int = 2_000, max_chars: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """``df`` without the rows whose score reaches ``threshold``, all columns kept."""
    rows = training_rows(df, labels, id_col, text_col, label_col, max_rows, max_chars)
    shared = df.sparkSession.sparkContext.broadcast(fit([r["_text"] for r in rows], [r["_y"] for r in rows]))
    place = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = [None if x is None else str(x) for x in b.column(place).to_pylist()]
            yield b.filter(pa.array(_scores(texts, shared.value) < threshold))

    return df.mapInArrow(run, df.schema)


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             max_rows: int = 2_000, max_chars: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    rows = training_rows(df, labels, id_col, text_col, label_col, max_rows, max_chars)
    model = fit([r["_text"] for r in rows], [r["_y"] for r in rows])
    return score(df, model, id_col, text_col).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                                     (F.col("score") >= threshold).cast("int").alias("predicted"))
