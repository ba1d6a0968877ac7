"""Plain Python versions of the corpus operators' contracts, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    b = (text or "").encode()
    return WORD.findall(b.lower() if lower else b)


def _order(d):
    return (d is None, d or 0)


def exact(docs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    groups = collections.defaultdict(list)
    for (d, _), t in zip(docs, norm):
        groups[t].append(d)
    return [(d, min(groups[t], key=_order), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (d, _), t in zip(docs, norm)]


def held_out(d, of):
    return d is not None and zlib.crc32(str(d).encode()) % of == 1


def base_scores(docs):
    toks = [words(t, True) + [None] for _, t in docs]
    count = collections.Counter(w for (d, _), ts in zip(docs, toks) if not held_out(d, 5) for w in ts)
    n, v = sum(count.values()), len(count)
    return [(d, held_out(d, 5), len(ts), sum(count[w] > 0 for w in ts), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts))
            for (d, _), ts in zip(docs, toks)]


def model_scores(docs, levels, discount=0.75):
    """log10 of absolute discounting over quantised pair counts, with the add-half unigram below; every text begins in one context and ends in one token."""
    toks = [words(t, True) + [None] for _, t in docs]
    train = [ts for (d, _), ts in zip(docs, toks) if not held_out(d, 5)]
    count, pairs = collections.Counter(w for ts in train for w in ts), collections.Counter(p for ts in train for p in zip([None] + ts, ts))
    n, v = sum(count.values()), len(count)
    pairs = {p: max(x for x in levels if x <= c) for p, c in pairs.items()}
    kinds, mass = collections.Counter(), collections.Counter()
    for (a, _), q in pairs.items():
        kinds[a] += 1
        mass[a] += q
    rest = lambda a: min(1.0, max(1e-12, (count[a] - mass[a] + discount * kinds[a]) / count[a])) if count[a] else 1.0
    below = lambda w: (count[w] + 0.5) / (n + 0.5 * (v + 1))
    return [sum(math.log10(max(pairs.get((a, w), 0) - discount, 0) / max(count[a], 1) + rest(a) * below(w)) for a, w in zip([None] + ts, ts)) for ts in toks]


def remove_repeats(docs, k=20):
    """By the contract: a window goes if its words also start earlier (ids are distinct or rows identical)."""
    first, out = {}, {}
    for d, t in sorted(set(docs), key=lambda x: _order(x[0])):
        w = words(t)
        cover = [False] * len(w)
        for s in range(len(w) - k + 1):
            if first.setdefault(tuple(w[s:s + k]), (d, s)) != (d, s):
                cover[s:s + k] = [True] * k
        kept = [x for x, c in zip(w, cover) if not c]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def shingles(text):
    w = words(text, True)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near(docs):
    sets = [shingles(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = union(len(docs), pairs)
    least = {}
    for (d, _), r in zip(docs, root):
        least[r] = min([least[r], d], key=_order) if r in least else d
    return [(d, len(s), least[r]) for (d, _), s, r in zip(docs, sets, root)]


def targets(sizes):
    """Targets by plain resharing: ``sizes`` by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = (budget - sum(out.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2 * sizes[s] for s in over}
        free -= over
    return out
