"""Brute-force versions that the operators are held against."""

from __future__ import annotations

import hashlib
import random

import numpy as np

CLASHING = "value long, row string, h long, spans string, bins string, n_lines long"


def documents(spark, rows, extra=True):
    """``rows`` of (doc_id, text) as documents, with columns whose names clash with the operators' own."""
    data = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 1, "x", 2, "y", "z", 3) for i, t in rows]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    df = spark.createDataFrame(data, schema)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


EDGES = [(1, None), (2, ""), (3, " \n\n "), (4, "word"), (5, "a b c d e f g h"), (5, "a b c d e f g h"), (None, "no id here"), (6, "long " * 40_000)]


def words_of(rnd: random.Random, n: int, kinds: int = 500) -> str:
    return " ".join(f"w{rnd.randrange(kinds)}" for _ in range(n))


def groups_of(ids, linked):
    """Smallest reachable id of each."""
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def jaccard_groups(rows, n=4, percent=85):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    ids = sorted(sets)
    linked = []
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    linked.append((a, b))
    up = groups_of(ids, linked)
    return {i: (len(sets[i]), up[i]) for i in ids}


def repeats(texts, length=200):
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for r in raw:
        edge = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge)[: len(r)] > 0
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        left = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


