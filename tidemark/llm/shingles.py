"""Hashed word n-grams, a whole slice of texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Words hashed at once: bounds the arrays, however long a text is.
BLOCK_WORDS = 100_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(size, _BASE, np.uint64)
        up[0] = 1
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers spread out (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` (bytes); equal bytes have equal hashes."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _powers(size)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


def grams(words: list[bytes], n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, in order; empty with fewer words."""
    out = []
    for at in range(0, len(words) - n + 1, BLOCK_WORDS):
        part = words[at : at + BLOCK_WORDS + n - 1]
        data = np.frombuffer(b" ".join(part), np.uint8)
        gap = np.flatnonzero(data == 32)
        starts, ends = np.r_[0, gap + 1], np.r_[gap, len(data)]
        out.append(hash_ranges(data, starts[: len(starts) - n + 1], ends[n - 1 :]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def gram_lists(docs: list[list[bytes]], n: int) -> list[np.ndarray]:
    """:func:`grams` of each of many word lists, hashed together."""
    every = grams([w for d in docs for w in d], n)
    out, at = [], 0
    for d in docs:
        out.append(every[at : at + max(0, len(d) - n + 1)])
        at += len(d)
    return out
