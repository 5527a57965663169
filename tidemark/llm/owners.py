"""Which hashes occur often, counted exactly at the owners of hash ranges and told by filters of fixed size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.shingles import mix


@dataclass(frozen=True)
class Ranges:
    #: Owners (a power of two); with 32 bits of value each, hashes are told apart by ``owner_bits`` + 32 bits.
    owner_bits: int = 8
    #: Size of a filter in bits (a power of two).
    filter_bits: int = 26
    #: Hashes a task holds before it sends them.
    held: int = 1_000_000

    def address(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owner, and 32-bit value within its range, of spread hashes."""
        owner = g >> np.uint64(64 - self.owner_bits)
        return owner.astype(np.int64), ((g >> np.uint64(32 - self.owner_bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def spots(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two bits of the owner's part of the filter."""
        m, mask = mix(value.astype(np.uint64)), np.uint64((1 << (self.filter_bits - self.owner_bits)) - 1)
        return (m & mask).astype(np.int64), ((m >> np.uint64(32)) & mask).astype(np.int64)

    def often(self, bits: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Whether each hash occurs so often as a filter says: never wrong if it does, seldom if it doesn't."""
        owner, value = self.address(spread(g))
        first, second = self.spots(value)
        test = lambda at: (bits[owner, at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (test(first) & test(second)).astype(bool)


def spread(g: np.ndarray) -> np.ndarray:
    """Hashes mixed anew: they may come chosen for being small, and all owners are to have as many."""
    return mix(g ^ np.uint64(0xA0761D6478BD642F))


def packed(parts: list[np.ndarray], ranges: Ranges) -> pa.RecordBatch:
    """One row per owner: its values seen once here, those seen more often, and how often."""
    g, n = np.unique(spread(np.concatenate(parts)), return_counts=True)
    owner, value = ranges.address(g)
    rows = []
    for k in np.unique(owner):
        at = slice(*np.searchsorted(owner, [k, k + 1]))
        v, c = value[at], n[at]
        rows.append((int(k), v[c == 1].tobytes(), v[c > 1].tobytes(), c[c > 1].astype(np.uint32).tobytes()))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["owner", "once", "more", "times"])


def frequent(rows: DataFrame, hashes, least: tuple[int, ...], ranges: Ranges) -> list[np.ndarray]:
    """A filter for each of ``least``: the hashes that occur so often or more; ``hashes`` turns Arrow batches into arrays of hashes."""

    def send(batches) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for g in hashes(batches):
            parts.append(g)
            size += len(g)
            if size >= ranges.held:
                yield packed(parts, ranges)
                parts, size = [], 0
        if size:
            yield packed(parts, ranges)

    def answer(t: pa.Table) -> pa.Table:
        read = lambda c: np.frombuffer(b"".join(t[c].to_pylist()), np.uint32)
        once, more, times = read("once"), read("more"), read("times")
        value, which = np.unique(np.concatenate([once, more]), return_inverse=True)
        n = np.bincount(which, np.concatenate([np.ones(len(once)), times]))
        out = []
        for k in least:
            bits = np.zeros(1 << (ranges.filter_bits - ranges.owner_bits), bool)
            for at in ranges.spots(value[n >= k]):
                bits[at] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
        return pa.table({"owner": t["owner"][:1], "bits": pa.array([out], pa.list_(pa.binary()))})

    got = rows.mapInArrow(send, "owner int, once binary, more binary, times binary").groupBy("owner").applyInArrow(answer, "owner int, bits array<binary>").collect()
    filters = [np.zeros((1 << ranges.owner_bits, 1 << (ranges.filter_bits - ranges.owner_bits - 3)), np.uint8) for _ in least]
    for r in got:  # one row of fixed size per owner
        for f, b in zip(filters, r["bits"], strict=True):
            f[r["owner"]] = np.frombuffer(b, np.uint8)
    return filters
