"""Windows that report before they close.

* :func:`early_mean` -- a keyed tumbling mean that, once a window holds more
  than ``min_rows`` rows, also reports the mean after every further row, and
  reports once more when the window ends (count trigger + end-of-window timer,
  fire-and-purge at the end).
* :func:`evicting_mean` -- a keyed tumbling window that reports the mean of its
  contents every ``every`` rows and then evicts the rows strictly below that
  mean; at window end it reports the mean of what is left plus the rows that
  came after the last report.

``early_mean`` is a running mean per (key, window) -- a prefix scan plus one
partial aggregate.  The evicting window is path dependent (what is evicted
depends on everything evicted before), so it is an ordered fold: rows are
hash-partitioned by (key, window), sorted by ``seq`` inside each partition (an
external sort that spills), and folded group by group in ``mapInArrow``.  The
fold streams: its memory is the surviving buffer of the current group, never
the whole group or partition, and a report costs the logarithm of that buffer.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.prefix import DEFAULT_BLOCK, running
from tidemark.operators.tumbling import WE, WS, mean_of, valued, with_window


def early_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    seq: str,
    size: str | int | dt.timedelta,
    min_rows: int = 3,
    exact_scale: int | None = None,
    block: int | None = DEFAULT_BLOCK,
) -> DataFrame:
    """Rows ``(keys, window_start, window_end, firing, at_seq, n, mean)``.

    ``firing = 'early'``: one row per input row that is the ``n``-th of its
    window with ``n > min_rows``; mean of the first ``n`` rows.
    ``firing = 'final'``: one row per window, mean of all its rows,
    ``at_seq`` = its last ``seq``.  Rows with a null value never enter a window.
    """
    gk = [*keys, WS, WE]
    x = with_window(df.filter(valued(df, value).isNotNull()), ts, size)
    v = F.col(value) if exact_scale is None else F.col(value).cast(f"decimal(18,{exact_scale})")
    run = running(
        x.select(*gk, seq, v.alias("__v")),
        seq,
        {"__sum": ("sum", F.col("__v")), "n": ("sum", F.lit(1).cast("long"))},
        keys=gk,
        block=block,
    )
    early = run.filter(F.col("n") > min_rows).select(
        *gk,
        F.lit("early").alias("firing"),
        F.col(seq).cast("long").alias("at_seq"),
        "n",
        mean_of(F.col("__sum"), F.col("n")).alias("mean"),
    )
    # A window's last running row is its final one; rows are dealt by key and window already.
    final = run.groupBy(*gk).agg(F.max_by("__sum", "n").alias("__sum"), F.max("n").alias("n"), F.max(seq).alias("at_seq")).select(
        *gk,
        F.lit("final").alias("firing"),
        F.col("at_seq").cast("long").alias("at_seq"),
        "n",
        mean_of(F.col("__sum"), F.col("n")).alias("mean"),
    )
    return early.unionByName(final)


#: What stays after a report: rows at or above its mean, only those above it, or those at or below it.
KEEP = ("at_least_mean", "above_mean", "at_most_mean")


class EvictingBuffer:
    """The rows a window still holds: their exact sum and a heap with the next to go on top.

    A report costs the logarithm of the buffer per row added or evicted, never a
    pass over it.  With ``scale`` values are summed as integers at that many
    decimals; without it every double is an exact multiple of 2**-1074, so the
    sum is exact too and the mean is rounded once, whatever the order of rows.
    ``keep`` (one of ``KEEP``) says which rows stay after a report.
    """

    def __init__(self, scale: int | None, values: Iterable[float] = (), keep: str = KEEP[0]):
        if keep not in KEEP:
            raise ValueError(f"keep must be one of {KEEP}, got {keep!r}")
        self.unit = None if scale is None else 10**scale
        self.sign = -1 if keep == "at_most_mean" else 1
        self.ties_go = keep == "above_mean"
        self.heap: list[float] = []
        self.total = 0
        for v in values:
            self.add(v)

    def __len__(self) -> int:
        return len(self.heap)

    def values(self) -> list[float]:
        return [self.sign * v for v in self.heap]

    def _exact(self, v: float) -> int:
        if self.unit is not None:
            return round(v * self.unit)
        top, bottom = v.as_integer_ratio()  # bottom is a power of two
        return top << (1074 - bottom.bit_length() + 1)

    def add(self, v: float) -> None:
        heapq.heappush(self.heap, self.sign * v)
        self.total += self._exact(v)

    def mean(self) -> float:
        if self.unit is not None:
            return (self.total / self.unit) / len(self.heap)
        return self.total / (len(self.heap) << 1074)

    def evict(self, m: float) -> int:
        """Let the rows go that don't stay after a report of mean ``m``; how many went."""
        n, m = len(self.heap), self.sign * m
        while self.heap and (self.heap[0] < m or self.ties_go and self.heap[0] == m):
            self.total -= self._exact(self.sign * heapq.heappop(self.heap))
        return n - len(self.heap)


def _changes(col: pa.Array) -> np.ndarray:
    """Where a sorted key column differs from the row before (nulls equal nulls, NaN equals NaN)."""
    a, b = col.slice(1), col.slice(0, len(col) - 1)
    try:
        differ = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(col.type):
            both = pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False))
            differ = pc.and_not(differ, both)
        differ = pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b)))
        return np.asarray(differ.to_numpy(zero_copy_only=False), bool)
    except pa.ArrowNotImplementedError:  # nested keys
        x = col.to_pylist()
        return np.array([p != q for p, q in zip(x[1:], x[:-1])], bool)


def _same_key(x: tuple, y: tuple) -> bool:
    return all(p == q or (p != p and q != q) for p, q in zip(x, y))


def _evicting_fold(gk: list[str], seq: str, value: str, every: int, scale: int | None, keep: str, schema: pa.Schema):
    """Build the per-partition fold for :func:`evicting_mean`.

    Arrow batches arrive sorted by (gk, seq); keys stay Arrow values, so a
    nullable or large integer key keeps its type.  State carried across batches:
    the current group key, its buffer, rows since the last report and the report
    number.
    """

    def fold(batches):
        out: list[tuple] = []
        cur, held = None, EvictingBuffer(scale, keep=keep)
        pending = firing = 0
        last_seq = None

        def emit() -> pa.RecordBatch:
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            cols = [batch.column(c) for c in gk]
            starts = np.zeros(n, bool)
            starts[0] = True
            for c in cols:
                starts[1:] |= _changes(c)
            bounds = [*np.flatnonzero(starts).tolist(), n]
            seqs, values = batch.column(seq).to_pylist(), batch.column(value).to_pylist()
            for a, b in zip(bounds[:-1], bounds[1:]):
                key = tuple(c[a].as_py() for c in cols)
                if cur is None or not _same_key(key, cur):
                    if cur is not None and held.heap:
                        out.append((*cur, firing + 1, "final", last_seq, len(held.heap), held.mean()))
                    cur, held, pending, firing = key, EvictingBuffer(scale, keep=keep), 0, 0
                for k in range(a, b):
                    held.add(values[k])
                    pending += 1
                    last_seq = seqs[k]
                    if pending == every:
                        pending, firing = 0, firing + 1
                        m = held.mean()
                        out.append((*cur, firing, "count", last_seq, len(held.heap), m))
                        held.evict(m)
                if len(out) >= 10_000:
                    yield emit()
                    out.clear()
        if cur is not None and held.heap:
            out.append((*cur, firing + 1, "final", last_seq, len(held.heap), held.mean()))
        if out:
            yield emit()

    return fold


def evicting_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    seq: str,
    size: str | int | dt.timedelta,
    every: int = 3,
    exact_scale: int | None = None,
    keep: str = KEEP[0],
) -> DataFrame:
    """Rows ``(keys, window_start, window_end, firing, kind, at_seq, n, mean)``.

    ``kind='count'``: the ``firing``-th report, made at row ``at_seq`` over the
    ``n`` rows then in the window; rows below ``mean`` are evicted after it
    (``keep``: which rows stay, one of ``KEEP``).
    ``kind='final'``: the report at window end over the ``n`` rows left.
    ``exact_scale`` sums values as integers at that many decimals (the same
    rule as the SQL oracle); otherwise the doubles' exact sum is rounded once.
    Rows with a null value or one that isn't a finite number never enter a
    window; rows with a null key form a group of their own.
    """
    EvictingBuffer(exact_scale, keep=keep)  # refuses an unknown rule here, not in a task
    gk = [*keys, WS, WE]
    finite = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value).cast("double")) < float("inf"))
    x = with_window(df.filter(finite), ts, size).select(
        *gk, F.col(seq).cast("long").alias(seq), F.col(value).cast("double").alias(value))
    schema = T.StructType(
        [x.schema[c] for c in gk]
        + [
            T.StructField("firing", T.IntegerType()),
            T.StructField("kind", T.StringType()),
            T.StructField("at_seq", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("mean", T.DoubleType()),
        ]
    )
    ordered = x.repartition(*[F.col(c) for c in gk]).sortWithinPartitions(*gk, seq)
    arrow = to_arrow_schema(schema)
    return ordered.mapInArrow(_evicting_fold(gk, seq, value, every, exact_scale, keep, arrow), schema)
