"""Explicit late-record classification against a punctuated watermark.

The watermark after each record is ``max(event time so far) - bound``.  A record
is late when, at its arrival, that watermark has already reached the last
instant of the record's window (``window_end - 1 ms``): the window was closed
and the record would be dropped.

Spark's own ``withWatermark`` moves once per micro-batch, so which rows it drops
depends on how input is cut into batches.  This operator makes the per-record
rule a deterministic column, computed in batch from the arrival order ``seq``.
The running max is a prefix scan, so no single task sees all rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import duration_us, epoch_us, floor_div, like_input
from tidemark.operators.prefix import DEFAULT_BLOCK, ScanSpec
from tidemark.operators.tumbling import WE, WS


def classify_late_spec(
    df: DataFrame,
    ts: str,
    seq: str,
    bound: str | int | dt.timedelta,
    size: str | int | dt.timedelta,
    keys: Sequence[str] = (),
) -> ScanSpec:
    bound_us = duration_us(bound)
    # Window bounds by arithmetic on the instant: F.window would drop rows without a time.
    size_us, t = duration_us(size), epoch_us(df, ts)
    start = floor_div(t, size_us) * F.lit(size_us)
    bound_at = lambda us: like_input(F.timestamp_micros(us), df, ts)
    x = df.select("*", bound_at(start).alias(WS), bound_at(start + F.lit(size_us)).alias(WE), t.alias("__t"))

    def finish(d: DataFrame) -> DataFrame:
        wm_us = F.col("__max_before") - F.lit(bound_us)
        end_us = F.unix_micros(F.col(WE).cast("timestamp"))
        return d.select(
            *df.columns,
            WS,
            WE,
            like_input(F.timestamp_micros(wm_us), df, ts).alias("wm_before"),
            F.coalesce(end_us - F.lit(1_000) <= wm_us, F.lit(False)).alias("is_late"),
        )

    return ScanSpec(x, seq, {"__max_before": ("max", F.col("__t"))}, list(keys), exclusive=True, finish=finish)


def classify_late(
    df: DataFrame,
    ts: str,
    seq: str,
    bound: str | int | dt.timedelta,
    size: str | int | dt.timedelta,
    keys: Sequence[str] = (),
    block: int | None = DEFAULT_BLOCK,
) -> DataFrame:
    """Add ``window_start``, ``window_end``, ``wm_before`` and ``is_late``, one row per input row.

    A row without a time has no window and is not late.

    ``wm_before`` is the watermark just before the record arrived (null for
    the first record); ``keys`` gives per-key watermarks (default: one stream).
    """
    return classify_late_spec(df, ts, seq, bound, size, keys).run(block)


def drop_late(
    df: DataFrame,
    ts: str,
    seq: str,
    bound: str | int | dt.timedelta,
    size: str | int | dt.timedelta,
    keys: Sequence[str] = (),
    block: int | None = DEFAULT_BLOCK,
) -> DataFrame:
    """The rows a bounded-out-of-order watermark would let into their window.

    Windowing the result with the same ``size`` gives what the original emits
    when late rows are discarded (no allowed lateness, no side output).
    """
    kept = classify_late(df, ts, seq, bound, size, keys, block).filter(~F.col("is_late"))
    return kept.select(*df.columns)
