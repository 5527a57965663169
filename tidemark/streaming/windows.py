"""Streaming forms of the windowed operators and the interval join.

Native Structured Streaming throughout: ``withWatermark`` + ``groupBy(window)``
in append mode (a window is emitted once, when the watermark passes its end),
and the stream-stream inner join whose state is bounded by the watermarks and
the range predicate.

Watermark semantics differ from the original in two documented ways:

1. The original closes a window when the watermark reaches ``end - 1 ms``;
   Spark when it reaches ``end``.  ``close_at_last_instant=True`` shortens the
   delay by 1 ms so both close at the same input (needs a delay >= 1 ms).
2. Spark advances the watermark once per micro-batch, not per record, so which
   late rows are dropped depends on batch boundaries.  For a deterministic
   per-record answer use :func:`tidemark.operators.lateness.classify_late`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import duration_us, event_time, floor_div, interval, spark_duration
from tidemark.operators.tumbling import WE, WS, _extremes, exact_mean, mean_of, valued

ET = "event_time"


def watermarked(
    df: DataFrame,
    ts: str,
    delay: str | int | dt.timedelta = 0,
    close_at_last_instant: bool = False,
) -> DataFrame:
    """Add ``event_time`` (TIMESTAMP) from ``ts`` and a watermark on it."""
    d = duration_us(delay)
    if close_at_last_instant:
        if d < 1_000:
            raise ValueError("closing at end - 1 ms needs a delay of at least 1 ms")
        d -= 1_000
    return df.withColumn(ET, event_time(df, ts)).withWatermark(ET, f"{d} microseconds")


def stream_tumbling_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    size: str | int | dt.timedelta,
    delay: str | int | dt.timedelta = 0,
    exact_scale: int | None = None,
    close_at_last_instant: bool = False,
) -> DataFrame:
    """Append-mode ``(keys, window_start, window_end, n, mean)``."""
    total, n = exact_mean(valued(df, value), exact_scale)
    w = watermarked(df, ts, delay, close_at_last_instant)
    return (
        w.groupBy(*keys, F.window(F.col(ET), spark_duration(size)).alias("__w"))
        .agg(n.alias("n"), total.alias("__sum"))
        .select(*keys, F.col("__w.start").alias(WS), F.col("__w.end").alias(WE), "n",
                mean_of(F.col("__sum"), F.col("n")).alias("mean"))
    )


def stream_tumbling_extremes(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    seq: str,
    size: str | int | dt.timedelta,
    payload: Sequence[str] = (),
    delay: str | int | dt.timedelta = 0,
    close_at_last_instant: bool = False,
) -> DataFrame:
    """Append-mode highest / lowest row per (keys, window); first arrival wins ties, null and NaN are no values."""
    hi, lo, highest, lowest = _extremes(df, value, seq, payload)
    w = watermarked(df, ts, delay, close_at_last_instant)
    return (
        w.groupBy(*keys, F.window(F.col(ET), spark_duration(size)).alias("__w"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(hi).alias("__hi"), F.min(lo).alias("__lo"))
        .select(*keys, F.col("__w.start").alias(WS), F.col("__w.end").alias(WE), "n",
                highest.alias("highest"), lowest.alias("lowest"))
    )


def stream_tumbling_members(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    size: str | int | dt.timedelta,
    cols: Sequence[str] = (),
    part_rows: int = 1 << 16,
    delay: str | int | dt.timedelta = 0,
    close_at_last_instant: bool = False,
) -> DataFrame:
    """Append-mode members of each closed window, sorted by ``seq``, in parts
    of at most ``part_rows`` members, so no state row grows with the window.  A
    stream can't number a window's members before it has seen them all, so here
    a part is a range of ``part_rows`` values of ``seq``; the parts in order are
    the batch form's list."""
    member = F.struct(*[F.col(c) for c in (seq, *cols)])
    w = watermarked(df, ts, delay, close_at_last_instant)
    return (
        w.groupBy(*keys, F.window(F.col(ET), spark_duration(size)).alias("__w"),
                  floor_div(F.col(seq), part_rows).alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), F.collect_list(member).alias("__m"))
        .select(*keys, F.col("__w.start").alias(WS), F.col("__w.end").alias(WE), "part", "n",
                F.sort_array("__m").alias("members"))
    )


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_ts: str,
    right_ts: str,
    lower: str | int | dt.timedelta,
    upper: str | int | dt.timedelta,
    residual: Column | None = None,
    left_delay: str | int | dt.timedelta = 0,
    right_delay: str | int | dt.timedelta = 0,
    bucketed: bool = True,
) -> DataFrame:
    """Stream-stream inner interval join; state is dropped as watermarks pass.

    Both inputs get a watermark on their TIMESTAMP time column
    (``left_event_time`` / ``right_event_time``); the range predicate on those
    columns lets Spark bound the join state of each side.  ``bucketed`` adds
    the time bucket of the batch form to the join key (left rows repeated for
    the buckets their interval touches, right rows in one), so one hot key is
    spread over partitions instead of one state-store partition.
    """
    lo_us, hi_us = duration_us(lower), duration_us(upper)
    lw = left.withColumn("left_event_time", event_time(left, left_ts)).withWatermark(
        "left_event_time", spark_duration(left_delay))
    rw = right.withColumn("right_event_time", event_time(right, right_ts)).withWatermark(
        "right_event_time", spark_duration(right_delay))
    cond = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("right_event_time") >= F.col("left_event_time") + interval(f"{lo_us} us"))
        & (F.col("right_event_time") <= F.col("left_event_time") + interval(f"{hi_us} us"))
    )
    if residual is not None:
        cond = cond & residual
    if not bucketed:
        return lw.join(rw, cond, "inner")
    width = max(hi_us - lo_us, 1)
    lt = F.unix_micros(F.col("left_event_time"))
    lw = lw.withColumn("__lbkt", F.explode(F.sequence(floor_div(lt + F.lit(lo_us), width),
                                                      floor_div(lt + F.lit(hi_us), width))))
    rw = rw.withColumn("__rbkt", floor_div(F.unix_micros(F.col("right_event_time")), width))
    return lw.join(rw, cond & (F.col("__lbkt") == F.col("__rbkt")), "inner").drop("__lbkt", "__rbkt")
