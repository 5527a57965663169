"""Tumbling event-time windows: mean, extremes, members.

All windows are epoch-aligned and half-open, keyed or global (``keys=()``).
A window is just one more grouping column, so Spark runs partial (map-side)
aggregation and shuffles once on (keys, window).  A global window is spread
over as many tasks as there are windows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timecols import floor_div, window_bounds
from tidemark.operators.prefix import running

WS, WE = "window_start", "window_end"


def window_cols(df: DataFrame, ts: str, size: str | int | dt.timedelta) -> tuple[Column, Column]:
    """``window_start`` / ``window_end`` columns; ``ts`` is a timestamp or epoch ms."""
    t = F.col(ts)
    if isinstance(df.schema[ts].dataType, (T.LongType, T.IntegerType)):
        t = F.timestamp_millis(t)
    start, end = window_bounds(t, size)
    return start.alias(WS), end.alias(WE)


def with_window(df: DataFrame, ts: str, size: str | int | dt.timedelta) -> DataFrame:
    """Add ``window_start`` / ``window_end``."""
    return df.select("*", *window_cols(df, ts, size))


def exact_mean(value: str | Column, scale: int | None) -> tuple[Column, Column]:
    """(sum, count) -> mean, optionally summed exactly at a decimal scale.

    Doubles summed in different orders differ in the last bits; when the
    values have at most ``scale`` decimals, summing them as decimals and
    dividing once makes every engine and every partitioning agree.
    """
    v = F.col(value) if isinstance(value, str) else value
    if scale is None:
        return F.sum(v), F.count(v)
    return F.sum(v.cast(f"decimal(18,{scale})")), F.count(v)


def valued(df: DataFrame, value: str) -> Column:
    """``value``, null where it is no number: NaN counts as no value, in batch and in streams alike."""
    c = F.col(value)
    return F.when(~F.isnan(c), c) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else c


def mean_of(total: Column, n: Column) -> Column:
    return total.cast("double") / n


def tumbling_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    size: str | int | dt.timedelta,
    exact_scale: int | None = None,
) -> DataFrame:
    """Per (keys, window): ``n`` and ``mean`` of ``value``.

    The incremental (create/add/merge/finish) accumulator of the original is
    exactly Spark's partial + final aggregation of sum and count.
    """
    total, n = exact_mean(valued(df, value), exact_scale)
    return (
        with_window(df, ts, size)
        .groupBy(*keys, WS, WE)
        .agg(n.alias("n"), total.alias("__sum"))
        .select(*keys, WS, WE, "n", mean_of(F.col("__sum"), F.col("n")).alias("mean"))
    )


def tumbling_agg(df: DataFrame, keys: Sequence[str], ts: str, size: str | int | dt.timedelta, **aggs: Column) -> DataFrame:
    """Per (keys, window): any built-in aggregates, ``name=aggregate``.

    The open form of an aggregate function over a window (create, add, merge,
    finish): every Spark aggregate already is one, computed partially before the
    only shuffle.  Rows without a time are in no window.
    """
    if not aggs:
        raise ValueError("tumbling_agg needs at least one aggregate")
    return with_window(df, ts, size).groupBy(*keys, WS, WE).agg(*[a.alias(n) for n, a in aggs.items()])


def tumbling_extremes(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    seq: str,
    size: str | int | dt.timedelta,
    payload: Sequence[str] = (),
) -> DataFrame:
    """Per (keys, window): the row with the highest and the lowest ``value``.

    Ties go to the first arrival (smallest ``seq``), as with the strict
    comparison of the original: the highest is ``max(value, -seq)``, the lowest
    ``min(value, seq)``.  Both are single-pass partial aggregates.  Rows without
    a value (null or NaN) are members, counted in ``n``, but never an extreme; a
    window without any value has null extremes.
    """
    hi, lo, highest, lowest = _extremes(df, value, seq, payload)
    return (
        with_window(df, ts, size)
        .groupBy(*keys, WS, WE)
        .agg(F.count(F.lit(1)).alias("n"), F.max(hi).alias("__hi"), F.min(lo).alias("__lo"))
        .select(*keys, WS, WE, "n", highest.alias("highest"), lowest.alias("lowest"))
    )


def _extremes(df: DataFrame, value: str, seq: str, payload: Sequence[str]) -> tuple[Column, Column, Column, Column]:
    """What to take the max and the min of, and the records in ``__hi`` and ``__lo``."""
    v = valued(df, value)
    first, last = (-F.col(seq)).alias("o"), F.col(seq).alias("o")
    if payload:
        rec = [F.struct(*[F.col(c) for c in (seq, value, *payload)]).alias("r")]
        highest, lowest = F.col("__hi.r"), F.col("__lo.r")
    else:  # (value, seq) already is the record: keep the aggregated struct small
        rec = []
        highest = F.when(F.col("__hi").isNotNull(), F.struct((-F.col("__hi.o")).alias(seq), F.col("__hi.v").alias(value)))
        lowest = F.when(F.col("__lo").isNotNull(), F.struct(F.col("__lo.o").alias(seq), F.col("__lo.v").alias(value)))
    of = lambda o: F.when(v.isNotNull(), F.struct(v.alias("v"), o, *rec))
    return of(first), of(last), highest, lowest


def _ranked(x: DataFrame, keys: Sequence[str], seq: str, part_rows: int, block: int | None) -> DataFrame:
    """``x`` with ``part``: its rows' numbers within their window, ``part_rows`` to a part."""
    n = running(x, seq, {"__rank": ("sum", F.lit(1).cast("long"))}, keys=[*keys, WS, WE], block=block)
    return n.withColumn("part", floor_div(F.col("__rank") - 1, part_rows)).drop("__rank")


def tumbling_members(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    size: str | int | dt.timedelta,
    cols: Sequence[str] = (),
    part_rows: int = 1 << 16,
    block: int | None = None,
) -> DataFrame:
    """Members of each window, in ``seq`` order, as arrays of bounded size.

    A window's member list is cut after every ``part_rows`` members, counted in
    ``seq`` order: one output row per (keys, window, part) with ``members``
    sorted by ``seq``.  Concatenating the parts in ``part`` order gives the full
    list.  A member's place in its window is a running count
    (:func:`tidemark.operators.prefix.running`), so a window holding a third of
    all rows is spread over many tasks and never built in one piece, and parts
    are full however sparse ``seq`` is.
    """
    member = F.struct(*[F.col(c) for c in (seq, *cols)])
    x = with_window(df, ts, size).select(*dict.fromkeys([*keys, WS, WE, seq, *cols]))
    return (
        _ranked(x, keys, seq, part_rows, block)
        .groupBy(*keys, WS, WE, "part")
        .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(member)).alias("members"))
    )


def window_report(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    seq: str,
    size: str | int | dt.timedelta,
    cols: Sequence[str] = (),
    part_rows: int = 1 << 16,
    block: int | None = None,
) -> DataFrame:
    """Per (keys, window): the highest and the lowest row and all members, in one result.

    One row per part of at most ``part_rows`` members in ``seq`` order (see
    :func:`tumbling_members`); every part carries its window's extremes
    (``highest``, ``lowest``: records of ``seq``, ``value`` and ``cols``, rules of
    :func:`tumbling_extremes`), the window's number of members ``n_window`` and
    its own ``n``.  The extremes of parts are combined without the members, at a
    row a part, and go back to the parts one to one, so no window passes
    through one task however many members it has.
    """
    fields = list(dict.fromkeys([seq, value, *cols]))
    member = F.struct(*[F.col(c) for c in fields])
    x = with_window(df, ts, size).select(*dict.fromkeys([*keys, WS, WE, *fields]))
    hi, lo, highest, lowest = _extremes(df, value, seq, fields[2:])
    gk = [*keys, WS, WE]
    ranked = _ranked(x, keys, seq, part_rows, block)
    few = ranked.groupBy(*gk, "part").agg(F.count(F.lit(1)).alias("n"), F.max(hi).alias("__hi"), F.min(lo).alias("__lo"))
    window = Window.partitionBy(*gk)
    few = few.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate([*gk, "part"])], "n", F.sum("n").over(window).alias("n_window"),
        F.max("__hi").over(window).alias("__hi"), F.min("__lo").over(window).alias("__lo"))
    members = ranked.groupBy(*gk, "part").agg(F.sort_array(F.collect_list(member)).alias("members"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate([*gk, "part"])])
    return members.join(few, same).select(*gk, "part", "n", "n_window", highest.alias("highest"), lowest.alias("lowest"), "members")
