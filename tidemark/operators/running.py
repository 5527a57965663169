"""Per-key running results, one output row per input row.

* :func:`running_argmax` -- the rolling reduce that keeps the current leader
  (strict ``>``: the first arrival keeps the lead on ties).
* :func:`running_mean` -- mean of everything seen so far for the key (the
  keyed-state example: sum and count per key).

Both are prefix scans (:mod:`tidemark.operators.prefix`), so a key holding
most of the rows is still spread over ``rows / block`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prefix import DEFAULT_BLOCK, ScanSpec
from tidemark.operators.tumbling import mean_of, valued


def running_argmax_spec(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    payload: Sequence[str] = (),
    name: str = "leader",
) -> ScanSpec:
    v = valued(df, value)
    if payload:
        rec = F.struct(*[F.col(c) for c in (seq, value, *payload)])
        ordered = F.struct(v.alias("v"), (-F.col(seq)).alias("o"), rec.alias("r"))
        leader = F.col("__lead.r")
    else:  # (value, seq) already is the record: keep the scanned struct small
        ordered = F.struct(v.alias("v"), (-F.col(seq)).alias("o"))
        leader = F.when(F.col("__lead").isNotNull(), F.struct((-F.col("__lead.o")).alias(seq), F.col("__lead.v").alias(value)))
    ordered = F.when(v.isNotNull(), ordered)  # a row without a value (null, NaN) never leads
    out_cols = [*df.columns, leader.alias(name)]
    return ScanSpec(df, seq, {"__lead": ("max", ordered)}, list(keys), finish=lambda d: d.select(*out_cols))


def running_argmax(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    payload: Sequence[str] = (),
    block: int | None = DEFAULT_BLOCK,
    name: str = "leader",
) -> DataFrame:
    """Add ``name``: struct(seq, value, payload...) of the row with the highest
    ``value`` among rows of the key up to and including this one; null before
    the first value (null and NaN are no values)."""
    return running_argmax_spec(df, keys, seq, value, payload, name).run(block)


def running_reduce_spec(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    order: Sequence[str],
    lowest: bool = False,
    payload: Sequence[str] = (),
    name: str = "leader",
) -> ScanSpec:
    columns = list(dict.fromkeys([seq, *order, *payload]))
    rec = F.struct(*[F.col(c) for c in columns])
    turn = F.col(seq) if lowest else -F.col(seq)
    ranked = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(order)], turn.alias("o"), rec.alias("r"))
    # A row with a null (or NaN) in its order never leads (it would be the least of all).
    whole = reduce(lambda a, b: a & b, [valued(df, c).isNotNull() for c in order])
    ranked = F.when(whole, ranked)
    out_cols = [*df.columns, F.col("__lead.r").alias(name)]
    return ScanSpec(df, seq, {"__lead": ("min" if lowest else "max", ranked)}, list(keys), finish=lambda d: d.select(*out_cols))


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    order: Sequence[str],
    lowest: bool = False,
    payload: Sequence[str] = (),
    block: int | None = DEFAULT_BLOCK,
    name: str = "leader",
) -> DataFrame:
    """Add ``name``: struct(seq, order..., payload...) of the leading row so far.

    The rolling reduce with a caller's order: the row whose ``order`` columns are
    highest (or ``lowest``) among rows of the key up to this one; the first
    arrival keeps the lead on ties; null before any row could lead.
    """
    return running_reduce_spec(df, keys, seq, order, lowest, payload, name).run(block)


def running_mean_spec(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    exact_scale: int | None = None,
) -> ScanSpec:
    some = valued(df, value)
    v = some if exact_scale is None else some.cast(f"decimal(18,{exact_scale})")
    counted = F.when(some.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return ScanSpec(
        df, seq, {"__sum": ("sum", v), "n": ("sum", counted)}, list(keys),
        finish=lambda d: d.select(*df.columns, "n", mean_of(F.col("__sum"), F.col("n")).alias("mean")),
    )


def running_mean(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    exact_scale: int | None = None,
    block: int | None = DEFAULT_BLOCK,
) -> DataFrame:
    """Add ``n`` and ``mean``: count and mean of the non-null values so far
    for the key (nulls are skipped, as SQL aggregates skip them, and NaN is no value)."""
    return running_mean_spec(df, keys, seq, value, exact_scale).run(block)
