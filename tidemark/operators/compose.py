"""Combining and routing streams: union, predicate routing, latest-control join.

* :func:`union_all` -- same-typed inputs, duplicates kept (``UNION ALL``).
* :func:`route` / :func:`select_route` -- ordered (tag, predicate) rules give
  every record the list of tags it satisfies; one output per tag is a filter.
* :func:`connect_latest` -- subject records labelled against the most recent
  value of a control stream, in arrival (``seq``) order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.prefix import DEFAULT_BLOCK, ScanSpec


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (no exchange, no dedup)."""
    if not dfs:
        raise ValueError("union_all needs at least one input")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def route(
    df: DataFrame,
    rules: Sequence[tuple[str, Column]],
    default: str | None = None,
    name: str = "routes",
) -> DataFrame:
    """Add ``name``: array of the tags whose predicate holds, in rule order.

    A null predicate counts as false.  Rows that match no rule get
    ``[default]`` when a default is given, else an empty array.
    """
    tags = F.array(*[F.when(pred, F.lit(tag)) for tag, pred in rules])
    hit = F.filter(tags, lambda t: t.isNotNull())
    if default is not None:
        hit = F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit(default)))
    return df.withColumn(name, hit)


def route_one(df: DataFrame, rules: Sequence[tuple[str, Column]], default: str, name: str = "route") -> DataFrame:
    """Single-tag fast path: the first matching rule wins (a plain CASE WHEN)."""
    expr = reduce(lambda acc, rule: acc.when(rule[1], F.lit(rule[0])), rules[1:],
                  F.when(rules[0][1], F.lit(rules[0][0]))).otherwise(F.lit(default))
    return df.withColumn(name, expr)


def select_route(df: DataFrame, tag: str, name: str = "routes") -> DataFrame:
    """The output stream of one tag."""
    return df.filter(F.array_contains(F.col(name), tag))


def explode_routes(df: DataFrame, name: str = "routes", as_name: str = "route") -> DataFrame:
    """One row per (record, tag): all outputs as one labelled stream."""
    return df.withColumn(as_name, F.explode(F.col(name))).drop(name)


# The three labels of the pass-mark example.
PASS_LABELS = ("pass", "not pass", "change passing score")


def threshold_label(value: Column, threshold: Column, labels: tuple[str, str] = PASS_LABELS[:2]) -> Column:
    """``value >= threshold`` -> first label, else the second."""
    return F.when(value >= threshold, F.lit(labels[0])).otherwise(F.lit(labels[1]))


def connect_latest_spec(
    subject: DataFrame,
    control: DataFrame,
    seq: str,
    value: str,
    control_value: str,
    initial: float,
    labels: tuple[str, str, str] = PASS_LABELS,
    keys: Sequence[str] = (),
) -> ScanSpec:
    keys = list(keys)
    s = subject.select(
        *keys,
        F.col(seq).alias("__seq"),
        F.struct(*[F.col(c) for c in subject.columns]).alias("subject"),
        F.lit(None).cast("double").alias("__ctl"),
        F.lit(False).alias("__is_ctl"),
    )
    c = control.select(
        *keys,
        F.col(seq).alias("__seq"),
        F.lit(None).cast(s.schema["subject"].dataType).alias("subject"),
        F.col(control_value).cast("double").alias("__ctl"),
        F.lit(True).alias("__is_ctl"),
    )
    ctl_seq = F.when(F.col("__ctl").isNotNull(), F.col("__seq"))

    def finish(scanned: DataFrame) -> DataFrame:
        threshold = F.coalesce(F.col("__latest"), F.lit(float(initial)))
        label = F.when(F.col("__is_ctl"), F.lit(labels[2])).otherwise(
            threshold_label(F.col(f"subject.{value}"), threshold, labels[:2])
        )
        return scanned.select(
            *keys, F.col("__seq").alias(seq), "subject", threshold.alias("threshold"), label.alias("label")
        )

    return ScanSpec(s.unionByName(c), "__seq", {"__latest": ("max_by", F.col("__ctl"), ctl_seq)}, keys,
                    finish=finish)


def connect_latest(
    subject: DataFrame,
    control: DataFrame,
    seq: str,
    value: str,
    control_value: str,
    initial: float,
    labels: tuple[str, str, str] = PASS_LABELS,
    block: int | None = DEFAULT_BLOCK,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Label each subject row against the latest control value before it.

    ``subject`` and ``control`` share the arrival order ``seq``.  Output, one
    row per input row of either side, in the shape of the original
    (subject record, threshold, label):

    * subject rows: ``subject`` struct, the threshold in force, ``labels[0]``
      if ``value >= threshold`` else ``labels[1]``;
    * control rows: null ``subject``, the new threshold, ``labels[2]``
      (a control row without a value leaves the threshold as it is).

    "Latest control value" is a running ``max_by(value, seq)`` over control
    rows -- associative, so it runs as a prefix scan over blocks of ``seq``
    rather than as one global ordered task.  With ``keys`` (columns present on
    both sides) each key has its own control value, like
    ``last(value, ignorenulls) over (partition by key order by seq)``; output
    then starts with the key columns.
    """
    return connect_latest_spec(subject, control, seq, value, control_value, initial, labels, keys).run(block)
