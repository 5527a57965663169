"""Running (prefix) aggregates that do not put a whole key in one task.

A plain running frame, ``Window.partitionBy(key).orderBy(seq)``, sends every
row of a key to one task.  With two sexes or five event types -- or one key
that holds a third of all rows -- that is one task for most of the data.

The prefix scan cuts heavy keys into blocks of about equal *row count*:

1. :func:`plan_blocks` counts rows per key.  Keys of no more rows than a block
   aims at stay whole: a plain frame is all they need.  For the others (at most
   ``rows / block`` keys, so their list can be broadcast) split points are taken
   from approximate quantiles of ``seq``, however unevenly it is spread.
2. A row's block is found by binary search among the split points; beyond 256
   blocks in two steps (256 ranges, each with split points of its own).
3. Each (heavy key, block) is reduced to one partial value (map-side combine).
4. The block table is scanned in two levels: ranges of 256 blocks, then blocks
   inside a range, so no task sees more than about the square root of the blocks.
5. What comes before a block is unioned in as its first row, and a running
   frame inside each (key, block) finishes the job.  No join back, so the big
   side is shuffled exactly once (by key, block).

The split points are values that the driver holds (at most 65,536 of them), as
Spark's own range partitioning does, so every pass and every recomputed task
cuts alike.  Where the cuts lie never changes an exact result (integers,
decimals, max, min); sums of doubles may differ in their last bits.

Only associative, commutative reductions qualify: ``sum``, ``max``, ``min``,
``xor`` (of longs) and ``max_by`` (value of the row with the largest ordering;
the ordering must be unique, e.g. ``seq``).  Arg-max, latest value and counts
are expressed through them.  All keep primitive aggregation buffers when their
inputs are primitive, so Spark hash-aggregates the block table.  The result
equals the plain running frame whenever ``seq`` is unique within a key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a block aims at, unless a caller says otherwise; beyond 2**32 rows the square root of the row count.
BLOCK_ROWS = 1 << 16
DEFAULT_BLOCK: int | None = None
#: Blocks of one level: a range of ``seq`` has so many, and there are so many ranges.
FAN = 256
#: Quantiles asked for at a level, four a block so that blocks are even, and their relative accuracy.
_FRACTIONS = f"array({', '.join(f'{k / (4 * FAN)}D' for k in range(1, 4 * FAN))})"
_ACCURACY = 40 * FAN

_KINDS = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor, "max_by": None}

_BLK = "__blk"
_SUP = "__sup"
_ORD = "__carry_last"
_HEAVY = "__heavy"
_WHOLE = -1  # block of a key that is not cut
_FIRST_BLOCK = -(FAN + 1)  # block of a carry from earlier input: before all others, and in a range of its own


def target_rows(rows: int, block: int | None) -> int:
    """Rows that a block aims at."""
    return max(1, int(block)) if block else max(BLOCK_ROWS, math.isqrt(rows))


def _even(points: Sequence, blocks: int) -> list[int]:
    """``blocks - 1`` of the quantiles, evenly chosen, each once."""
    n = len(points) + 1
    return sorted({int(points[max(1, round(j * n / blocks)) - 1]) for j in range(1, blocks)})


def _search(points: Column, steps: int, seq: Column) -> Column:
    """How many of the sorted ``points`` lie at or below ``seq``, by binary search (null points: 0)."""
    sizes = F.array(*[F.lit(1 << k) for k in reversed(range(steps))])
    at = lambda p, s: (p + s <= F.size(points)) & (F.get(points, p + s - 1) <= seq)
    return F.aggregate(sizes, F.lit(0), lambda p, s: F.when(at(p, s), p + s).otherwise(p))


def _longs(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' if v > -(1 << 63) else f'(-{(1 << 63) - 1}L - 1L)' for v in values)})").cast("array<bigint>")


@dataclass
class Blocks:
    """How the rows of a scan are cut: split points of ``seq``, and the keys that are cut at all."""

    keys: list[str]
    seq: str
    #: Split points between ranges, and inside each range; both empty where nothing is cut.
    ranges: list[int] = field(default_factory=list)
    inner: list[list[int]] = field(default_factory=list)
    #: The keys that are cut (None: all rows are, there are no keys).
    heavy: DataFrame | None = None

    @property
    def cut(self) -> bool:
        return bool(self.ranges or self.inner)

    def flag(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__heavy``: whether a row's key is cut (nulls are a key like others)."""
        if not self.keys:
            return df.withColumn(_HEAVY, F.lit(True))
        names = {k: f"__k{i}" for i, k in enumerate(self.keys)}
        few = F.broadcast(self.heavy.select(*[F.col(k).alias(n) for k, n in names.items()], F.lit(True).alias(_HEAVY)))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        return df.join(few, same, "left").drop(*names.values()).withColumn(_HEAVY, F.coalesce(_HEAVY, F.lit(False)))

    def tag(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__blk``, the number of its block, or -1 for rows of a key that stays whole."""
        if not self.cut:
            return df.withColumn(_BLK, F.lit(_WHOLE))
        x, s = self.flag(df), F.col(self.seq).cast("long")
        steps = max(1, len(self.ranges).bit_length())
        at = _search(_longs(self.ranges), steps, s) if self.ranges else F.lit(0)
        if not self.inner:
            block = at
        else:
            x = x.withColumn("__at", at)
            points = df.sparkSession.createDataFrame([(i, p) for i, p in enumerate(self.inner)], "__range int, __points array<long>")
            x = x.join(F.broadcast(points), F.col("__at") == F.col("__range"), "left")
            block = F.col("__at") * F.lit(FAN) + _search(F.col("__points"), max(len(p) for p in self.inner).bit_length() or 1, s)
        tagged = x.withColumn(_BLK, F.when(F.col(_HEAVY), F.coalesce(block, F.lit(0))).otherwise(F.lit(_WHOLE)))
        return tagged.drop(_HEAVY, "__at", "__range", "__points")


def plan_blocks(df: DataFrame, keys: Sequence[str], seq: str, block: int | None = DEFAULT_BLOCK) -> Blocks:
    """Count rows per key and choose the split points: narrow aggregates of the key and ``seq`` columns.

    One job where no key is heavy, one more for the quantiles, and one more
    beyond ``256`` blocks.  What comes to the driver are counts and split points.
    """
    keys, out = list(keys), Blocks(list(keys), seq)
    s = F.col(seq).cast("long")
    quantiles = F.percentile_approx(s, F.expr(_FRACTIONS), F.lit(_ACCURACY)).alias("q")
    rows = df
    if keys:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        total, largest = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.coalesce(F.max("__n"), F.lit(0))).first()
        aim = target_rows(total, block)
        if largest <= aim:
            return out
        out.heavy = counts.filter(F.col("__n") > aim).select(*keys)
        rows = out.flag(df).filter(_HEAVY).drop(_HEAVY)
        n, points = rows.agg(F.count(F.lit(1)), quantiles).first()
    else:
        n, points = rows.agg(F.count(F.lit(1)), quantiles).first()
        aim = target_rows(n, block)
    blocks = -(-n // aim)
    if blocks <= 1 or not points:
        return out
    if blocks <= FAN:
        out.ranges = _even(points, blocks)
        return out
    out.ranges = _even(points, FAN)
    per = min(FAN, -(-blocks // FAN))
    at = _search(_longs(out.ranges), len(out.ranges).bit_length(), s)
    inner = {r["r"]: r["q"] for r in rows.groupBy(at.alias("r")).agg(quantiles).collect()}
    out.inner = [_even(inner[i], per) if inner.get(i) else [] for i in range(len(out.ranges) + 1)]
    return out


class _Agg:
    """One running aggregate: its input columns and how to combine them."""

    def __init__(self, name: str, spec: tuple):
        kind = spec[0]
        if kind not in _KINDS:
            raise ValueError(f"{name}: kind must be one of {sorted(_KINDS)}, got {kind!r}")
        self.name, self.kind = name, kind
        if kind == "max_by":
            self.cols = [f"__in_{name}_v", f"__in_{name}_o"]
            self.inputs = dict(zip(self.cols, spec[1:3]))
        else:
            self.cols = [f"__in_{name}"]
            self.inputs = {self.cols[0]: spec[1]}

    def combine(self, over=None) -> list[Column]:
        """Partial results of the same aggregate merged (as group or window aggregate)."""
        w = (lambda c: c.over(over)) if over is not None else (lambda c: c)
        if self.kind == "max_by":
            v, o = self.cols
            return [w(F.max_by(v, o)).alias(v), w(F.max(o)).alias(o)]
        c = self.cols[0]
        return [w(_KINDS[self.kind](c)).alias(c)]

    def result(self, over) -> Column:
        return self.combine(over)[0].alias(self.name)


def _prepare(df: DataFrame, aggs: dict):
    steps = [_Agg(name, spec) for name, spec in aggs.items()]
    inputs = [expr.alias(c) for st in steps for c, expr in st.inputs.items()]
    return steps, df.select("*", *inputs)


def _before(totals: DataFrame, keys: list[str], steps: list[_Agg]) -> DataFrame:
    """``keys, __blk`` and the aggregates of all blocks before each, by ranges of blocks and blocks in a range."""
    in_cols = [c for st in steps for c in st.cols]
    merged = lambda over=None: [e for st in steps for e in st.combine(over)]
    t = totals.select(*keys, _BLK, *in_cols, F.floor(F.col(_BLK) / FAN).cast("int").alias(_SUP), F.lit(True).alias(_ORD))
    ranges = t.groupBy(*keys, _SUP).agg(*merged())
    earlier = Window.partitionBy(*keys).orderBy(_SUP).rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.select(*keys, F.lit(None).cast("int").alias(_BLK), *merged(earlier), _SUP, F.lit(False).alias(_ORD))
    inside = Window.partitionBy(*keys, _SUP).orderBy(_ORD, _BLK).rowsBetween(Window.unboundedPreceding, -1)
    return t.unionByName(first).select(*keys, _BLK, _ORD, *merged(inside)).filter(_ORD).drop(_ORD)


def running(
    df: DataFrame,
    seq: str,
    aggs: dict[str, tuple],
    keys: Sequence[str] = (),
    block: int | None = DEFAULT_BLOCK,
    exclusive: bool = False,
    carry: DataFrame | None = None,
    ties: Sequence[str] = (),
    blocks: Blocks | None = None,
) -> DataFrame:
    """Add one running-aggregate column per entry of ``aggs``.

    ``aggs`` maps output name -> (kind, input expression) with kind in
    ``sum``/``max``/``min``/``xor``, or -> ("max_by", value, ordering).  The frame
    runs over rows of the same ``keys`` in ``seq`` order, from the first row to the
    current one (``exclusive=False``) or to the one before it
    (``exclusive=True``, null on the first row).

    ``block`` is the number of rows a block aims at (None: from the row count);
    ``blocks`` a cut made before by :func:`plan_blocks`.  Rows of equal ``seq``
    are ordered by ``ties``, or in no defined order.

    ``carry`` (from :func:`running_totals` over earlier rows, same ``aggs``)
    is folded in ahead of every key's first row -- how a stream continues a
    scan from one micro-batch to the next.
    """
    keys = list(keys)
    base_cols = df.columns
    cuts = plan_blocks(df, keys, seq, block) if blocks is None else blocks
    steps, x = _prepare(df, aggs)
    in_cols = [c for st in steps for c in st.cols]
    x = cuts.tag(x)

    first_rows = []  # what comes before a (key, block), as an extra first row of it
    if carry is not None:
        earlier = carry.select(*keys, *in_cols)
        if cuts.cut:
            flagged = cuts.flag(earlier)
            first_rows.append(flagged.filter(~F.col(_HEAVY)).drop(_HEAVY).withColumn(_BLK, F.lit(_WHOLE)))
            earlier = flagged.filter(_HEAVY).drop(_HEAVY).withColumn(_BLK, F.lit(_FIRST_BLOCK))
        else:
            first_rows.append(earlier.withColumn(_BLK, F.lit(_WHOLE)))
    if cuts.cut:
        # Only keys that are cut have rows in the block table.
        totals = x.filter(F.col(_BLK) != _WHOLE).groupBy(*keys, _BLK).agg(*[e for st in steps for e in st.combine()])
        if carry is not None:
            totals = totals.unionByName(earlier)
        first_rows.append(_before(totals, keys, steps))

    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in base_cols if c not in keys]
    both = x.select(*keys, _BLK, *in_cols, *rest, F.lit(True).alias(_ORD))
    for rows in first_rows:
        both = both.unionByName(rows.select(*keys, _BLK, *in_cols, *[F.lit(None).cast(types[c]).alias(c) for c in rest], F.lit(False).alias(_ORD)))

    upto = -1 if exclusive else Window.currentRow
    parts = [*keys, _BLK] if cuts.cut else keys  # uncut rows: a frame of each key, whatever is already dealt by key stays
    order = [_ORD, seq] if first_rows else [seq]
    frame = Window.partitionBy(*parts).orderBy(*order, *ties).rowsBetween(Window.unboundedPreceding, upto)
    out = both.select(*base_cols, _ORD, *[st.result(frame) for st in steps])
    if first_rows:
        out = out.filter(_ORD)
    return out.select(*base_cols, *[st.name for st in steps])


def running_totals(
    df: DataFrame,
    seq: str,
    aggs: dict[str, tuple],
    keys: Sequence[str] = (),
    carry: DataFrame | None = None,
) -> DataFrame:
    """Per key, the aggregates over all of ``df`` (plus ``carry``): the carry
    for whatever comes after ``df``.  One row per key, internal column names."""
    keys = list(keys)
    steps, x = _prepare(df, aggs)
    in_cols = [c for st in steps for c in st.cols]
    part = x.groupBy(*keys).agg(*[e for st in steps for e in st.combine()])
    if carry is not None:
        part = part.unionByName(carry.select(*keys, *in_cols))
    return part.groupBy(*keys).agg(*[e for st in steps for e in st.combine()])


@dataclass
class ScanSpec:
    """A prefix-scan operator as data: rows to scan, aggregates, and the
    projection that turns running aggregates into the operator's output.

    The batch operator is ``spec.run(block)``; the same spec drives the
    micro-batch stream form (:func:`tidemark.streaming.scan.stream_scan`).
    """

    frame: DataFrame
    seq: str
    aggs: dict[str, tuple]
    keys: list[str] = field(default_factory=list)
    exclusive: bool = False
    finish: Callable[[DataFrame], DataFrame] = lambda d: d

    def run(self, block: int | None = DEFAULT_BLOCK, carry: DataFrame | None = None,
            frame: DataFrame | None = None, materialize: bool = False):
        """The operator's output.  ``materialize`` checkpoints the input first
        (:func:`tidemark.session.materialize`), so an expensive input plan is
        computed once although the scan reads it more than once."""
        src = self.frame if frame is None else frame
        if materialize:
            from tidemark.session import materialize as _materialize

            src = _materialize(src)
        return self.finish(running(src, self.seq, self.aggs, self.keys, block, self.exclusive, carry))

    def totals(self, frame: DataFrame, carry: DataFrame | None = None) -> DataFrame:
        return running_totals(frame, self.seq, self.aggs, self.keys, carry)


def running_plain(
    df: DataFrame,
    seq: str,
    aggs: dict[str, tuple],
    keys: Sequence[str] = (),
    exclusive: bool = False,
) -> DataFrame:
    """Reference form: one running frame per key.  Used by tests as the
    brute-force check of :func:`running`, and fine when keys are many and small."""
    upto = -1 if exclusive else Window.currentRow
    frame = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, upto)
    cols = []
    for name, spec in aggs.items():
        if spec[0] == "max_by":
            cols.append(F.max_by(spec[1], spec[2]).over(frame).alias(name))
        else:
            cols.append(_KINDS[spec[0]](spec[1]).over(frame).alias(name))
    return df.select(*df.columns, *cols)
