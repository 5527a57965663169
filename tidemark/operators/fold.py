"""Rolling results by a caller's own associative function.

The running aggregates of :mod:`tidemark.operators.prefix` are Spark's own.  A
*fold* is any associative function over any state: how one row becomes a state
(``lift``), how an earlier and a later state become one (``merge``), and what a
row shows of the state it meets (``show``).  The function need not be
commutative, so rows and blocks are folded in ``seq`` order only.

* :func:`rolling_fold` -- one output per row, the state up to and including it.
* :func:`connect_fold` -- two inputs and shared state: control rows update the
  state by a function, subject rows are answered from it by another.
* :func:`keyed_process` -- any function of a key's state and its next row, where
  no associative form exists: keys run side by side, one key's rows in turn.

The first two are prefix scans: the rows of a heavy key are cut into blocks of about
equal row count, each block is folded to one state, the block states are
scanned in two levels, and every block is then folded again from the state
before it.  The folds run in Arrow batches over sorted partitions
(``mapInArrow``), so a task holds one state and one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.firing import _same_key
from tidemark.operators.prefix import _BLK, _FIRST_BLOCK, _HEAVY, _ORD, _SUP, _WHOLE, DEFAULT_BLOCK, FAN, plan_blocks

_STATE = "__state"


@dataclass(frozen=True)
class Fold:
    """An associative function over states.

    ``lift(row)`` makes a state of a row's inputs (a dict), None if the row
    leaves the state as it is; ``merge(earlier, later)`` joins two states into a
    new one; ``show(state, row)`` is what the row gives out (the state itself if
    not given; the state is None before any row made one).  ``state`` and
    ``shows`` are Spark types as text.  States are plain values: numbers,
    strings, lists, dicts for structs.
    """

    state: str
    lift: Callable[[dict], Any]
    merge: Callable[[Any, Any], Any]
    show: Callable[[Any, dict], Any] | None = None
    shows: str | None = None

    def join(self, earlier: Any, later: Any) -> Any:
        if earlier is None or later is None:
            return later if earlier is None else earlier
        return self.merge(earlier, later)


def _type(text: str) -> T.DataType:
    return T._parse_datatype_string(text)


def _rows(b: pa.RecordBatch, names: Sequence[str]) -> Iterator[dict]:
    cols = [b[n].to_pylist() for n in names]
    for values in zip(*cols, strict=True):
        yield dict(zip(names, values, strict=True))


def _ordered(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each group in one partition, in order; the sort spills, a partition is never held."""
    dealt = df.repartition(*group) if group else df.repartition(1)
    return dealt.sortWithinPartitions(*group, *order)


def _fold_groups(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Callable[[dict], Any], inputs: Sequence[str], fold: Fold) -> DataFrame:
    """One state per group: ``group, __state``."""
    schema = T.StructType([*[df.schema[g] for g in group], T.StructField(_STATE, _type(fold.state))])
    arrow, names = to_arrow_schema(schema), list(dict.fromkeys([*group, *inputs]))

    def run(batches):
        key, state, out = None, None, []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

        for b in batches:
            for row in _rows(b, names):
                k = tuple(row[g] for g in group)
                if key is None or not _same_key(k, key):
                    if key is not None:
                        out.append((*key, state))
                    key, state = k, None
                state = fold.join(state, value(row))
            if len(out) >= 1024:
                yield batch()
                out = []
        if key is not None:
            out.append((*key, state))
        yield batch()

    return _ordered(df.select(*dict.fromkeys([*names, *order])), group, order).mapInArrow(run, schema)


def _fold_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], step: Callable[[Any, dict], tuple[Any, Any]], inputs: Sequence[str],
               name: str, kind: T.DataType) -> DataFrame:
    """Every row of ``df`` with ``name``: what ``step(state, row)`` shows, the new state going on to the next row of its group."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    arrow, names = to_arrow_schema(schema), list(dict.fromkeys([*group, *inputs]))

    def run(batches):
        key, state = None, None
        for b in batches:
            shown = []
            for row in _rows(b, names):
                k = tuple(row[g] for g in group)
                if key is None or not _same_key(k, key):
                    key, state = k, None
                state, seen = step(state, row)
                shown.append(seen)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shown, arrow[-1].type)], names=arrow.names)

    return _ordered(df, group, order).mapInArrow(run, schema)


@dataclass
class FoldSpec:
    """A fold over a table as data: what to fold, by which keys, and what to make of the result.

    Runs as a batch (``run``) and, with a carry of one state a key, micro-batch
    by micro-batch (:func:`tidemark.streaming.scan.stream_scan`).
    """

    frame: DataFrame
    seq: str
    fold: Fold
    inputs: list[str]
    keys: list[str] = field(default_factory=list)
    name: str = "state"
    finish: Callable[[DataFrame], DataFrame] = lambda d: d

    def run(self, block: int | None = DEFAULT_BLOCK, carry: DataFrame | None = None, frame: DataFrame | None = None):
        src, keys, fold, inputs = self.frame if frame is None else frame, self.keys, self.fold, self.inputs
        cuts = plan_blocks(src, keys, self.seq, block)
        x = cuts.tag(src)
        earlier_of = lambda row: row[_STATE]
        firsts = []  # keys, block, the state before it
        if carry is not None:
            before = carry.select(*keys, _STATE)
            if cuts.cut:
                flagged = cuts.flag(before)
                firsts.append(flagged.filter(~F.col(_HEAVY)).withColumn(_BLK, F.lit(_WHOLE)))
                before = flagged.filter(_HEAVY).withColumn(_BLK, F.lit(_FIRST_BLOCK))
            else:
                firsts.append(before.withColumn(_BLK, F.lit(_WHOLE)))
        if cuts.cut:
            totals = _fold_groups(x.filter(F.col(_BLK) != _WHOLE), [*keys, _BLK], [self.seq], fold.lift, inputs, fold)
            if carry is not None:
                totals = totals.unionByName(before.select(*keys, _BLK, _STATE))
            totals = totals.withColumn(_SUP, F.floor(F.col(_BLK) / FAN).cast("int"))
            ranges = _fold_groups(totals, [*keys, _SUP], [_BLK], earlier_of, [_STATE], fold)
            exclusive = lambda state, row: (fold.join(state, row[_STATE]), state)
            kind = _type(fold.state)
            starts = _fold_rows(ranges, keys, [_SUP], exclusive, [_STATE], "__before", kind)
            both = totals.withColumn(_ORD, F.lit(True)).unionByName(
                starts.select(*keys, _SUP, F.col("__before").alias(_STATE), F.lit(None).cast("int").alias(_BLK), F.lit(False).alias(_ORD)))
            inside = _fold_rows(both, [*keys, _SUP], [_ORD, _BLK], exclusive, [_STATE], "__before", kind)
            firsts.append(inside.filter(_ORD).drop(_STATE).withColumnRenamed("__before", _STATE))

        cols = src.columns
        x = x.withColumn(_STATE, F.lit(None).cast(fold.state)).withColumn(_ORD, F.lit(True))
        for f in firsts:
            x = x.unionByName(f.select(*keys, _BLK, _STATE, F.lit(False).alias(_ORD)), allowMissingColumns=True)

        def step(state, row):
            if not row[_ORD]:
                return row[_STATE], None
            state = fold.join(state, fold.lift(row))
            return state, fold.show(state, row) if fold.show else state

        kind = _type(fold.shows if fold.show else fold.state)
        out = _fold_rows(x, [*keys, _BLK], [_ORD, self.seq], step, [*inputs, _ORD, _STATE], self.name, kind)
        return self.finish(out.filter(_ORD).select(*cols, self.name))

    def totals(self, frame: DataFrame, carry: DataFrame | None = None) -> DataFrame:
        """``keys, __state``: the state after all rows, the carry for what comes after them.

        Blocks of a heavy key are folded apart before the key's own fold, so this holds no key's rows in one task either.
        """
        keys, fold = self.keys, self.fold
        x = plan_blocks(frame, keys, self.seq).tag(frame)
        parts = _fold_groups(x, [*keys, _BLK], [self.seq], fold.lift, self.inputs, fold)
        if carry is not None:
            parts = parts.unionByName(carry.select(*keys, _STATE, F.lit(_FIRST_BLOCK).alias(_BLK)))
        return _fold_groups(parts, keys, [_BLK], lambda row: row[_STATE], [_STATE], fold)


def keyed_process(df: DataFrame, keys: Sequence[str], seq: str, inputs: Sequence[str], step: Callable[[Any, dict], tuple[Any, Any]],
                  result: str, name: str = "result") -> DataFrame:
    """Add ``name``: what ``step(state, row)`` shows, the state it returns going on to the key's next row in ``seq`` order.

    The keyed process function in its general form.  The state is any Python
    value, None before a key's first row; ``row`` has the ``inputs``; ``result`` is
    a Spark type as text.  Rows are dealt by key, sorted (the sort spills) and
    folded in Arrow batches, so a task holds one state and one batch, but a key's
    rows are one task: where the function is associative, use
    :func:`rolling_fold`.  Null keys are a key; ``seq`` must be unique within a key.
    """
    return _fold_rows(df, list(keys), [seq], step, list(inputs), name, _type(result))


def rolling_fold_spec(df: DataFrame, keys: Sequence[str], seq: str, inputs: Sequence[str], fold: Fold, name: str = "state") -> FoldSpec:
    return FoldSpec(df, seq, fold, list(inputs), list(keys), name)


def rolling_fold(df: DataFrame, keys: Sequence[str], seq: str, inputs: Sequence[str], fold: Fold, name: str = "state",
                 block: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Add ``name``: the fold of all rows of the key up to and including this one, in ``seq`` order.

    The rolling reduce with any associative function, e.g. the best few values so
    far or a union of intervals.  ``inputs`` are the columns the functions see.
    ``seq`` must be unique within a key; null keys are a key of their own.
    """
    return rolling_fold_spec(df, keys, seq, inputs, fold, name).run(block)


def connect_fold_spec(subject: DataFrame, control: DataFrame, seq: str, update: Fold, on_subject: Callable[[Any, dict], Any],
                      on_control: Callable[[Any, dict], Any], result: str, keys: Sequence[str] = (), name: str = "result") -> FoldSpec:
    keys = list(keys)
    side = lambda df: F.struct(*[F.col(c) for c in df.columns])
    none = lambda df: F.lit(None).cast(T.StructType(df.schema.fields))
    s = subject.select(*keys, F.col(seq).alias("__seq"), F.lit(False).alias("is_control"), side(subject).alias("subject"), none(control).alias("control"))
    c = control.select(*keys, F.col(seq).alias("__seq"), F.lit(True).alias("is_control"), none(subject).alias("subject"), side(control).alias("control"))
    lift, merge, state = update.lift, update.merge, update.state

    fold = Fold(
        state,
        lambda row: lift(row["control"]) if row["is_control"] else None,
        merge,
        lambda now, row: on_control(now, row["control"]) if row["is_control"] else on_subject(now, row["subject"]),
        result,
    )
    finish = lambda d: d.select(*keys, F.col("__seq").alias(seq), "is_control", "subject", "control", name)
    return FoldSpec(s.unionByName(c), "__seq", fold, ["is_control", "subject", "control"], keys, name, finish)


def connect_fold(subject: DataFrame, control: DataFrame, seq: str, update: Fold, on_subject: Callable[[Any, dict], Any],
                 on_control: Callable[[Any, dict], Any], result: str, keys: Sequence[str] = (), name: str = "result",
                 block: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Two typed inputs over shared state: one output per row of either, in arrival (``seq``) order.

    ``update.lift(control row)`` is the change that a control row makes and
    ``update.merge`` joins an earlier change with a later one (changes must be
    associative, e.g. "set to", "raise by", "forget"); the state is the change
    that all control rows so far amount to, None before the first.
    ``on_subject(state, row)`` and ``on_control(state, row)`` are the caller's two
    functions; both give a value of type ``result``.  ``seq`` is shared and
    unique; with ``keys`` (on both sides) each key has a state of its own.
    Output: keys, ``seq``, ``is_control``, both rows as structs (null on the other side), ``name``.
    """
    return connect_fold_spec(subject, control, seq, update, on_subject, on_control, result, keys, name).run(block)
