"""Stateful stream operators on ``transformWithStateInPandas``.

The batch forms of these operators are DataFrame plans (prefix scans, partial
aggregates, a sorted fold).  On a stream the same results need keyed state,
which is what these processors hold:

==========================  ==========================  ========================
operator                    grouping key                state
==========================  ==========================  ========================
running mean                user keys                   (total, n)
running arg-max             user keys                   current leader
latest control value        user keys (or one global)   threshold
early mean                  keys + window               (total, n, last seq) + timer
evicting mean               keys + window               buffer list, counters + timer
late classification         user keys (or one global)   max event time so far
==========================  ==========================  ========================

Rows of one key inside a micro-batch have no guaranteed order, so every
handler sorts by ``seq`` first.  Timers are event-time timers at
``window_end - 1 ms`` -- the instant the original closes a window -- so final
reports appear once the watermark reaches the window's last millisecond.
Sessions must set the RocksDB state store provider at start-up
(:func:`tidemark.session.get_session` does).

Python runs per key and micro-batch on Arrow batches; state lives in the
state store, so a key's history is never held in memory as a whole.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.timecols import duration_us, event_time, spark_duration
from tidemark.operators.compose import PASS_LABELS
from tidemark.operators.firing import KEEP, EvictingBuffer
from tidemark.operators.tumbling import WE, WS

ET = "event_time"


def _rows(rows: Iterator[pd.DataFrame], seq: str) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(seq, kind="stable").reset_index(drop=True)


def _valued(pdf: pd.DataFrame, value: str) -> pd.DataFrame:
    """Rows whose value is a finite number: no other enters a window, as in the batch forms.

    They are dropped here, not by a filter below: their times still move the watermark.
    """
    v = pdf[value].to_numpy(dtype="float64", na_value=np.nan)
    return pdf[np.isfinite(v)].reset_index(drop=True)


def _ms(t) -> int:
    """Window bound from a grouping key -> epoch ms (session zone is UTC)."""
    return int(pd.Timestamp(t).value // 1_000_000)


def _key_frame(key: tuple, names: Sequence[str], n: int) -> dict:
    return {name: [key[i]] * n for i, name in enumerate(names)}


def _exact(v: np.ndarray, scale: int | None) -> np.ndarray | None:
    return None if scale is None else np.rint(v * 10**scale).astype(np.int64)


# --------------------------------------------------------------------------- running mean
class RunningMeanProcessor(StatefulProcessor):
    def __init__(self, keys, seq, value, exact_scale=None):
        self.keys, self.seq, self.value, self.scale = list(keys), seq, value, exact_scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = "double" if self.scale is None else "long"
        self.acc = handle.getValueState("acc", f"total {kind}, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.seq)
        total, n0 = self.acc.get() if self.acc.exists() else (0, 0)
        v = pdf[self.value].to_numpy(dtype="float64", na_value=np.nan)
        there = ~np.isnan(v)  # nulls count for nothing, as in the batch form
        v = np.where(there, v, 0.0)
        counts = n0 + np.cumsum(there)
        if self.scale is None:
            totals = np.cumsum(np.concatenate([[float(total)], v]))[1:]
            sums, new_total = totals, float(totals[-1])
        else:
            totals = int(total) + np.cumsum(_exact(v, self.scale))
            sums, new_total = totals / 10**self.scale, int(totals[-1])
        means = pd.array([s / n if n else None for s, n in zip(sums.tolist(), counts.tolist())], dtype="Float64")
        self.acc.update((new_total, int(counts[-1])))
        out = _key_frame(key, self.keys, len(pdf))
        out.update({self.seq: pdf[self.seq].to_numpy(), "n": counts.astype("int64"), "mean": means})
        yield pd.DataFrame(out)


def stream_running_mean(df: DataFrame, keys: Sequence[str], seq: str, value: str,
                        exact_scale: int | None = None) -> DataFrame:
    """Running count and mean per key, one output row per input row."""
    schema = T.StructType([df.schema[k] for k in keys] + [
        df.schema[seq], T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        RunningMeanProcessor(keys, seq, value, exact_scale), schema, "Append", "None")


# --------------------------------------------------------------------------- running arg-max
class RunningArgMaxProcessor(StatefulProcessor):
    def __init__(self, keys, seq, value, state_ddl):
        self.keys, self.seq, self.value, self.ddl = list(keys), seq, value, state_ddl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.leader = handle.getValueState("leader", self.ddl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.seq)
        best = tuple(self.leader.get()) if self.leader.exists() else None
        lead_seq, lead_val = [], []
        for s, v in zip(pdf[self.seq].tolist(), pdf[self.value].tolist()):
            v = None if pd.isna(v) else v
            # Strict: the first arrival keeps the lead; a row without a value (null, NaN) never leads.
            if v is not None and (best is None or v > best[1]):
                best = (s, v)
            lead_seq.append(best and best[0])
            lead_val.append(best and best[1])
        if best is not None:
            self.leader.update(best)
        out = _key_frame(key, self.keys, len(pdf))
        out.update({self.seq: pdf[self.seq].to_numpy(), self.value: pdf[self.value].to_numpy(),
                    "leader_seq": pd.array(lead_seq, dtype="object"), "leader_value": pd.array(lead_val, dtype="object")})
        yield pd.DataFrame(out)


def stream_running_argmax(df: DataFrame, keys: Sequence[str], seq: str, value: str) -> DataFrame:
    """Per input row: the seq and value of the key's leader so far."""
    st, vt = df.schema[seq].dataType.simpleString(), df.schema[value].dataType.simpleString()
    schema = T.StructType([df.schema[k] for k in keys] + [
        df.schema[seq], df.schema[value],
        T.StructField("leader_seq", df.schema[seq].dataType),
        T.StructField("leader_value", df.schema[value].dataType)])
    return df.groupBy(*keys).transformWithStateInPandas(
        RunningArgMaxProcessor(keys, seq, value, f"s {st}, v {vt}"), schema, "Append", "None")


# --------------------------------------------------------------------------- latest control value
class LatestControlProcessor(StatefulProcessor):
    def __init__(self, keys, seq, value, initial, labels):
        self.keys, self.seq, self.value = list(keys), seq, value
        self.initial, self.labels = float(initial), labels

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.seq)
        mark = self.mark.get()[0] if self.mark.exists() else self.initial
        thresholds, labels = [], []
        for is_ctl, ctl, v in zip(pdf["tm_is_ctl"].tolist(), pdf["tm_ctl"].tolist(), pdf[self.value].tolist()):
            if is_ctl:  # a control row without a value leaves the mark as it is
                mark = mark if ctl is None or pd.isna(ctl) else float(ctl)
                labels.append(self.labels[2])
            else:
                labels.append(self.labels[0] if v is not None and v >= mark else self.labels[1])
            thresholds.append(mark)
        self.mark.update((mark,))
        out = pdf.drop(columns=["tm_ctl", "tm_is_ctl", "tm_grp"])
        out["threshold"] = thresholds
        out["label"] = labels
        yield out


def stream_connect_latest(subject: DataFrame, control: DataFrame, seq: str, value: str,
                          control_value: str, initial: float, labels=PASS_LABELS,
                          keys: Sequence[str] = ()) -> DataFrame:
    """Subject rows labelled against the latest control value (arrival order ``seq``).

    Without ``keys`` the control value is global, so all rows share one state
    key -- one task, as the original ran at parallelism 1.  Give ``keys`` when
    control values are per key.  Output: subject columns (null on control
    rows), ``threshold``, ``label``.
    """
    s = subject.withColumn("tm_ctl", F.lit(None).cast("double")).withColumn("tm_is_ctl", F.lit(False))
    c = control.select(*keys, seq, F.col(control_value).cast("double").alias("tm_ctl"), F.lit(True).alias("tm_is_ctl"))
    for f in subject.schema.fields:
        if f.name not in c.columns:
            c = c.withColumn(f.name, F.lit(None).cast(f.dataType))
    both = s.unionByName(c.select(*s.columns)).withColumn("tm_grp", F.lit(0))
    schema = T.StructType(list(subject.schema.fields) + [
        T.StructField("threshold", T.DoubleType()), T.StructField("label", T.StringType())])
    group = list(keys) or ["tm_grp"]
    return both.groupBy(*group).transformWithStateInPandas(
        LatestControlProcessor(keys, seq, value, initial, labels), schema, "Append", "None")


# --------------------------------------------------------------------------- early mean
class EarlyMeanProcessor(StatefulProcessor):
    def __init__(self, group, seq, value, min_rows, exact_scale):
        self.group, self.seq, self.value = list(group), seq, value
        self.min_rows, self.scale = min_rows, exact_scale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = "double" if self.scale is None else "long"
        self.acc = handle.getValueState("acc", f"total {kind}, n long, last long")

    def _mean(self, total, n):
        return float(total) / n if self.scale is None else (int(total) / 10**self.scale) / n

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _valued(_rows(rows, self.seq), self.value)
        if pdf.empty:
            return
        if self.acc.exists():
            total, n, last = self.acc.get()
        else:
            total, n, last = (0.0 if self.scale is None else 0), 0, None
            self.handle.registerTimer(_ms(key[-1]) - 1)
        v = pdf[self.value].to_numpy(dtype="float64")
        vals = v.tolist() if self.scale is None else _exact(v, self.scale).tolist()
        out = []
        for s, x in zip(pdf[self.seq].tolist(), vals):
            total, n, last = total + x, n + 1, s
            if n > self.min_rows:
                out.append((*key, "early", s, n, self._mean(total, n)))
        self.acc.update((total, n, last))
        if out:
            yield pd.DataFrame.from_records(out, columns=[*self.group, "firing", "at_seq", "n", "mean"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.acc.exists():
            total, n, last = self.acc.get()
            self.acc.clear()
            yield pd.DataFrame.from_records([(*key, "final", last, n, self._mean(total, n))],
                                            columns=[*self.group, "firing", "at_seq", "n", "mean"])


def _windowed(df: DataFrame, ts: str, size, delay) -> DataFrame:
    w = df.withColumn(ET, event_time(df, ts)).withWatermark(ET, spark_duration(delay))
    win = F.window(F.col(ET), spark_duration(size))
    return w.withColumn(WS, win.getField("start")).withColumn(WE, win.getField("end"))


def stream_early_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, seq: str,
                      size: str | int | dt.timedelta, min_rows: int = 3,
                      exact_scale: int | None = None, delay: str | int | dt.timedelta = 0) -> DataFrame:
    """Same rows as :func:`tidemark.operators.firing.early_mean`, as a stream."""
    w = _windowed(df, ts, size, delay)
    group = [*keys, WS, WE]
    schema = T.StructType([w.schema[c] for c in group] + [
        T.StructField("firing", T.StringType()), T.StructField("at_seq", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType())])
    return w.groupBy(*group).transformWithStateInPandas(
        EarlyMeanProcessor(group, seq, value, min_rows, exact_scale), schema, "Append", "EventTime")


# --------------------------------------------------------------------------- evicting mean
class EvictingMeanProcessor(StatefulProcessor):
    """Rows still held as list state; a micro-batch that evicts nothing only appends to it."""

    def __init__(self, group, seq, value, every, exact_scale, keep=KEEP[0]):
        self.group, self.seq, self.value = list(group), seq, value
        self.every, self.scale, self.keep = every, exact_scale, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", "v double")
        self.cnt = handle.getValueState("cnt", "pending int, firing int, last long")

    def _held(self) -> EvictingBuffer:
        return EvictingBuffer(self.scale, (r[0] for r in self.buf.get()), self.keep)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _valued(_rows(rows, self.seq), self.value)
        if pdf.empty:
            return
        if self.cnt.exists():
            pending, firing, last = self.cnt.get()
            held = self._held()
        else:
            pending, firing, last, held = 0, 0, None, EvictingBuffer(self.scale, keep=self.keep)
            self.handle.registerTimer(_ms(key[-1]) - 1)
        values = pdf[self.value].to_numpy(dtype="float64").tolist()
        out, evicted = [], 0
        for s, x in zip(pdf[self.seq].tolist(), values):
            held.add(x)
            pending, last = pending + 1, s
            if pending >= self.every:
                pending, firing = 0, firing + 1
                m = held.mean()
                out.append((*key, firing, "count", s, len(held.heap), m))
                evicted += held.evict(m)
        self.cnt.update((pending, firing, last))
        if evicted:
            self.buf.clear()
            if held.heap:
                self.buf.put([(v,) for v in held.values()])
        else:
            self.buf.appendList([(v,) for v in values])
        if out:
            yield pd.DataFrame.from_records(out, columns=[*self.group, "firing", "kind", "at_seq", "n", "mean"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.cnt.exists():
            _, firing, last = self.cnt.get()
            held = self._held()
            self.cnt.clear()
            self.buf.clear()
            if held.heap:
                yield pd.DataFrame.from_records([(*key, firing + 1, "final", last, len(held.heap), held.mean())],
                                                columns=[*self.group, "firing", "kind", "at_seq", "n", "mean"])


def stream_evicting_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, seq: str,
                         size: str | int | dt.timedelta, every: int = 3,
                         exact_scale: int | None = None, delay: str | int | dt.timedelta = 0, keep: str = KEEP[0]) -> DataFrame:
    """Same rows as :func:`tidemark.operators.firing.evicting_mean`, as a stream."""
    w = _windowed(df, ts, size, delay)
    group = [*keys, WS, WE]
    schema = T.StructType([w.schema[c] for c in group] + [
        T.StructField("firing", T.IntegerType()), T.StructField("kind", T.StringType()),
        T.StructField("at_seq", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("mean", T.DoubleType())])
    return w.groupBy(*group).transformWithStateInPandas(
        EvictingMeanProcessor(group, seq, value, every, exact_scale, keep), schema, "Append", "EventTime")


# --------------------------------------------------------------------------- late classification
class LateClassifierProcessor(StatefulProcessor):
    def __init__(self, seq, bound_us, size_us):
        self.seq, self.bound_us, self.size_us = seq, bound_us, size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.seq)
        top = self.top.get()[0] if self.top.exists() else None
        wm, late = [], []
        for t in pdf["tm_t"].astype("Int64").tolist():
            w = None if top is None else top - self.bound_us
            wm.append(w)
            if pd.isna(t):  # a row without a time is not late and moves nothing
                late.append(False)
                continue
            t = int(t)
            end = (t // self.size_us) * self.size_us + self.size_us
            late.append(w is not None and end - 1_000 <= w)
            top = t if top is None else max(top, t)
        if top is not None:
            self.top.update((top,))
        out = pdf.drop(columns=["tm_t", "tm_grp"])
        out["wm_before_us"] = pd.array(wm, dtype="Int64")
        out["is_late"] = late
        yield out


def stream_classify_late(df: DataFrame, ts: str, seq: str, bound: str | int | dt.timedelta,
                         size: str | int | dt.timedelta, keys: Sequence[str] = ()) -> DataFrame:
    """Per-record lateness on a stream, exactly the batch rule of ``classify_late``.

    One state key per ``keys`` value (one global key by default -- a single
    task, as a punctuated watermark of one stream is inherently sequential).
    """
    x = df.withColumn("tm_t", F.unix_micros(event_time(df, ts))).withColumn("tm_grp", F.lit(0))
    schema = T.StructType(list(df.schema.fields) + [
        T.StructField("wm_before_us", T.LongType()), T.StructField("is_late", T.BooleanType())])
    group = list(keys) or ["tm_grp"]
    return x.groupBy(*group).transformWithStateInPandas(
        LateClassifierProcessor(seq, duration_us(bound), duration_us(size)), schema, "Append", "None")


# --------------------------------------------------------------------------- keyed process
class KeyedProcessor(StatefulProcessor):
    """A caller's function of state and row; the state is kept as JSON text, whatever its shape."""

    def __init__(self, keys, seq, inputs, step, name):
        self.keys, self.seq, self.inputs, self.step, self.name = list(keys), seq, list(inputs), step, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "s string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.seq)
        state = json.loads(self.state.get()[0]) if self.state.exists() else None
        shown = []
        for values in zip(*(pdf[c].astype(object).tolist() for c in self.inputs), strict=True):
            row = {c: None if v is None or v is pd.NaT or v != v else v for c, v in zip(self.inputs, values, strict=True)}
            state, seen = self.step(state, row)
            shown.append(seen)
        self.state.update((json.dumps(state),))
        yield pd.DataFrame(_key_frame(key, self.keys, len(pdf)) | {self.seq: pdf[self.seq].to_numpy(), self.name: pd.array(shown, dtype="object")})


def stream_keyed_process(df: DataFrame, keys: Sequence[str], seq: str, inputs: Sequence[str], step, result: str, name: str = "result") -> DataFrame:
    """:func:`tidemark.operators.fold.keyed_process` on a stream: keys, ``seq`` and ``name``.

    The state must be something JSON holds (numbers, texts, lists, dicts with text keys).
    """
    schema = T.StructType([*[df.schema[k] for k in keys], df.schema[seq], T.StructField(name, T._parse_datatype_string(result))])
    return df.groupBy(*keys).transformWithStateInPandas(KeyedProcessor(keys, seq, inputs, step, name), schema, "Append", "None")
