"""Programs 6-12: windows, running results, early and evicting reports."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixture_data import (AGE_P7, HEIGHTS, HEIGHTS_P12, LEFT_AT, MEASURED, MEASURED_AT, SEX_P7, SEX_P9, T6,
                          lines_df, left_at_lines, measured_at_lines, person_lines)
from tidemark.functions.parse import parse_delimited
from tidemark.functions.timecols import from_millis
from tidemark.operators.firing import early_mean, evicting_mean
from tidemark.operators.lateness import classify_late, drop_late
from tidemark.operators.running import running_argmax, running_mean
from tidemark.operators.tumbling import tumbling_extremes, tumbling_mean, tumbling_members


def _utc(h, m):
    return dt.datetime(2021, 4, 19, h, m)


def measured_at(spark, sexes, heights):
    df = parse_delimited(lines_df(spark, measured_at_lines(sexes, heights)), MEASURED_AT,
                         keep=("seq",), cut_last_at_blank=True)
    return df.withColumn("ts", from_millis("arrive_time").cast("timestamp_ntz"))


def test_tumbling_mean_program8(spark):
    df = measured_at(spark, SEX_P9[:11], HEIGHTS[:11])
    got = {(r.window_start, r.sex): (r.n, round(r.mean, 6))
           for r in tumbling_mean(df, ["sex"], "ts", "height", "5 minutes").collect()}
    assert got == {
        (_utc(13, 20), "m"): (1, 168.0),
        (_utc(13, 25), "f"): (2, 167.5),
        (_utc(13, 25), "m"): (3, 178.333333),
        (_utc(13, 30), "f"): (2, 165.0),
        (_utc(13, 30), "m"): (3, 167.666667),
    }


def test_tumbling_extremes_program9(spark):
    df = measured_at(spark, SEX_P9, HEIGHTS)
    out = tumbling_extremes(df, ["sex"], "ts", "height", "seq", "5 minutes", payload=("id",))
    got = {(r.window_start, r.sex): (r.highest.id, r.lowest.id) for r in out.collect()}
    assert got == {
        (_utc(13, 20), "m"): ("1", "1"),
        (_utc(13, 25), "f"): ("3", "2"),
        (_utc(13, 25), "m"): ("4", "6"),
        (_utc(13, 30), "f"): ("7", "8"),
        (_utc(13, 30), "m"): ("11", "9"),
        (_utc(13, 35), "m"): ("12", "12"),
    }


def test_tumbling_extremes_ties_first_arrival(spark):
    df = measured_at(spark, ["m"] * 4, [170, 180, 180, 170])
    r = tumbling_extremes(df, ["sex"], "ts", "height", "seq", "1 hour").collect()[0]
    assert (r.highest.seq, r.lowest.seq) == (2, 1)


def test_global_members_program6(spark):
    df = parse_delimited(lines_df(spark, left_at_lines()), LEFT_AT, keep=("seq",))
    df = df.withColumn("ts", from_millis("out_time"))
    out = tumbling_members(df, (), "ts", "seq", 5, cols=("id",)).collect()
    got = sorted((int((r.window_start.timestamp() * 1000) - T6), [m.id for m in r.members]) for r in out)
    assert got == [(0, ["1", "2", "3", "4", "5"]), (5, ["6", "7", "8", "9", "10"]), (10, ["11"])]


def test_members_parts_are_bounded_and_concatenate(spark):
    df = parse_delimited(lines_df(spark, left_at_lines()), LEFT_AT, keep=("seq",))
    df = df.withColumn("ts", from_millis("out_time"))
    out = tumbling_members(df, (), "ts", "seq", "1 hour", part_rows=4).orderBy("part").collect()
    assert max(r.n for r in out) <= 4
    assert [m.seq for r in out for m in r.members] == list(range(1, 12))


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_running_argmax_program7(spark, block):
    df = parse_delimited(lines_df(spark, person_lines(SEX_P7, AGE_P7)), T_PERSON(), keep=("seq",))
    out = running_argmax(df, ["sex"], "seq", "age", payload=("id",), block=block)
    got = [r.leader.id for r in out.orderBy("seq").collect()]
    assert got == ["1", "2", "3", "4", "4", "4", "3", "3", "4", "4", "11"]


def T_PERSON():
    from fixture_data import PERSON
    return PERSON


@pytest.mark.parametrize("block", [1, 5, 1 << 20])
def test_running_mean_program10(spark, block):
    lines = [f"{i},p{i},{s},20,{h}" for i, (s, h) in enumerate(zip(SEX_P9, HEIGHTS), start=1)]
    df = parse_delimited(lines_df(spark, lines), MEASURED, keep=("seq",))
    out = running_mean(df, ["sex"], "seq", "height", block=block)
    got = [round(r.mean, 6) for r in out.orderBy("seq").collect()]
    assert got == [168.0, 162.0, 167.5, 177.0, 177.333333, 175.75, 168.0, 166.25, 172.2, 171.833333,
                   172.285714, 170.125]


@pytest.mark.parametrize("block", [2, 1 << 20])
def test_early_mean_program11(spark, block):
    df = measured_at(spark, ["m"] * 12, HEIGHTS)
    out = early_mean(df, ["sex"], "ts", "height", "seq", "5 minutes", min_rows=3, block=block)
    got = sorted((r.window_start, r.firing, r.at_seq, round(r.mean, 6)) for r in out.collect())
    assert got == [
        (_utc(13, 20), "final", 1, 168.0),
        (_utc(13, 25), "early", 5, 174.75),
        (_utc(13, 25), "early", 6, 174.0),
        (_utc(13, 25), "final", 6, 174.0),
        (_utc(13, 30), "early", 10, 164.5),
        (_utc(13, 30), "early", 11, 166.6),
        (_utc(13, 30), "final", 11, 166.6),
        (_utc(13, 35), "final", 12, 155.0),
    ]


@pytest.mark.parametrize("scale", [None, 2])
def test_evicting_mean_program12(spark, scale):
    df = measured_at(spark, ["m"] * 17, HEIGHTS_P12)
    out = evicting_mean(df, ["sex"], "ts", "height", "seq", "10 minutes", every=3, exact_scale=scale)
    got = sorted((r.window_start, r.firing, r.kind, r.at_seq, r.n, round(r.mean, 6)) for r in out.collect())
    assert got == [
        (_utc(13, 20), 1, "count", 3, 3, 167.666667),
        (_utc(13, 20), 2, "count", 6, 5, 175.2),
        (_utc(13, 20), 3, "final", 6, 2, 182.0),
        (_utc(13, 30), 1, "count", 9, 3, 162.666667),
        (_utc(13, 30), 2, "count", 12, 4, 167.25),
        (_utc(13, 30), 3, "count", 15, 6, 168.166667),
        (_utc(13, 30), 4, "final", 16, 6, 172.833333),
        (_utc(13, 40), 1, "final", 17, 1, 159.0),
    ]


def test_evicting_mean_keeps_row_equal_to_mean(spark):
    df = measured_at(spark, ["m"] * 4, [170, 170, 170, 100])
    out = evicting_mean(df, ["sex"], "ts", "height", "seq", "1 hour", every=3, exact_scale=2)
    got = sorted((r.firing, r.kind, r.n, r.mean) for r in out.collect())
    assert got == [(1, "count", 3, 170.0), (2, "final", 4, 152.5)]


def test_classify_late(spark):
    # ids 1..11 at T6 + n ms; then a row back in window [T6, T6+5) after the watermark passed it
    lines = left_at_lines() + [f"12,p12,m,20,{T6 + 2}"]
    df = parse_delimited(lines_df(spark, lines), LEFT_AT, keep=("seq",))
    df = df.withColumn("ts", from_millis("out_time"))
    out = classify_late(df, "ts", "seq", bound=5, size=5, block=4)
    got = {r.seq: r.is_late for r in out.collect()}
    assert got[12] is True
    assert not any(got[i] for i in range(1, 12))
    first = out.filter(F.col("seq") == 1).collect()[0]
    assert first.wm_before is None


def test_drop_late_then_window(spark):
    lines = left_at_lines() + [f"12,p12,m,20,{T6 + 2}", f"13,p13,m,20,{T6 + 11}"]
    df = parse_delimited(lines_df(spark, lines), LEFT_AT, keep=("seq",))
    df = df.withColumn("ts", from_millis("out_time"))
    kept = drop_late(df, "ts", "seq", bound=5, size=5, block=4)
    out = tumbling_members(kept, (), "ts", "seq", 5, cols=("id",)).collect()
    got = sorted((int((r.window_start.timestamp() * 1000) - T6), [m.id for m in r.members]) for r in out)
    assert got == [(0, ["1", "2", "3", "4", "5"]), (5, ["6", "7", "8", "9", "10"]), (10, ["11", "13"])]
