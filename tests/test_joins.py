"""Program 13: keyed interval join with a residual predicate."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fixture_data import (GRADED_AT, MEN_H, MEN_IDS, T0, WOMEN_H, WOMEN_IDS, graded_lines, lines_df)
from tidemark.functions.format import grouped_number, message
from tidemark.functions.parse import parse_delimited
from tidemark.functions.timecols import from_millis
from tidemark.operators.joins import interval_join

EXPECTED = {
    1: [5, 7, 8], 3: [5, 7, 8], 4: [5, 7, 8, 9], 10: [8, 17], 11: [9, 17], 14: [16, 17, 19, 21],
    20: [21, 29], 22: [29, 30], 23: [21, 29, 30, 31], 24: [29, 30, 31, 33], 25: [29, 30, 31, 33],
    27: [30, 31, 33], 28: [33], 32: [33],
}


def _side(spark, ids, heights, sex, prefix):
    df = parse_delimited(lines_df(spark, graded_lines(ids, heights, sex)), GRADED_AT, cut_last_at_blank=True)
    df = df.withColumn("ts", from_millis("arrive_time"))
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


@pytest.mark.parametrize("method,bucket", [("plain", None), ("bucketed", None), ("bucketed", "1 minute"),
                                           ("bucketed", 7_000)])
def test_interval_join_program13(spark, method, bucket):
    men = _side(spark, MEN_IDS, MEN_H, "m", "l_")
    women = _side(spark, WOMEN_IDS, WOMEN_H, "f", "r_")
    out = interval_join(men, women, "l_grade", "r_grade", "l_ts", "r_ts", "-1 minute", "3 minutes",
                        residual=F.col("l_height") < F.col("r_height"), method=method, bucket=bucket)
    pairs = sorted((int(r.l_id), int(r.r_id)) for r in out.collect())
    assert len(pairs) == 39
    got: dict[int, list[int]] = {}
    for a, b in pairs:
        got.setdefault(a, []).append(b)
    assert got == EXPECTED


def test_interval_bounds_inclusive(spark):
    left = spark.createDataFrame([(1, "k", T0)], "lid int, lk string, lt long").withColumn("lts", from_millis("lt"))
    offsets = [-60_001, -60_000, 0, 180_000, 180_001]
    right = spark.createDataFrame([(i, "k", T0 + o) for i, o in enumerate(offsets)], "rid int, rk string, rt long")
    right = right.withColumn("rts", from_millis("rt"))
    for method in ("plain", "bucketed"):
        out = interval_join(left, right, "lk", "rk", "lts", "rts", "-1 minute", "3 minutes", method=method)
        assert sorted(r.rid for r in out.collect()) == [1, 2, 3]


def test_bucketed_equals_plain_random(spark):
    rnd = random.Random(7)
    rows_l = [(i, rnd.choice("abc"), T0 + rnd.randint(0, 3_600_000), rnd.random()) for i in range(300)]
    rows_r = [(i, rnd.choice("abcd"), T0 + rnd.randint(0, 3_600_000), rnd.random()) for i in range(300)]
    left = spark.createDataFrame(rows_l, "lid int, lk string, lt long, lv double").withColumn("lts", from_millis("lt"))
    right = spark.createDataFrame(rows_r, "rid int, rk string, rt long, rv double").withColumn("rts", from_millis("rt"))
    res = F.col("lv") < F.col("rv")
    brute = sorted((a[0], b[0]) for a in rows_l for b in rows_r
                   if a[1] == b[1] and a[2] - 300_000 <= b[2] <= a[2] + 120_000 and a[3] < b[3])
    for method, bucket in (("plain", None), ("bucketed", None), ("bucketed", 30_000)):
        out = interval_join(left, right, "lk", "rk", "lts", "rts", "-5 minutes", "2 minutes",
                            residual=res, method=method, bucket=bucket)
        assert sorted((r.lid, r.rid) for r in out.collect()) == brute


def test_message_format(spark):
    df = spark.createDataFrame([(1, 168.0, 1618838690000, 12.5)], "id long, h double, t long, x double")
    out = df.select(
        message("id:{0},height:{1},at:{2},x:{3}", "id", "h", "t", "x", numeric={1, 2, 3}).alias("m"),
        grouped_number(F.lit(1234.5678)).alias("g"),
    ).collect()[0]
    assert out.m == "id:1,height:168,at:1,618,838,690,000,x:12.5"
    assert out.g == "1,234.568"
