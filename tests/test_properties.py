"""Property checks: scalable forms equal their brute-force definitions."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.firing import evicting_mean
from tidemark.operators.prefix import running, running_plain

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(min_value=0, max_value=40)),
    min_size=1,
    max_size=60,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=rows_st, block=st.integers(min_value=1, max_value=9), exclusive=st.booleans())
def test_prefix_scan_equals_plain_frame(spark, rows, block, exclusive):
    # unique, shuffled seq: rows arrive in a random order and seq decides
    data = [(k, v, (i * 7919) % 1009) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, v long, seq long").repartition(3)
    aggs = {
        "s": ("sum", F.col("v")),
        "mx": ("max", F.struct(F.col("v"), (-F.col("seq")).alias("o"))),
        "mn": ("min", F.col("v")),
        "mb": ("max_by", F.col("v"), F.when(F.col("v") % 3 == 0, F.col("seq"))),
    }
    fast = running(df, "seq", aggs, keys=["k"], block=block, exclusive=exclusive)
    slow = running_plain(df, "seq", aggs, keys=["k"], exclusive=exclusive)
    as_set = lambda d: sorted((r.k, r.seq, r.s, tuple(r.mx) if r.mx else None, r.mn, r.mb)
                              for r in d.collect())
    assert as_set(fast) == as_set(slow)


def _evict_reference(values, every):
    """Row-by-row restatement of the evicting window (one group)."""
    buf, out, pending = [], [], 0
    for v in values:
        buf.append(v)
        pending += 1
        if pending == every:
            pending = 0
            m = sum(buf) / len(buf)
            out.append(("count", len(buf), m))
            buf = [x for x in buf if not x < m]
    if buf:
        out.append(("final", len(buf), sum(buf) / len(buf)))
    return out


@SETTINGS
@given(values=st.lists(st.integers(min_value=100, max_value=120), min_size=1, max_size=40),
       every=st.integers(min_value=1, max_value=4))
def test_evicting_fold_equals_row_loop(spark, values, every):
    base = dt.datetime(2024, 1, 1)
    data = [("k", base + dt.timedelta(seconds=i), i, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, seq long, v double").repartition(4)
    out = evicting_mean(df, ["k"], "ts", "v", "seq", "1 day", every=every)
    got = [(r.kind, r.n, r.mean) for r in out.orderBy("firing").collect()]
    assert got == _evict_reference([float(v) for v in values], every)



@SETTINGS
@given(rows=rows_st, block=st.integers(min_value=1, max_value=9), cut=st.integers(min_value=0, max_value=60),
       exclusive=st.booleans())
def test_scan_continued_with_carry_equals_one_scan(spark, rows, block, cut, exclusive):
    from tidemark.operators.prefix import running_totals

    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, v long, seq long")
    aggs = {
        "s": ("sum", F.col("v")),
        "mx": ("max", F.col("v")),
        "mb": ("max_by", F.col("v"), F.when(F.col("v") % 2 == 0, F.col("seq"))),
    }
    first, second = df.filter(F.col("seq") < cut), df.filter(F.col("seq") >= cut)
    carry = running_totals(first, "seq", aggs, keys=["k"])
    parts = running(first, "seq", aggs, keys=["k"], block=block, exclusive=exclusive).unionByName(
        running(second, "seq", aggs, keys=["k"], block=block, exclusive=exclusive, carry=carry))
    whole = running_plain(df, "seq", aggs, keys=["k"], exclusive=exclusive)
    as_set = lambda d: sorted((r.k, r.seq, r.s, r.mx, r.mb) for r in d.collect())
    assert as_set(parts) == as_set(whole)


@SETTINGS
@given(
    left=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 600), st.integers(0, 9)), min_size=1, max_size=25),
    right=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 600), st.integers(0, 9)), min_size=1, max_size=25),
    lower=st.integers(-120, 60), span=st.integers(0, 180), bucket=st.one_of(st.none(), st.integers(1, 90)),
)
def test_bucketed_interval_join_equals_brute_force(spark, left, right, lower, span, bucket):
    from tidemark.functions.timecols import from_millis
    from tidemark.operators.joins import interval_join

    upper = lower + span
    base = 1_700_000_000_000
    lrows = [(i, k, base + t * 1000, v) for i, (k, t, v) in enumerate(left)]
    rrows = [(i, k, base + t * 1000, v) for i, (k, t, v) in enumerate(right)]
    ldf = spark.createDataFrame(lrows, "lid int, lk string, lt long, lv int").withColumn("lts", from_millis("lt"))
    rdf = spark.createDataFrame(rrows, "rid int, rk string, rt long, rv int").withColumn("rts", from_millis("rt"))
    out = interval_join(ldf, rdf, "lk", "rk", "lts", "rts", f"{lower} seconds", f"{upper} seconds",
                        residual=F.col("lv") <= F.col("rv"), bucket=None if bucket is None else f"{bucket} seconds")
    brute = sorted((a[0], b[0]) for a in lrows for b in rrows
                   if a[1] == b[1] and a[2] + lower * 1000 <= b[2] <= a[2] + upper * 1000 and a[3] <= b[3])
    assert sorted((r.lid, r.rid) for r in out.collect()) == brute


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from("xy"), st.integers(0, 50)), min_size=1, max_size=40),
       block=st.integers(1, 6), bound=st.integers(0, 20))
def test_keyed_late_classification_equals_plain_frame(spark, rows, block, bound):
    from pyspark.sql import Window

    from tidemark.operators.lateness import classify_late

    base = dt.datetime(2024, 1, 1)
    data = [(k, base + dt.timedelta(seconds=t), i) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, seq long")
    got = classify_late(df, "ts", "seq", f"{bound} seconds", "10 seconds", keys=["k"], block=block)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    wm = F.max(F.unix_micros(F.col("ts").cast("timestamp"))).over(w) - F.lit(bound * 1_000_000)
    end = F.unix_micros(F.window("ts", "10 seconds").getField("end").cast("timestamp"))
    want = df.select("seq", F.coalesce(end - 1000 <= wm, F.lit(False)).alias("is_late"))
    assert sorted((r.seq, r.is_late) for r in got.collect()) == sorted((r.seq, r.is_late) for r in want.collect())
