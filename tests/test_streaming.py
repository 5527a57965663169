"""Streaming paths: the fixtures replayed as files, compared with the batch rows.

Each fixture row becomes one parquet file (increasing modification times), the
file source reads one file per micro-batch, and ``availableNow`` drains it.
Windows still open when the input ends are not emitted on a stream
(FIXTURES.md §3), so only closed windows are compared.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fixture_data import (AGE_P7, HEIGHTS, HEIGHTS_P12, MEN_H, MEN_IDS, SEX_P7, SEX_P9, SCORES, T0, WOMEN_H,
                          WOMEN_IDS, MINUTE)
from tidemark.sources.files import start_stream, stream_table
from tidemark.streaming.processors import (stream_classify_late, stream_connect_latest, stream_early_mean,
                                           stream_evicting_mean, stream_running_argmax, stream_running_mean)
from tidemark.streaming.windows import stream_interval_join, stream_tumbling_mean


def land(folder: str, rows: list[dict], schema: pa.Schema, per_file: int = 1) -> None:
    os.makedirs(folder, exist_ok=True)
    base = 1_600_000_000
    for k in range(0, len(rows), per_file):
        chunk = rows[k:k + per_file]
        p = os.path.join(folder, f"part-{k:05d}.parquet")
        pq.write_table(pa.Table.from_pylist(chunk, schema=schema), p)
        os.utime(p, (base + k, base + k))


def run(df, spark) -> list:
    name = "q_" + uuid.uuid4().hex[:8]
    q = start_stream(df, name, sink="memory")
    q.awaitTermination(120)
    rows = spark.sql(f"SELECT * FROM {name}").collect()
    q.stop()
    return rows


MEASURED_PA = pa.schema([("seq", pa.int64()), ("id", pa.string()), ("sex", pa.string()),
                         ("height", pa.float64()), ("arrive_time", pa.int64())])


def measured_rows(sexes, heights):
    return [{"seq": n + 1, "id": str(n + 1), "sex": s, "height": float(h), "arrive_time": T0 + n * MINUTE}
            for n, (s, h) in enumerate(zip(sexes, heights))]


def measured_stream(spark, tmp_dir, sexes, heights, per_file=1):
    folder = os.path.join(tmp_dir, "in")
    land(folder, measured_rows(sexes, heights), MEASURED_PA, per_file)
    schema = spark.read.parquet(folder).schema
    return stream_table(spark, folder, schema, max_files_per_trigger=1)


def _utc(h, m):
    return dt.datetime(2021, 4, 19, h, m)


def test_stream_tumbling_mean_closed_windows(spark, tmp_dir):
    s = measured_stream(spark, tmp_dir, SEX_P9[:11], HEIGHTS[:11])
    rows = run(stream_tumbling_mean(s, ["sex"], "arrive_time", "height", "5 minutes"), spark)
    got = {(r.window_start, r.sex): round(r.mean, 6) for r in rows}
    assert got == {(_utc(13, 20), "m"): 168.0, (_utc(13, 25), "f"): 167.5, (_utc(13, 25), "m"): 178.333333}


def test_stream_running_mean_and_argmax(spark, tmp_dir):
    s = measured_stream(spark, tmp_dir, SEX_P9, HEIGHTS, per_file=3)
    rows = run(stream_running_mean(s, ["sex"], "seq", "height"), spark)
    got = [round(r.mean, 6) for r in sorted(rows, key=lambda r: r.seq)]
    assert got == [168.0, 162.0, 167.5, 177.0, 177.333333, 175.75, 168.0, 166.25, 172.2, 171.833333,
                   172.285714, 170.125]

    folder = os.path.join(tmp_dir, "ages")
    land(folder, [{"seq": i + 1, "sex": s, "age": a} for i, (s, a) in enumerate(zip(SEX_P7, AGE_P7))],
         pa.schema([("seq", pa.int64()), ("sex", pa.string()), ("age", pa.int64())]), per_file=4)
    ages = stream_table(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
    rows = run(stream_running_argmax(ages, ["sex"], "seq", "age"), spark)
    assert [r.leader_seq for r in sorted(rows, key=lambda r: r.seq)] == [1, 2, 3, 4, 4, 4, 3, 3, 4, 4, 11]


def test_stream_connect_latest(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "subj")
    order = [1, 2, 4, 6, 7]
    land(folder, [{"seq": o, "id": str(i + 1), "score": float(sc)} for i, (o, sc) in enumerate(zip(order, SCORES))],
         pa.schema([("seq", pa.int64()), ("id", pa.string()), ("score", pa.float64())]), per_file=5)
    cfolder = os.path.join(tmp_dir, "ctl")
    land(cfolder, [{"seq": 3, "mark": 560.0}, {"seq": 5, "mark": 600.0}],
         pa.schema([("seq", pa.int64()), ("mark", pa.float64())]), per_file=2)
    subj = stream_table(spark, folder, spark.read.parquet(folder).schema)
    ctl = stream_table(spark, cfolder, spark.read.parquet(cfolder).schema)
    rows = run(stream_connect_latest(subj, ctl, "seq", "score", "mark", initial=500), spark)
    got = [(r.seq, r.id, r.threshold, r.label) for r in sorted(rows, key=lambda r: r.seq)]
    assert got == [(1, "1", 500.0, "pass"), (2, "2", 500.0, "pass"), (3, None, 560.0, "change passing score"),
                   (4, "3", 560.0, "not pass"), (5, None, 600.0, "change passing score"),
                   (6, "4", 600.0, "not pass"), (7, "5", 600.0, "pass")]


def test_stream_early_mean(spark, tmp_dir):
    s = measured_stream(spark, tmp_dir, ["m"] * 12, HEIGHTS)
    rows = run(stream_early_mean(s, ["sex"], "arrive_time", "height", "seq", "5 minutes"), spark)
    got = sorted((r.window_start, r.firing, r.at_seq, round(r.mean, 6)) for r in rows)
    assert got == [
        (_utc(13, 20), "final", 1, 168.0),
        (_utc(13, 25), "early", 5, 174.75),
        (_utc(13, 25), "early", 6, 174.0),
        (_utc(13, 25), "final", 6, 174.0),
        (_utc(13, 30), "early", 10, 164.5),
        (_utc(13, 30), "early", 11, 166.6),
        (_utc(13, 30), "final", 11, 166.6),
    ]


def test_stream_evicting_mean(spark, tmp_dir):
    s = measured_stream(spark, tmp_dir, ["m"] * 17, HEIGHTS_P12)
    rows = run(stream_evicting_mean(s, ["sex"], "arrive_time", "height", "seq", "10 minutes"), spark)
    got = sorted((r.window_start, r.firing, r.kind, r.n, round(r.mean, 6)) for r in rows)
    assert got == [
        (_utc(13, 20), 1, "count", 3, 167.666667),
        (_utc(13, 20), 2, "count", 5, 175.2),
        (_utc(13, 20), 3, "final", 2, 182.0),
        (_utc(13, 30), 1, "count", 3, 162.666667),
        (_utc(13, 30), 2, "count", 4, 167.25),
        (_utc(13, 30), 3, "count", 6, 168.166667),
        (_utc(13, 30), 4, "final", 6, 172.833333),
    ]


@pytest.mark.parametrize("bucketed", [True, False])
def test_stream_interval_join_program13(spark, tmp_dir, bucketed):
    sch = pa.schema([("id", pa.string()), ("grade", pa.string()), ("height", pa.float64()), ("t", pa.int64())])

    def side(name, ids, hs):
        folder = os.path.join(tmp_dir, name)
        land(folder, [{"id": str(i), "grade": "302", "height": float(h), "t": T0 + n * MINUTE}
                      for n, (i, h) in enumerate(zip(ids, hs))], sch, per_file=len(ids))
        df = stream_table(spark, folder, spark.read.parquet(folder).schema)
        return df.select(*[F.col(c).alias(f"{name[0]}_{c}") for c in df.columns])

    men, women = side("left", MEN_IDS, MEN_H), side("right", WOMEN_IDS, WOMEN_H)
    j = stream_interval_join(men, women, "l_grade", "r_grade", "l_t", "r_t", "-1 minute", "3 minutes",
                             residual=F.col("l_height") < F.col("r_height"), bucketed=bucketed)
    rows = run(j.select("l_id", "r_id"), spark)
    assert len(rows) == 39


def test_stream_classify_late(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "late")
    t6 = 1614697662000
    rows = [{"seq": i, "t": t6 + i - 1} for i in range(1, 12)] + [{"seq": 12, "t": t6 + 2}]
    land(folder, rows, pa.schema([("seq", pa.int64()), ("t", pa.int64())]), per_file=5)
    s = stream_table(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
    out = run(stream_classify_late(s, "t", "seq", bound=5, size=5), spark)
    got = {r.seq: r.is_late for r in out}
    assert got[12] is True and not any(got[i] for i in range(1, 12))


def test_stream_routes_sink(spark, tmp_dir):
    from tidemark.operators.compose import explode_routes, route
    from tidemark.sources.files import stream_routes

    s = measured_stream(spark, tmp_dir, SEX_P9, HEIGHTS, per_file=4)
    tagged = explode_routes(route(s, [("tall", F.col("height") > 170)], default="other"))
    out = os.path.join(tmp_dir, "routes")
    q = stream_routes(tagged, "routes_" + uuid.uuid4().hex[:6], out)
    q.awaitTermination(120)
    q.stop()
    got = spark.read.parquet(out)
    assert sorted(r.id for r in got.filter(F.col("route") == "tall").collect()) == sorted(
        str(i + 1) for i, h in enumerate(HEIGHTS) if h > 170)
    assert got.count() == len(HEIGHTS)


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_driver_events_as_stream_match_batch(spark):
    """events parquet as a stream source: closed windows and join pairs equal batch."""
    from tidemark.operators.tumbling import tumbling_mean

    batch_df = spark.read.parquet(f"{SF}/events.parquet")
    s = stream_table(spark, f"{SF}/events*.parquet", batch_df.schema)  # a file source wants a folder or glob
    rows = run(stream_tumbling_mean(s, ["event_type"], "ts", "value", "1 day", exact_scale=2), spark)
    streamed = sorted((r.event_type, r.window_start, r.n, r.mean) for r in rows)
    batch = tumbling_mean(batch_df, ["event_type"], "ts", "value", "1 day", exact_scale=2)
    last_start = batch.agg(F.max("window_start")).first()[0]
    expected = sorted((r.event_type, r.window_start, r.n, r.mean) for r in batch.collect()
                      if r.window_start < last_start)
    assert streamed and streamed == expected

    def side(df, kind, p):
        return df.filter(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{p}id"), F.col("user_id").alias(f"{p}user"),
            F.col("ts").alias(f"{p}ts"), F.col("value").alias(f"{p}v"))

    from tidemark.operators.joins import interval_join

    res = F.col("l_v") < F.col("r_v")
    j = stream_interval_join(side(s, "click", "l_"), side(s, "purchase", "r_"), "l_user", "r_user", "l_ts", "r_ts",
                             "-1 hour", "3 hours", residual=res)
    streamed = sorted((r.l_id, r.r_id) for r in run(j.select("l_id", "r_id"), spark))
    bj = interval_join(side(batch_df, "click", "l_"), side(batch_df, "purchase", "r_"), "l_user", "r_user",
                       "l_ts", "r_ts", "-1 hour", "3 hours", residual=res)
    assert streamed == sorted((r.l_id, r.r_id) for r in bj.collect())


def test_stream_scan_forms_match_batch(spark, tmp_dir):
    """Micro-batch prefix scans with a carry table equal the batch operators."""
    from tidemark.operators.compose import connect_latest
    from tidemark.operators.lateness import classify_late
    from tidemark.operators.running import running_argmax, running_mean
    from tidemark.streaming.scan import (stream_classify_late_scan, stream_connect_latest_scan,
                                         stream_running_argmax_scan, stream_running_mean_scan)

    s = measured_stream(spark, tmp_dir, SEX_P9, HEIGHTS, per_file=2)  # six micro-batches
    batch = spark.read.parquet(os.path.join(tmp_dir, "in"))

    def out_of(q, path):
        q.awaitTermination(120)
        q.stop()
        return spark.read.parquet(path).drop("epoch")

    p = os.path.join(tmp_dir, "rm")
    got = out_of(stream_running_mean_scan(s, ["sex"], "seq", "height", "rm_" + uuid.uuid4().hex[:6], p, block=2), p)
    want = running_mean(batch, ["sex"], "seq", "height", block=2)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(tuple(r) for r in want.collect())

    p = os.path.join(tmp_dir, "ra")
    got = out_of(stream_running_argmax_scan(s, ["sex"], "seq", "height", "ra_" + uuid.uuid4().hex[:6], p), p)
    assert [r.leader.seq for r in got.orderBy("seq").collect()] == \
        [r.leader.seq for r in running_argmax(batch, ["sex"], "seq", "height").orderBy("seq").collect()]

    p = os.path.join(tmp_dir, "late")
    got = out_of(stream_classify_late_scan(s, "arrive_time", "seq", "2 minutes", "5 minutes",
                                           "cl_" + uuid.uuid4().hex[:6], p, block=3), p)
    want = classify_late(batch, "arrive_time", "seq", "2 minutes", "5 minutes", block=3)
    assert sorted((r.seq, r.is_late) for r in got.collect()) == sorted((r.seq, r.is_late) for r in want.collect())

    ctl_folder = os.path.join(tmp_dir, "marks")
    land(ctl_folder, [{"seq": 3 * k + 2, "mark": float(160 + 5 * k)} for k in range(4)],
         pa.schema([("seq", pa.int64()), ("mark", pa.float64())]), per_file=1)
    marks = stream_table(spark, ctl_folder, spark.read.parquet(ctl_folder).schema, max_files_per_trigger=1)
    subj = s.select("seq", "id", "height")
    p = os.path.join(tmp_dir, "conn")
    got = out_of(stream_connect_latest_scan(subj, marks, "seq", "height", "mark", 150.0,
                                            "cn_" + uuid.uuid4().hex[:6], p, block=2), p)
    want = connect_latest(batch.select("seq", "id", "height"), spark.read.parquet(ctl_folder), "seq", "height",
                          "mark", 150.0, block=2)
    assert got.count() == want.count() == 16
    # arrival order of two streams differs from seq order; every subject row still sees a threshold
    assert got.filter("threshold is null").count() == 0


def test_stream_members_closed_windows(spark, tmp_dir):
    from tidemark.streaming.windows import stream_tumbling_members

    s = measured_stream(spark, tmp_dir, SEX_P9, HEIGHTS, per_file=3)
    rows = run(stream_tumbling_members(s, ["sex"], "arrive_time", "seq", "5 minutes", cols=("id",), part_rows=2),
               spark)
    got = {}
    for r in sorted(rows, key=lambda r: (r.sex, r.window_start, r.part)):
        got.setdefault((r.sex, r.window_start), []).extend(m.id for m in r.members)
    assert got[("m", _utc(13, 25))] == ["4", "5", "6"]
    assert got[("f", _utc(13, 25))] == ["2", "3"]
    assert max(r.n for r in rows) <= 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_driver_events_stateful_windows_match_batch(spark):
    """Early and evicting windows over events as a stream: closed windows equal batch."""
    from tidemark.operators.firing import early_mean, evicting_mean

    batch_df = spark.read.parquet(f"{SF}/events.parquet")
    s = stream_table(spark, f"{SF}/events*.parquet", batch_df.schema)
    last_start = batch_df.select(F.max(F.date_trunc("day", "ts"))).first()[0]

    streamed = run(stream_early_mean(s, ["event_type"], "ts", "value", "event_id", "1 day", exact_scale=2), spark)
    want = early_mean(batch_df, ["event_type"], "ts", "value", "event_id", "1 day", exact_scale=2, block=64)
    key = lambda r: (r.event_type, r.window_start, r.firing, r.at_seq, r.n, r.mean)
    # early reports are emitted as rows arrive; final ones once the window has closed
    closed = lambda r, final: r.window_start < last_start or r.firing != final
    assert sorted(map(key, streamed)) == sorted(key(r) for r in want.collect() if closed(r, "final"))

    streamed = run(stream_evicting_mean(s, ["event_type"], "ts", "value", "event_id", "1 day", exact_scale=2), spark)
    want = evicting_mean(batch_df, ["event_type"], "ts", "value", "event_id", "1 day", exact_scale=2)
    key = lambda r: (r.event_type, r.window_start, r.firing, r.kind, r.at_seq, r.n, r.mean)
    assert sorted(map(key, streamed)) == sorted(
        key(r) for r in want.collect() if r.window_start < last_start or r.kind != "final")


def test_stream_early_mean_drops_row_behind_watermark(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "in")
    late = {"seq": 13, "id": "13", "sex": "m", "height": 300.0, "arrive_time": T0 + MINUTE + 5000}
    land(folder, measured_rows(["m"] * 12, HEIGHTS) + [late], MEASURED_PA, 1)
    s = stream_table(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
    rows = run(stream_early_mean(s, ["sex"], "arrive_time", "height", "seq", "5 minutes"), spark)
    finals = sorted((r.window_start, r.n, r.mean) for r in rows if r.firing == "final")
    assert finals == [(_utc(13, 20), 1, 168.0), (_utc(13, 25), 5, 174.0), (_utc(13, 30), 5, 166.6)]
    assert all(r.at_seq != 13 for r in rows)


def test_stream_text_lines_parsed_and_windowed(spark, tmp_dir):
    """S2 re-aimed: text files landing in a folder are the line source."""
    from fixture_data import MEASURED_AT, measured_at_lines
    from tidemark.functions.parse import parse_delimited
    from tidemark.sources.files import stream_lines

    folder = os.path.join(tmp_dir, "landing")
    os.makedirs(folder)
    for n, line in enumerate(measured_at_lines(SEX_P9[:11], HEIGHTS[:11])):
        p = os.path.join(folder, f"line-{n:03d}.txt")
        with open(p, "w") as f:
            f.write(line + "\n")
        os.utime(p, (1_600_000_000 + n, 1_600_000_000 + n))
    lines = stream_lines(spark, folder, max_files_per_trigger=1)
    parsed = parse_delimited(lines, MEASURED_AT, char_fields=("sex",), cut_last_at_blank=True)
    rows = run(stream_tumbling_mean(parsed, ["sex"], "arrive_time", "height", "5 minutes"), spark)
    got = {(r.window_start, r.sex): round(r.mean, 6) for r in rows}
    assert got == {(_utc(13, 20), "m"): 168.0, (_utc(13, 25), "f"): 167.5, (_utc(13, 25), "m"): 178.333333}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_driver_events_extremes_and_members_as_stream(spark):
    from tidemark.operators.tumbling import tumbling_extremes, tumbling_members
    from tidemark.streaming.windows import stream_tumbling_extremes, stream_tumbling_members

    batch_df = spark.read.parquet(f"{SF}/events.parquet")
    s = stream_table(spark, f"{SF}/events*.parquet", batch_df.schema)
    last = batch_df.select(F.max(F.date_trunc("day", "ts"))).first()[0]

    got = run(stream_tumbling_extremes(s, ["event_type"], "ts", "value", "event_id", "1 day"), spark)
    want = tumbling_extremes(batch_df, ["event_type"], "ts", "value", "event_id", "1 day")
    key = lambda r: (r.event_type, r.window_start, r.n, tuple(r.highest), tuple(r.lowest))
    assert sorted(map(key, got)) == sorted(key(r) for r in want.collect() if r.window_start < last)

    got = run(stream_tumbling_members(s, ["event_type"], "ts", "event_id", "1 day", part_rows=16), spark)
    want = tumbling_members(batch_df, ["event_type"], "ts", "event_id", "1 day", part_rows=16)

    def lists(rows):
        out = {}
        for r in sorted(rows, key=lambda r: r.part):
            out.setdefault((r.event_type, r.window_start), []).extend(m.event_id for m in r.members)
        return out

    assert max(r.n for r in got) <= 16
    assert lists(got) == lists(r for r in want.collect() if r.window_start < last)


def test_end_of_input_marker_flushes_windows(spark, tmp_dir):
    from tidemark.operators.tumbling import tumbling_mean
    from tidemark.sources.files import mark_end_of_input

    folder = os.path.join(tmp_dir, "in")
    land(folder, measured_rows(SEX_P9[:11], HEIGHTS[:11]), MEASURED_PA, 1)
    schema = spark.read.parquet(folder).schema
    batch = tumbling_mean(spark.read.parquet(folder), ["sex"], "arrive_time", "height", "5 minutes")
    mark_end_of_input(spark, folder, schema, "arrive_time", {"sex": "<end>", "seq": 1 << 62})
    s = stream_table(spark, folder, schema, max_files_per_trigger=1)
    rows = run(stream_tumbling_mean(s, ["sex"], "arrive_time", "height", "5 minutes"), spark)
    got = sorted((r.window_start, r.sex, r.n, r.mean) for r in rows)
    assert got == sorted((r.window_start, r.sex, r.n, r.mean) for r in batch.collect())
    assert len(got) == 5


def test_end_of_input_marker_fires_processor_timers(spark, tmp_dir):
    from tidemark.sources.files import mark_end_of_input

    folder = os.path.join(tmp_dir, "in")
    land(folder, measured_rows(["m"] * 12, HEIGHTS), MEASURED_PA, 1)
    schema = spark.read.parquet(folder).schema
    mark_end_of_input(spark, folder, schema, "arrive_time", {"sex": "<end>", "seq": 1 << 62})
    s = stream_table(spark, folder, schema, max_files_per_trigger=1)
    rows = run(stream_early_mean(s, ["sex"], "arrive_time", "height", "seq", "5 minutes"), spark)
    finals = sorted((r.window_start, r.n, round(r.mean, 6)) for r in rows if r.firing == "final")
    assert finals == [(_utc(13, 20), 1, 168.0), (_utc(13, 25), 5, 174.0), (_utc(13, 30), 5, 166.6),
                      (_utc(13, 35), 1, 155.0)]
    assert all(r.sex == "m" for r in rows)


NULLS_PA = pa.schema([("seq", pa.int64()), ("k", pa.string()), ("v", pa.float64()), ("ts", pa.int64())])


def _null_rows():
    values = [None, 10.0, None, 20.0, 5.0, None, 20.0, 31.0, 2.0, None]
    return [{"seq": i + 1, "k": "a" if i % 3 else "b", "v": v, "ts": None if i in (2, 6) else T0 + (i % 5) * MINUTE}
            for i, v in enumerate(values)]


def test_processors_on_nulls_match_batch(spark, tmp_dir):
    """Null values and times: every keyed-state form gives what its batch form gives."""
    from tidemark.operators.lateness import classify_late
    from tidemark.operators.running import running_argmax, running_mean
    from tidemark.streaming.processors import stream_classify_late

    folder = os.path.join(tmp_dir, "in")
    land(folder, _null_rows(), NULLS_PA, per_file=3)
    batch = spark.read.parquet(folder)
    s = stream_table(spark, folder, batch.schema, max_files_per_trigger=1)
    clean = lambda x: None if x is None or x != x else x
    for scale in (None, 2):
        got = sorted((r.k, r.seq, r.n, clean(r.mean)) for r in run(stream_running_mean(s, ["k"], "seq", "v", scale), spark))
        assert got == sorted((r.k, r.seq, r.n, r.mean) for r in running_mean(batch, ["k"], "seq", "v", scale).collect())
    got = sorted((r.k, r.seq, r.leader_seq, clean(r.leader_value)) for r in run(stream_running_argmax(s, ["k"], "seq", "v"), spark))
    lead = [(r.k, r.seq, *(r.leader or (None, None))) for r in running_argmax(batch, ["k"], "seq", "v").collect()]
    assert got == sorted(lead)
    got = sorted((r.seq, r.is_late) for r in run(stream_classify_late(s, "ts", "seq", "1 minute", "1 minute"), spark))
    assert got == sorted((r.seq, r.is_late) for r in classify_late(batch, "ts", "seq", "1 minute", "1 minute").collect())


def test_window_processors_skip_nulls_like_batch(spark, tmp_dir):
    from tidemark.operators.firing import early_mean, evicting_mean
    from tidemark.sources.files import mark_end_of_input

    rows = [{"seq": i + 1, "k": "a", "v": None if i % 4 == 1 else float(i % 7), "ts": T0 + i * 1000} for i in range(20)]
    folder = os.path.join(tmp_dir, "in")
    land(folder, rows, NULLS_PA, per_file=7)
    batch = spark.read.parquet(folder)
    mark_end_of_input(spark, folder, batch.schema, "ts", {"k": "end", "seq": 0, "v": 0.0})
    s = stream_table(spark, folder, batch.schema, max_files_per_trigger=1)
    real = batch.filter("k = 'a'")
    got = sorted((r.firing, r.at_seq, r.n, r.mean) for r in run(stream_early_mean(s, ["k"], "ts", "v", "seq", "5 minutes", exact_scale=2), spark) if r.k == "a")
    assert got == sorted((r.firing, r.at_seq, r.n, r.mean) for r in early_mean(real, ["k"], "ts", "v", "seq", "5 minutes", exact_scale=2).collect())
    got = sorted((r.firing, r.kind, r.at_seq, r.n, r.mean) for r in run(stream_evicting_mean(s, ["k"], "ts", "v", "seq", "5 minutes"), spark) if r.k == "a")
    assert got == sorted((r.firing, r.kind, r.at_seq, r.n, r.mean) for r in evicting_mean(real, ["k"], "ts", "v", "seq", "5 minutes").collect())


def test_scan_restarts_from_its_own_checkpoint(spark, tmp_dir):
    """The carry lies in the query's checkpoint: a restarted query goes on from there."""
    from tidemark.operators.running import running_mean
    from tidemark.streaming.scan import stream_running_mean_scan

    folder, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    rows = [{"seq": i + 1, "k": "a", "v": float(i), "ts": T0} for i in range(9)]
    for k in range(3):
        os.makedirs(folder, exist_ok=True)
        p = os.path.join(folder, f"part-{k}.parquet")
        pq.write_table(pa.Table.from_pylist(rows[3 * k : 3 * k + 3], schema=NULLS_PA), p)
        os.utime(p, (1_600_000_000 + k,) * 2)
        s = stream_table(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
        q = stream_running_mean_scan(s, ["k"], "seq", "v", "restart_" + uuid.uuid4().hex[:6], out, checkpoint=ckpt)
        q.awaitTermination(120)
        q.stop()
    got = sorted((r.seq, r.n, r.mean) for r in spark.read.parquet(out).collect())
    assert got == sorted((r.seq, r.n, r.mean) for r in running_mean(spark.read.parquet(folder), ["k"], "seq", "v").collect())
    assert os.path.isdir(os.path.join(ckpt, "carry", "level=0", "batches=2-2"))


def test_stream_join_of_one_key_is_spread_and_its_state_expires(spark, tmp_dir):
    """One grade holds all rows: its join state lies in several partitions, equals the batch join, and goes as time passes."""
    from tidemark.operators.joins import interval_join
    from tidemark.sources.files import start_stream
    from tidemark.streaming.windows import stream_interval_join

    minute = 60
    left = [{"l_grade": "g", "l_id": i, "l_ts": dt.datetime(2024, 1, 1) + dt.timedelta(seconds=minute * i)} for i in range(60)]
    right = [{"r_grade": "g", "r_id": i, "r_ts": dt.datetime(2024, 1, 1) + dt.timedelta(seconds=minute * i + 20)} for i in range(60)]
    sides = []
    for name, rows in (("l", left), ("r", right)):
        schema = pa.schema([(f"{name}_grade", pa.string()), (f"{name}_id", pa.int64()), (f"{name}_ts", pa.timestamp("us"))])
        land(os.path.join(tmp_dir, name), rows, schema, per_file=20)
        sides.append(spark.read.parquet(os.path.join(tmp_dir, name)))
    args = ("l_grade", "r_grade", "l_ts", "r_ts", "-1 minute", "3 minutes")
    streams = [stream_table(spark, os.path.join(tmp_dir, n), d.schema, max_files_per_trigger=1) for n, d in zip("lr", sides)]
    ckpt = os.path.join(tmp_dir, "ckpt")
    joined = stream_interval_join(*streams, *args).select("l_id", "r_id")
    start_stream(joined, "spread_" + uuid.uuid4().hex[:6], path=os.path.join(tmp_dir, "out"), checkpoint=ckpt).awaitTermination(120)
    want = sorted(tuple(r) for r in interval_join(*sides, *args).select("l_id", "r_id").collect())
    assert sorted(tuple(r) for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect()) == want
    for side, first in (("left", True), ("right", False)):
        held = lambda b: [r.partition_id for r in spark.read.format("statestore").option("joinSide", side).option("batchId", b).load(ckpt).select("partition_id").collect()]
        assert len(set(held(0))) > 1
        assert len(held(2)) < 60, "rows that no later row can meet have gone"
