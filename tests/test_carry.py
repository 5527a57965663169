"""The log of states: what is alive, what a batch writes, and crashes between its steps."""

from __future__ import annotations

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.running import running_mean, running_mean_spec
from tidemark.streaming.carry import CarryLog
from tidemark.streaming.scan import carry_log, stream_scan


@pytest.mark.parametrize("fan", [2, 3, 4])
def test_runs_cover_all_batches_once(fan):
    log = CarryLog(None, "x", ["k"], fan)
    for n in range(200):
        runs = log.runs(n)
        assert [b for _, first, last in runs for b in range(first, last + 1)] == list(range(n))
        assert len(runs) <= (fan - 1) * 8 and all(last - first + 1 == fan**level for level, first, last in runs)


def states(spark, d):
    return spark.createDataFrame(list(d.items()), "k string, v long")


def test_newest_state_wins_through_merges_and_expiry(spark, tmp_dir):
    rnd, log, now = random.Random(3), CarryLog(spark, f"{tmp_dir}/log", ["k"], fan=2, buckets=3), {}
    for epoch in range(9):
        log.expire(epoch)
        touched = {k: rnd.randrange(100) for k in rnd.sample(["a", "b", "c", "d", None], 2)} if epoch != 4 else {}
        now |= touched
        log.append(epoch, states(spark, touched))
        got = log.states(epoch + 1)
        assert {r.k: r.v for r in got.collect()} == now
        asked = spark.createDataFrame([("a",), (None,), ("zz",)], "k string")
        assert {r.k: r.v for r in log.states(epoch + 1, asked).collect()} == {k: v for k, v in now.items() if k in ("a", None)}
    levels = {d: sorted(os.listdir(f"{tmp_dir}/log/{d}")) for d in os.listdir(f"{tmp_dir}/log")}
    assert "batches=0-7" in levels["level=3"] and "batches=0-0" not in levels["level=0"]


def test_a_batch_writes_its_own_keys_only(spark, tmp_dir):
    log = CarryLog(spark, f"{tmp_dir}/log", ["k"], fan=4)
    log.append(0, spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))
    log.append(1, states(spark, {"7": 1, "x": 2}))
    rows = [spark.read.parquet(log.path((0, e, e))).count() for e in (0, 1)]
    size = lambda e: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(log.path((0, e, e))) for f in fs if f.endswith(".parquet"))
    assert rows == [20_000, 2] and size(1) < size(0) / 20
    assert {r.k: r.v for r in log.states(2, states(spark, {"7": 0, "8": 0, "x": 0})).collect()} == {"7": 1, "8": 8, "x": 2}


def batches(spark, folder, n, rows=12):
    data = [(f"k{(i * 7) % 5}" if i % 6 else None, i, float(i % 13)) for i in range(n * rows)]
    for part in range(n):
        spark.createDataFrame(data[part * rows:(part + 1) * rows], "k string, seq long, v double").coalesce(1).write.parquet(f"{folder}/{part:03}")


def answers(df):
    return sorted(((r.k, r.seq, r.n, r.mean) for r in df.collect()), key=str)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["before the run", "in the merge", "after the merge"])
def test_restart_after_a_crash(spark, tmp_dir, monkeypatch, step):
    """The stream stops in micro-batch 3, the one that merges four runs, and goes on from there."""
    batches(spark, f"{tmp_dir}/in", 6)
    src = lambda: spark.readStream.schema("k string, seq long, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in/*")
    ckpt, name = f"{tmp_dir}/ckpt", "cr_" + uuid.uuid4().hex[:6]
    append, write = CarryLog.append, CarryLog._write

    def crashing_append(self, epoch, df):
        if epoch == 3 and step == "before the run":
            raise Crash
        append(self, epoch, df)
        if epoch == 3 and step == "after the merge":
            raise Crash

    def crashing_write(self, df, run):
        if run[0] == 1 and step == "in the merge":
            raise Crash
        write(self, df, run)

    monkeypatch.setattr(CarryLog, "append", crashing_append)
    monkeypatch.setattr(CarryLog, "_write", crashing_write)
    run = lambda: stream_scan(running_mean_spec(src(), ["k"], "seq", "v"), name, f"{tmp_dir}/out", block=3, checkpoint=ckpt).awaitTermination()
    with pytest.raises(Exception):
        run()
    monkeypatch.setattr(CarryLog, "append", append)
    monkeypatch.setattr(CarryLog, "_write", write)
    run()
    batch = spark.read.parquet(f"{tmp_dir}/in/*")
    assert answers(spark.read.parquet(f"{tmp_dir}/out")) == answers(running_mean(batch, ["k"], "seq", "v"))
    held = {r.k: r["__in_n"] for r in carry_log(spark, ckpt, ["k"]).states(6).collect()}
    assert held == {r.k: r.n for r in batch.groupBy("k").agg(F.count("v").alias("n")).collect()}


def test_missing_state_is_an_error(spark, tmp_dir):
    with pytest.raises(RuntimeError, match="missing"):
        CarryLog(spark, f"{tmp_dir}/none", ["k"]).states(1)
