"""Driver contract: entry runs, every query has an oracle, and they agree."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"event_type", "window_start", "window_end", "n", "mean"} <= set(df.columns)


def test_every_stream_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _rows(rows):
    def norm(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(v) for v in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


SCANS = ("connect_threshold", "running_oldest", "running_lowest", "running_mean", "early_mean", "late_orders", "late_orders_bound0",
         "ontime_orders_daily")


@pytest.mark.parametrize("name", SCANS)
def test_scan_with_many_blocks_matches_oracle(spark, duck, name):
    spark.conf.set("tidemark.scan.block", "97")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.unset("tidemark.scan.block")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _rows([tuple(r[c] for c in cols) for r in df.collect()])
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = _rows([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert got == want
