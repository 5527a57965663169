"""Plan-shape guards: the scale properties PLANS.md describes, asserted."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


def exchanges(text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(r"\bExchange \(\d+\)", tree))


@pytest.mark.parametrize("name", ["scan_lines", "parse_orders", "render_events", "union_orders", "route_purchases"])
def test_narrow_queries_do_not_shuffle(spark, name):
    assert exchanges(plan(spark, name)) == 0


@pytest.mark.parametrize("name", ["tumbling_mean", "window_members", "tumbling_extremes", "evicting_mean"])
def test_windowed_queries_shuffle_once(spark, name):
    assert exchanges(plan(spark, name)) == 1


def test_windowed_aggregate_is_partial_then_final(spark):
    tree = plan(spark, "tumbling_mean").split("\n\n")[0]
    assert tree.count("HashAggregate") == 2


@pytest.mark.parametrize("name", ["running_mean", "running_oldest", "early_mean"])
def test_keyed_prefix_scans_have_no_single_partition_step(spark, name):
    # the block-size subquery is a global min/max (one partial row per task); the scan itself is keyed
    main = plan(spark, name).split("===== Subqueries")[0]
    assert "SinglePartition" not in main


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "interval_join")
    assert "EqualTo(event_type,click)" in text and "EqualTo(event_type,purchase)" in text
    for schema in re.findall(r"ReadSchema: (struct<.*>)", text):
        assert "props" not in schema
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan(spark, "late_orders")


def test_interval_join_keys_include_time_bucket(spark):
    text = plan(spark, "interval_join")
    keys = re.findall(r"Left keys \[\d+\]: \[(.*)\]", text)
    assert keys and all("lbkt" in k and "user_id" in k for k in keys)


@pytest.mark.parametrize("name", ["running_mean", "running_oldest", "running_lowest"])
def test_scans_of_light_keys_are_a_plain_frame(spark, name):
    # no key exceeds a block here: no block table, no union, no join, the rows are dealt once
    tree = plan(spark, name).split("\n\n")[0]
    assert exchanges(plan(spark, name)) == 1 and "Union" not in tree and "Join" not in tree


def test_only_heavy_keys_enter_the_block_table(spark):
    spark.conf.set("tidemark.scan.block", "1000")  # event types have about 2,000 rows each
    try:
        text = plan(spark, "running_oldest")
    finally:
        spark.conf.unset("tidemark.scan.block")
    tree = text.split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and "Union" in tree and "BroadcastNestedLoopJoin" not in tree
    assert "SinglePartition" not in text.split("===== Subqueries")[0]
