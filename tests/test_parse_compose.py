"""Programs 1-5: scan, parse, union, route, connect (FIXTURES.md §3)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixture_data import (PASS_MARKS, PERSON, SCORED, lines_df, p2_lines, p3_second_file, scored_lines)
from tidemark.functions.parse import parse_delimited, parse_scalar
from tidemark.operators.compose import (connect_latest, explode_routes, route, route_one, select_route,
                                        union_all)
from tidemark.sources.files import lines_of, read_lines


def test_read_lines_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in.txt")
    with open(p, "w") as f:
        f.write("a\nb b\n\nc\n")
    df = read_lines(spark, p, with_seq=True)
    assert [(r.seq, r.value) for r in df.orderBy("seq").collect()] == [(0, "a"), (1, "b b"), (2, ""), (3, "c")]


def test_read_lines_seq_across_files_and_splits(spark, tmp_dir):
    # three files of different sizes; tiny split size forces several splits per file
    expected = []
    for name, n in (("a.txt", 300), ("b.txt", 5), ("c.txt", 1200)):
        lines = [f"{name}-{i:05d}" for i in range(n)]
        expected += lines
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = read_lines(spark, tmp_dir, with_seq=True)
        assert df.rdd.getNumPartitions() > 3
        got = [(r.seq, r.value) for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(expected))


def test_lines_of_text_column(spark):
    df = spark.createDataFrame([(1, "x\r\ny\n"), (2, ""), (3, "one")], "id long, text string")
    got = sorted((r.id, r.line_no, r.value) for r in lines_of(df, "text", ("id",)).collect())
    assert got == [(1, 1, "x"), (1, 2, "y"), (3, 1, "one")]


def test_parse_person(spark):
    df = parse_delimited(lines_df(spark, p2_lines()), PERSON, char_fields=("sex",), keep=("seq",))
    rows = df.orderBy("seq").collect()
    assert [(r.id, r.sex, r.age) for r in rows] == [("1", "m", 11), ("2", "f", 16), ("3", "f", 26),
                                                  ("4", "m", 22), ("5", "m", 19)]
    assert df.schema["age"].dataType == T.IntegerType()


def test_parse_char_field_keeps_first_character_and_ignores_extra_fields(spark):
    df = parse_delimited(lines_df(spark, ["7,ann,female,30,extra"]), PERSON, char_fields=("sex",))
    r = df.collect()[0]
    assert (r.sex, r.age) == ("f", 30)


def test_parse_cut_last_at_blank_and_skip_blank(spark):
    lines = ["1,p1,m,20,168,1618838690000     2021-04-19 21:24:50", "", "   "]
    schema = T.StructType(PERSON.fields + [T.StructField("h", T.DoubleType()), T.StructField("t", T.LongType())])
    df = parse_delimited(lines_df(spark, lines), schema, cut_last_at_blank=True)
    assert [(r.h, r.t) for r in df.collect()] == [(168.0, 1618838690000)]


def test_parse_fail_mode_raises(spark):
    df = parse_delimited(lines_df(spark, ["1,a,m,x1"]), PERSON)
    with pytest.raises(Exception, match="malformed line"):
        df.collect()


def test_parse_reject_mode(spark):
    lines = ["1,a,m,11", "2,b,f,notanumber", "3,c", "4,d,m,40"]
    good, bad = parse_delimited(lines_df(spark, lines), PERSON, keep=("seq",), on_error="reject")
    assert sorted(r.id for r in good.collect()) == ["1", "4"]
    bad_rows = {r.seq: r.error for r in bad.collect()}
    assert set(bad_rows) == {2, 3}
    assert "age" in bad_rows[2] and "sex" in bad_rows[3]


def test_parse_empty_input(spark):
    df = parse_delimited(lines_df(spark, []).limit(0), PERSON)
    assert df.count() == 0


def test_union_keeps_duplicates(spark):
    a = parse_delimited(lines_df(spark, p2_lines(), with_seq=False), PERSON)
    b = parse_delimited(lines_df(spark, p3_second_file(), with_seq=False), PERSON)
    ids = sorted(r.id for r in union_all(a, b).collect())
    assert ids == ["1", "2", "2", "3", "3", "4", "5"]


def test_route_by_score(spark):
    df = parse_delimited(lines_df(spark, scored_lines() + ["6,p6,m,20,600"]), SCORED)
    rules = [("admitted", F.col("score") > 600)]
    tagged = route(df, rules, default="not admitted")
    assert sorted(r.id for r in select_route(tagged, "admitted").collect()) == ["2", "5"]
    assert sorted(r.id for r in select_route(tagged, "not admitted").collect()) == ["1", "3", "4", "6"]
    one = route_one(df, rules, default="not admitted")
    assert {r.id: r.route for r in one.collect()}["6"] == "not admitted"


def test_route_multiple_tags(spark):
    df = parse_delimited(lines_df(spark, scored_lines()), SCORED)
    tagged = route(df, [("high", F.col("score") > 600), ("men", F.col("sex") == "m")])
    got = sorted((r.id, r.route) for r in explode_routes(tagged).collect())
    assert got == [("1", "men"), ("2", "high"), ("4", "men"), ("5", "high"), ("5", "men")]


@pytest.mark.parametrize("block", [1, 2, 1 << 20])
def test_connect_latest(spark, block):
    # arrival: ids 1, 2, control 560, id 3, control 600, ids 4, 5
    students = parse_delimited(lines_df(spark, scored_lines()), SCORED, keep=("seq",))
    order = {1: 1, 2: 2, 3: 4, 4: 6, 5: 7}
    to_seq = F.create_map(*[x for k, v in order.items() for x in (F.lit(str(k)), F.lit(v))])
    subject = students.withColumn("seq", to_seq[F.col("id")].cast("long"))
    control = parse_scalar(lines_df(spark, [str(m) for m in PASS_MARKS[:2]]), "mark", keep=("seq",))
    control = control.withColumn("seq", F.when(F.col("seq") == 1, 3).otherwise(5).cast("long"))
    out = connect_latest(subject, control, "seq", "score", "mark", initial=500, block=block)
    got = [(r.seq, r.subject.id if r.subject else None, r.threshold, r.label) for r in out.orderBy("seq").collect()]
    assert got == [
        (1, "1", 500.0, "pass"),
        (2, "2", 500.0, "pass"),
        (3, None, 560.0, "change passing score"),
        (4, "3", 560.0, "not pass"),
        (5, None, 600.0, "change passing score"),
        (6, "4", 600.0, "not pass"),
        (7, "5", 600.0, "pass"),
    ]


def test_connect_latest_keyed(spark):
    subject = spark.createDataFrame([("a", 1, 10.0), ("b", 2, 10.0), ("a", 4, 10.0), ("b", 6, 10.0)],
                                    "g string, seq long, score double")
    control = spark.createDataFrame([("a", 3, 20.0), ("b", 5, 5.0)], "g string, seq long, mark double")
    out = connect_latest(subject, control, "seq", "score", "mark", initial=8.0, block=2, keys=["g"])
    got = [(r.g, r.seq, r.threshold, r.label) for r in out.orderBy("seq").collect()]
    assert got == [("a", 1, 8.0, "pass"), ("b", 2, 8.0, "pass"), ("a", 3, 20.0, "change passing score"),
                   ("a", 4, 20.0, "not pass"), ("b", 5, 5.0, "change passing score"), ("b", 6, 5.0, "pass")]
