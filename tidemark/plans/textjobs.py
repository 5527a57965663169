"""The thirteen event-stream dataflows over text files, built from the operators.

Each function reads comma-separated lines (see :mod:`tidemark.plans.layouts`),
takes arrival order from the line order of the files (``read_lines`` numbers
lines across files in path order), and returns a DataFrame -- what the
original printed.  Run one from the shell:

    python -m tidemark <dataflow> FILE [FILE ...]

Paths may be local or cluster paths; every step is a Spark job.  Streaming
twins of the same operators live in :mod:`tidemark.streaming`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.format import message
from tidemark.functions.parse import parse_delimited, parse_scalar
from tidemark.functions.timecols import from_millis
from tidemark.operators.compose import connect_latest, explode_routes, route, union_all
from tidemark.operators.firing import early_mean, evicting_mean
from tidemark.operators.joins import interval_join
from tidemark.operators.lateness import drop_late
from tidemark.operators.running import running_argmax, running_mean
from tidemark.operators.tumbling import tumbling_extremes, tumbling_mean, tumbling_members
from tidemark.plans.layouts import (CHAR_FIELDS, GRADED_AT, LEFT_AT, MEASURED, MEASURED_AT, PERSON, SCORED)
from tidemark.sources.files import read_lines

# Parameters of the original dataflows.
PASS_MARK = 500.0
ADMIT_ABOVE = 600.0
GLOBAL_WINDOW_MS = 5
BOUND_MS = 5
FIVE_MINUTES = "5 minutes"
TEN_MINUTES = "10 minutes"
EARLY_AFTER = 3
EVICT_EVERY = 3
JOIN_LOWER, JOIN_UPPER = "-1 minute", "3 minutes"
JOIN_TEMPLATE = ("male student[id:{0},name:{1},height:{2},arriveTime:{3}] is short than "
                 "female student[id:{4},name:{5},height:{6},arriveTime:{7}]")


def _records(spark: SparkSession, paths: str | Sequence[str], layout, timed: bool = False) -> DataFrame:
    lines = read_lines(spark, paths if isinstance(paths, str) else list(paths), with_seq=True)
    df = parse_delimited(lines, layout, char_fields=CHAR_FIELDS, keep=("seq",), cut_last_at_blank=True)
    return df.withColumn("ts", from_millis(layout.fields[-1].name)) if timed else df


def print_lines(spark, path):
    """1: the lines of a file."""
    return read_lines(spark, path)


def people(spark, path):
    """2: person records (keying by sex moves rows, it does not change them)."""
    return _records(spark, path, PERSON)


def union_people(spark, path_a, path_b):
    """3: two person files as one stream, duplicates kept."""
    return union_all(_records(spark, path_a, PERSON).drop("seq"), _records(spark, path_b, PERSON).drop("seq"))


def pass_marks(spark, students, marks=None, initial=PASS_MARK):
    """4: students labelled against the latest pass mark.

    With one input, the arrival log of both: a line with a single field is a new
    pass mark, any other line a student record, and line order (across files in
    path order) is arrival order.  With two, files of students and of marks that
    were read side by side: line k of both arrived in turn, the mark first.
    """
    if marks is not None:
        log = read_lines(spark, students, with_seq=True).select("value", (F.col("seq") * 2 + 1).alias("seq"))
        subject = parse_delimited(log, SCORED, char_fields=CHAR_FIELDS, keep=("seq",))
        log = read_lines(spark, marks, with_seq=True).select("value", (F.col("seq") * 2).alias("seq"))
        return connect_latest(subject, parse_scalar(log, "mark", keep=("seq",)), "seq", "score", "mark", initial)
    lines = read_lines(spark, students, with_seq=True)
    is_mark = ~F.col("value").contains(",")
    subject = parse_delimited(lines.filter(~is_mark), SCORED, char_fields=CHAR_FIELDS, keep=("seq",))
    control = parse_scalar(lines.filter(is_mark), "mark", keep=("seq",))
    return connect_latest(subject, control, "seq", "score", "mark", initial)


def split_by_score(spark, path, above=ADMIT_ABOVE):
    """5: each student routed to "admitted" (score > 600) or "not admitted"."""
    df = _records(spark, path, SCORED)
    return explode_routes(route(df, [("admitted", F.col("score") > above)], default="not admitted"))


def global_windows(spark, path, size_ms=GLOBAL_WINDOW_MS, bound_ms=BOUND_MS):
    """6: 5 ms windows over all records, members listed; late records dropped."""
    df = _records(spark, path, LEFT_AT, timed=True)
    kept = drop_late(df, "ts", "seq", bound_ms, size_ms)
    return tumbling_members(kept, (), "ts", "seq", size_ms, cols=("id", "name"))


def oldest_by_sex(spark, path):
    """7: after every record, the oldest so far of that sex."""
    return running_argmax(_records(spark, path, PERSON), ["sex"], "seq", "age", payload=("id", "name"))


def mean_height(spark, path):
    """8: mean height per sex and 5-minute window."""
    return tumbling_mean(_records(spark, path, MEASURED_AT, timed=True), ["sex"], "ts", "height", FIVE_MINUTES)


def window_report(spark, path):
    """9: tallest and shortest per sex and 5-minute window (members: ``window_members``)."""
    df = _records(spark, path, MEASURED_AT, timed=True)
    return tumbling_extremes(df, ["sex"], "ts", "height", "seq", FIVE_MINUTES, payload=("id", "name"))


def window_members(spark, path):
    """9 (members): every window's records in arrival order."""
    df = _records(spark, path, MEASURED_AT, timed=True)
    return tumbling_members(df, ["sex"], "ts", "seq", FIVE_MINUTES, cols=("id", "name", "height"))


def running_height(spark, path):
    """10: after every record, the mean height so far of that sex."""
    return running_mean(_records(spark, path, MEASURED), ["sex"], "seq", "height")


def early_height(spark, path):
    """11: 5-minute mean per sex, reported after every row from the 4th on and at window end."""
    df = _records(spark, path, MEASURED_AT, timed=True)
    return early_mean(df, ["sex"], "ts", "height", "seq", FIVE_MINUTES, min_rows=EARLY_AFTER)


def evicting_height(spark, path):
    """12: 10-minute windows per sex, mean every 3 rows, rows below it evicted."""
    df = _records(spark, path, MEASURED_AT, timed=True)
    return evicting_mean(df, ["sex"], "ts", "height", "seq", TEN_MINUTES, every=EVICT_EVERY)


def height_join(spark, men, women):
    """13: each man with the women arriving 1 minute before to 3 minutes after him, if taller."""
    def side(path, p):
        df = _records(spark, path, GRADED_AT, timed=True).drop("seq")
        return df.select(*[F.col(c).alias(p + c) for c in df.columns])

    j = interval_join(side(men, "l_"), side(women, "r_"), "l_grade", "r_grade", "l_ts", "r_ts",
                      JOIN_LOWER, JOIN_UPPER, residual=F.col("l_height") < F.col("r_height"))
    text = message(JOIN_TEMPLATE, "l_id", "l_name", "l_height", "l_arrive_time",
                   "r_id", "r_name", "r_height", "r_arrive_time", numeric={2, 3, 6, 7})
    return j.select("l_id", "r_id", text.alias("message"))


#: Dataflows whose inputs differ in kind, and how many they take.
TWO_INPUTS = {"union": (2,), "height-join": (2,), "pass-marks": (1, 2)}

DATAFLOWS = {
    "lines": print_lines,
    "people": people,
    "union": union_people,
    "pass-marks": pass_marks,
    "split": split_by_score,
    "global-windows": global_windows,
    "oldest": oldest_by_sex,
    "mean-height": mean_height,
    "window-report": window_report,
    "window-members": window_members,
    "running-height": running_height,
    "early-height": early_height,
    "evicting-height": evicting_height,
    "height-join": height_join,
}
