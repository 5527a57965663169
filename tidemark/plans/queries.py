"""Driver queries: each operator on the shipped tables, whole tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching SQL in :mod:`tidemark.plans.oracles`.

Conventions shared with the oracles:

* ``events.event_id`` is the arrival order (``seq``); on ``orders`` it is
  ``o_orderkey`` (whose dates are out of order -- that is the late-data case).
* ``events.value`` has at most two decimals; means are summed exactly as
  ``decimal(18,2)`` and divided once, so results agree to the last bit however
  the rows are partitioned.
* Prefix scans cut blocks of ``tidemark.scan.block`` rows when the session sets
  it, else of about max(2**16, sqrt(rows)) rows
  (:func:`tidemark.operators.prefix.plan_blocks`).  ``test_entry.py`` runs the
  scan queries against their oracles with many small blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.format import message, render_record
from tidemark.functions.parse import parse_delimited, parse_scalar, to_line
from tidemark.operators.compose import PASS_LABELS, connect_latest, explode_routes, route, union_all
from tidemark.operators.firing import early_mean, evicting_mean
from tidemark.operators.fold import Fold, connect_fold, keyed_process, rolling_fold
from tidemark.operators.joins import interval_join
from tidemark.operators.lateness import classify_late, drop_late
from tidemark.operators.running import running_argmax, running_mean, running_reduce
from tidemark.operators.tumbling import tumbling_agg, tumbling_extremes, tumbling_mean, tumbling_members, window_report
from tidemark.session import pin_utc
from tidemark.sources.files import lines_of, read_table

# Fixed query parameters (shared with the SQL oracles).
HOUR = "1 hour"
DAY = "1 day"
MEMBER_PART_ROWS = 4096
REPORT_PART_ROWS = 16
TOP = 3
CONNECT_INITIAL = 50.0
MARK_INITIAL_CENTS, MARK_RAISE_CENTS = 5000, 25
ROUTE_HIGH = 250.0
LATE_BOUND = "1200 days"
JOIN_LOWER, JOIN_UPPER = "-1 hour", "3 hours"
EARLY_MIN_ROWS = 3
EVICT_EVERY = 3
SCALE = 2


def _block(spark: SparkSession) -> int | None:
    """Rows of a scan block: ``tidemark.scan.block`` when the session sets it, else chosen from the row count."""
    fixed = spark.conf.get("tidemark.scan.block", None)
    return int(fixed) if fixed else None


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return read_table(spark, sf_dir, name)


def scan_lines(spark, sf_dir):
    """Every document as the lines a line reader would return."""
    return lines_of(_t(spark, sf_dir, "documents"), "text", ("doc_id",))


ORDER_LINE_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate_ms", T.LongType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def parse_orders(spark, sf_dir):
    """Orders rendered as comma lines (time as epoch ms), parsed back."""
    o = _t(spark, sf_dir, "orders")
    lines = o.select(
        to_line(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 F.unix_millis(F.col("o_orderdate").cast("timestamp")), "o_orderpriority"])
    )
    parsed = parse_delimited(lines, ORDER_LINE_SCHEMA, char_fields=("o_orderstatus",))
    return parsed.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.timestamp_millis("o_orderdate_ms").cast("timestamp_ntz").alias("o_orderdate"),
        "o_orderpriority",
    )


def parse_marks(spark, sf_dir):
    """Signup values as one-number lines (a control stream), parsed back."""
    e = _t(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    lines = e.select("event_id", F.col("value").cast("string").alias("value"))
    return parse_scalar(lines, "mark", keep=("event_id",))


def render_events(spark, sf_dir):
    """P5: every event rendered as one JSON text line."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", render_record("event_id", "event_type", "value").alias("text"))


def union_orders(spark, sf_dir):
    """Finished orders plus all orders (overlapping inputs, bag union)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return union_all(o.filter(F.col("o_orderstatus") == "F"), o)


def route_purchases(spark, sf_dir):
    """Every event tagged by ordered rules, one row per (event, tag)."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", "value")
    tagged = route(
        e,
        [("high_value", F.col("value") > ROUTE_HIGH), ("purchase", F.col("event_type") == "purchase")],
        default="other",
    )
    return explode_routes(tagged)


def connect_threshold(spark, sf_dir):
    """Purchases labelled against the latest signup value (initial 50)."""
    e = _t(spark, sf_dir, "events")
    subject = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "value")
    control = e.filter(F.col("event_type") == "signup").select("event_id", "value")
    out = connect_latest(subject, control, seq="event_id", value="value", control_value="value",
                         initial=CONNECT_INITIAL, block=_block(spark))
    return out.select("event_id", F.col("subject.user_id").alias("user_id"),
                      F.col("subject.value").alias("value"), "threshold", "label")


def window_members(spark, sf_dir):
    """Global hourly windows, members in arrival order (bounded parts)."""
    e = _t(spark, sf_dir, "events")
    m = tumbling_members(e, (), "ts", "event_id", HOUR, part_rows=MEMBER_PART_ROWS, block=_block(spark))
    return m.select("window_start", "window_end", "part", "n", _ids("members").alias("member_ids"))


def _ids(members: str) -> Column:
    return F.array_join(F.transform(members, lambda r: r["event_id"].cast("string")), ",")


def window_report_q(spark, sf_dir):
    """A1 + A3 in one result: daily windows per type with highest, lowest and all members."""
    e = _t(spark, sf_dir, "events")
    r = window_report(e, ["event_type"], "ts", "value", "event_id", DAY, part_rows=REPORT_PART_ROWS, block=_block(spark))
    return r.select(
        "event_type", "window_start", "window_end", "part", "n", "n_window",
        F.col("highest.event_id").alias("highest_id"), F.col("highest.value").alias("highest_value"),
        F.col("lowest.event_id").alias("lowest_id"), F.col("lowest.value").alias("lowest_value"), _ids("members").alias("member_ids"))


def top_values(k: int) -> Fold:
    """The ``k`` highest values so far, highest first: no order column expresses it."""
    return Fold("array<double>", lambda row: None if row["value"] is None else [row["value"]],
                lambda a, b: sorted([*a, *b], reverse=True)[:k])


def running_top(spark, sf_dir):
    """A5 with a caller's function: the three highest values so far per event type."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", "value")
    r = rolling_fold(e, ["event_type"], "event_id", ["value"], top_values(TOP), "top", block=_block(spark))
    return r.select("event_id", "event_type", "value", *[F.get("top", F.lit(i)).alias(f"top_{i + 1}") for i in range(TOP)])


#: Changes of a mark: set it, or raise it by so much.  A later set forgets what was before it.
MARK_CHANGES = Fold(
    "struct<set: boolean, cents: bigint>",
    lambda row: {"set": True, "cents": row["cents"]} if row["event_type"] == "signup" else {"set": False, "cents": MARK_RAISE_CENTS},
    lambda a, b: b if b["set"] else {"set": a["set"], "cents": a["cents"] + b["cents"]},
)


def mark_of(state) -> int:
    if state is None:
        return MARK_INITIAL_CENTS
    return state["cents"] if state["set"] else MARK_INITIAL_CENTS + state["cents"]


def connect_marks(spark, sf_dir):
    """C1 with the caller's functions: signups set the mark, errors raise it, purchases are held against it."""
    e = _t(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    subject = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "cents")
    control = e.filter(F.col("event_type").isin("signup", "error")).select("event_id", "event_type", "cents")
    out = connect_fold(
        subject, control, "event_id", MARK_CHANGES,
        lambda state, row: {"mark": mark_of(state), "label": PASS_LABELS[0] if row["cents"] >= mark_of(state) else PASS_LABELS[1]},
        lambda state, row: {"mark": mark_of(state), "label": PASS_LABELS[2]},
        "struct<mark: bigint, label: string>", block=_block(spark))
    return out.select("event_id", F.col("subject.user_id").alias("user_id"), F.col("subject.cents").alias("cents"), "result.mark", "result.label")


def running_oldest(spark, sf_dir):
    """A5: per event type, the running arg-max of value (first arrival wins ties)."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", "value")
    r = running_argmax(e, ["event_type"], "event_id", "value", block=_block(spark))
    return r.select("event_id", "event_type", "value",
                    F.col("leader.event_id").alias("leader_id"), F.col("leader.value").alias("leader_value"))


def tumbling_mean_q(spark, sf_dir):
    """Hourly mean value per event type."""
    e = _t(spark, sf_dir, "events")
    return tumbling_mean(e, ["event_type"], "ts", "value", HOUR, exact_scale=SCALE)


def tumbling_extremes_q(spark, sf_dir):
    """A3: daily highest and lowest event per type (first arrival wins ties)."""
    e = _t(spark, sf_dir, "events")
    x = tumbling_extremes(e, ["event_type"], "ts", "value", "event_id", DAY)
    return x.select(
        "event_type", "window_start", "window_end", "n",
        F.col("highest.event_id").alias("highest_id"), F.col("highest.value").alias("highest_value"),
        F.col("lowest.event_id").alias("lowest_id"), F.col("lowest.value").alias("lowest_value"),
    )


def running_lowest(spark, sf_dir):
    """A5 with a caller's order: per event type, the lowest value so far (first arrival wins ties)."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", "value")
    r = running_reduce(e, ["event_type"], "event_id", ["value"], lowest=True, block=_block(spark))
    return r.select("event_id", "event_type", "value",
                    F.col("leader.event_id").alias("leader_id"), F.col("leader.value").alias("leader_value"))


def tumbling_stats(spark, sf_dir):
    """W2 with other aggregates: daily count, exact total, range per event type."""
    e = _t(spark, sf_dir, "events")
    cents = F.col("value").cast("decimal(18,2)")
    return tumbling_agg(e, ["event_type"], "ts", DAY, n=F.count("value"), total=F.sum(cents).cast("double"),
                        least=F.min("value"), most=F.max("value"))


def running_mean_q(spark, sf_dir):
    """A6/ST1: running mean value per user, one row per event."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "value")
    r = running_mean(e, ["user_id"], "event_id", "value", exact_scale=SCALE, block=_block(spark))
    return r.select("event_id", "user_id", "n", "mean")


def streak(state, row):
    """How many of a user's events in a row were of one type, and the longest such run so far."""
    kind, n, longest = state or (None, 0, 0)
    n = n + 1 if n and row["event_type"] == kind else 1
    longest = max(longest, n)
    return [row["event_type"], n, longest], {"n": n, "longest": longest}


def user_streaks(spark, sf_dir):
    """ST1 with the caller's function: every event with its user's current and longest run of one event type."""
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    r = keyed_process(e, ["user_id"], "event_id", ["event_type"], streak, "struct<n: bigint, longest: bigint>", "run")
    return r.select("event_id", "user_id", "event_type", F.col("run.n").alias("n"), F.col("run.longest").alias("longest"))


def early_mean_q(spark, sf_dir):
    """TR1/TR3/A4: daily mean per type, early reports from the 4th row on."""
    e = _t(spark, sf_dir, "events")
    return early_mean(e, ["event_type"], "ts", "value", "event_id", DAY,
                      min_rows=EARLY_MIN_ROWS, exact_scale=SCALE, block=_block(spark))


def evicting_mean_q(spark, sf_dir):
    """E1/TR2: daily windows per type, report every 3 rows, evict below mean."""
    e = _t(spark, sf_dir, "events")
    return evicting_mean(e, ["event_type"], "ts", "value", "event_id", DAY,
                         every=EVICT_EVERY, exact_scale=SCALE)


def late_orders(spark, sf_dir):
    """Orders in key order against a 1,200-day bounded watermark."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return classify_late(o, "o_orderdate", "o_orderkey", LATE_BOUND, DAY, block=_block(spark))


def late_orders_bound0(spark, sf_dir):
    """The same against a watermark without slack (the highest time so far)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return classify_late(o, "o_orderdate", "o_orderkey", 0, DAY, block=_block(spark))


def ontime_orders_daily(spark, sf_dir):
    """T4 + W2: late orders discarded, then a daily count and exact total."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    kept = drop_late(o, "o_orderdate", "o_orderkey", LATE_BOUND, DAY, block=_block(spark))
    daily = tumbling_mean(kept, (), "o_orderdate", "o_totalprice", DAY, exact_scale=SCALE)
    return daily.select("window_start", "window_end", "n", "mean")


def _click_purchase(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    left = e.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("left_id"), F.col("user_id").alias("user_id"),
        F.col("ts").alias("left_ts"), F.col("value").alias("left_value"))
    right = e.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("right_id"), F.col("user_id").alias("right_user"),
        F.col("ts").alias("right_ts"), F.col("value").alias("right_value"))
    return interval_join(left, right, "user_id", "right_user", "left_ts", "right_ts",
                         JOIN_LOWER, JOIN_UPPER, residual=F.col("left_value") < F.col("right_value"))


def interval_join_q(spark, sf_dir):
    """Click -> purchase of the same user within [-1 h, +3 h], value rising."""
    j = _click_purchase(spark, sf_dir)
    return j.select("user_id", "left_id", "right_id", "left_ts", "right_ts", "left_value", "right_value")


# Fixed value: message template (positional placeholders, numbers grouped).
MATCH_TEMPLATE = (
    "click[id:{0},user:{1},value:{2},at:{3}] is lower than purchase[id:{4},user:{5},value:{6},at:{7}]"
)


def match_message(spark, sf_dir):
    """The joined pairs rendered as text messages."""
    j = _click_purchase(spark, sf_dir)
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    text = message(MATCH_TEMPLATE, "left_id", "user_id", "left_value", ms("left_ts"),
                   "right_id", "right_user", "right_value", ms("right_ts"), numeric=set(range(8)))
    return j.select("left_id", "right_id", text.alias("message"))


QUERIES = {
    "scan_lines": scan_lines,
    "parse_orders": parse_orders,
    "parse_marks": parse_marks,
    "render_events": render_events,
    "union_orders": union_orders,
    "route_purchases": route_purchases,
    "connect_threshold": connect_threshold,
    "connect_marks": connect_marks,
    "window_members": window_members,
    "window_report": window_report_q,
    "running_oldest": running_oldest,
    "tumbling_mean": tumbling_mean_q,
    "tumbling_extremes": tumbling_extremes_q,
    "running_lowest": running_lowest,
    "running_top": running_top,
    "tumbling_stats": tumbling_stats,
    "running_mean": running_mean_q,
    "user_streaks": user_streaks,
    "early_mean": early_mean_q,
    "evicting_mean": evicting_mean_q,
    "late_orders": late_orders,
    "late_orders_bound0": late_orders_bound0,
    "ontime_orders_daily": ontime_orders_daily,
    "interval_join": interval_join_q,
    "match_message": match_message,
}
