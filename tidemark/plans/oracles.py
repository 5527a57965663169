"""DuckDB SQL for every driver query, over the same parquet tables.

Column names match :mod:`tidemark.plans.queries`.  Windows are computed with
epoch arithmetic (``epoch_us`` / ``make_timestamp``) because that is the
alignment Spark's ``window`` uses.  Means follow the decimal rule of the
queries: ``CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count``.
"""

from __future__ import annotations

HOUR_US = 3_600_000_000
DAY_US = 86_400_000_000


def _win(ts: str, width_us: int) -> tuple[str, str]:
    start = f"make_timestamp((epoch_us({ts}) // {width_us}) * {width_us})"
    end = f"make_timestamp((epoch_us({ts}) // {width_us}) * {width_us} + {width_us})"
    return start, end


_HS, _HE = _win("ts", HOUR_US)
_DS, _DE = _win("ts", DAY_US)
_OS, _OE = _win("o_orderdate", DAY_US)

SCAN_LINES = """
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
q AS (
  SELECT doc_id,
         CASE WHEN parts[len(parts)] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts
  FROM p),
r AS (SELECT doc_id, unnest(generate_series(1, len(parts))) AS line_no, unnest(parts) AS v FROM q)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
       CASE WHEN suffix(v, chr(13)) THEN v[1:length(v) - 1] ELSE v END AS value
FROM r
"""

PARSE_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
"""

PARSE_MARKS = """
SELECT event_id, value AS mark FROM events WHERE event_type = 'signup'
"""

RENDER_EVENTS = """
SELECT event_id, CAST(to_json(struct_pack(event_id := event_id, event_type := event_type, value := value))
                      AS VARCHAR) AS text
FROM events
"""

UNION_ORDERS = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
"""

ROUTE_PURCHASES = """
SELECT event_id, event_type, value, 'high_value' AS route FROM events WHERE value > 250.0
UNION ALL
SELECT event_id, event_type, value, 'purchase' AS route FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, event_type, value, 'other' AS route FROM events
WHERE NOT coalesce(value > 250.0, false) AND NOT coalesce(event_type = 'purchase', false)
"""

CONNECT_THRESHOLD = """
WITH u AS (
  SELECT event_id, user_id, value, CAST(NULL AS DOUBLE) AS ctl, false AS is_ctl FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT event_id, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), value, true FROM events WHERE event_type = 'signup'),
s AS (
  SELECT *, coalesce(last_value(ctl IGNORE NULLS) OVER (
      ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 50.0) AS threshold
  FROM u)
SELECT event_id, user_id, value, threshold,
       CASE WHEN is_ctl THEN 'change passing score'
            WHEN value >= threshold THEN 'pass' ELSE 'not pass' END AS label
FROM s
"""

CONNECT_MARKS = """
WITH u AS (
  SELECT event_id, event_type, user_id, CAST(round(value * 100) AS BIGINT) AS cents,
         count(*) FILTER (event_type = 'signup') OVER (ORDER BY event_id) AS era
  FROM events WHERE event_type IN ('purchase', 'signup', 'error')),
m AS (
  SELECT *, coalesce(max(CASE WHEN event_type = 'signup' THEN cents END) OVER (PARTITION BY era), 5000)
         + 25 * count(*) FILTER (event_type = 'error') OVER (PARTITION BY era ORDER BY event_id) AS mark
  FROM u)
SELECT event_id, CASE WHEN event_type = 'purchase' THEN user_id END AS user_id,
       CASE WHEN event_type = 'purchase' THEN cents END AS cents, CAST(mark AS BIGINT) AS mark,
       CASE WHEN event_type <> 'purchase' THEN 'change passing score'
            WHEN cents >= mark THEN 'pass' ELSE 'not pass' END AS label
FROM m
"""

WINDOW_MEMBERS = f"""
WITH x AS (
  SELECT {_HS} AS window_start, {_HE} AS window_end, event_id,
         row_number() OVER (PARTITION BY {_HS} ORDER BY event_id) AS place
  FROM events)
SELECT window_start, window_end, (place - 1) // 4096 AS part,
       count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS member_ids
FROM x GROUP BY ALL
"""

WINDOW_REPORT = f"""
WITH x AS (
  SELECT event_type, {_DS} AS window_start, {_DE} AS window_end, event_id, value,
         row_number() OVER (PARTITION BY event_type, {_DS} ORDER BY event_id) AS place
  FROM events),
w AS (
  SELECT event_type, window_start, count(*) AS n_window,
         arg_max(event_id, (value, -event_id)) AS highest_id, max(value) AS highest_value,
         arg_min(event_id, (value, event_id)) AS lowest_id, min(value) AS lowest_value
  FROM x GROUP BY ALL),
p AS (
  SELECT event_type, window_start, window_end, (place - 1) // 16 AS part, count(*) AS n,
         string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS member_ids
  FROM x GROUP BY ALL)
SELECT p.event_type, p.window_start, window_end, part, n, n_window, highest_id, highest_value, lowest_id, lowest_value, member_ids
FROM p JOIN w ON p.event_type IS NOT DISTINCT FROM w.event_type AND p.window_start = w.window_start
"""

RUNNING_TOP = """
WITH l AS (
  SELECT event_id, event_type, value,
         list_reverse_sort(list(value) FILTER (value IS NOT NULL) OVER (
             PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS top
  FROM events)
SELECT event_id, event_type, value, top[1] AS top_1, top[2] AS top_2, top[3] AS top_3 FROM l
"""

RUNNING_OLDEST = """
SELECT event_id, event_type, value,
       arg_max(event_id, (value, -event_id)) OVER w AS leader_id,
       max(value) OVER w AS leader_value
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

RUNNING_LOWEST = """
SELECT event_id, event_type, value,
       arg_min(event_id, (value, event_id)) OVER w AS leader_id,
       min(value) OVER w AS leader_value
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

TUMBLING_STATS = f"""
SELECT event_type, {_DS} AS window_start, {_DE} AS window_end, count(value) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(value) AS least, max(value) AS most
FROM events GROUP BY ALL
"""

TUMBLING_MEAN = f"""
SELECT event_type, {_HS} AS window_start, {_HE} AS window_end, count(value) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean
FROM events GROUP BY ALL
"""

TUMBLING_EXTREMES = f"""
SELECT event_type, {_DS} AS window_start, {_DE} AS window_end, count(*) AS n,
       arg_max(event_id, (value, -event_id)) AS highest_id, max(value) AS highest_value,
       arg_min(event_id, (value, event_id)) AS lowest_id, min(value) AS lowest_value
FROM events GROUP BY ALL
"""

RUNNING_MEAN = """
SELECT event_id, user_id, count(*) OVER w AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS mean
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

USER_STREAKS = """
WITH c AS (
  SELECT event_id, user_id, event_type,
         CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id) AS part FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, part ORDER BY event_id) AS n FROM g)
SELECT event_id, user_id, event_type, n,
       max(n) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS longest
FROM n
"""

EARLY_MEAN = f"""
WITH x AS (
  SELECT event_type, {_DS} AS window_start, {_DE} AS window_end, event_id,
         CAST(value AS DECIMAL(18,2)) AS v FROM events),
r AS (
  SELECT *, count(*) OVER w AS n, sum(v) OVER w AS s FROM x
  WINDOW w AS (PARTITION BY event_type, window_start ORDER BY event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_type, window_start, window_end, 'early' AS firing, event_id AS at_seq, n,
       CAST(s AS DOUBLE) / n AS mean
FROM r WHERE n > 3
UNION ALL
SELECT event_type, window_start, window_end, 'final' AS firing, max(event_id) AS at_seq, count(*) AS n,
       CAST(sum(v) AS DOUBLE) / count(*) AS mean
FROM x GROUP BY ALL
"""

# The evictor is an ordered fold: blocks of three rows per (type, day), each
# report over survivors + block, survivors = rows not below the mean.
EVICTING_MEAN = f"""
WITH RECURSIVE x AS (
  SELECT event_type, {_DS} AS ws, {_DE} AS we, event_id, CAST(value AS DECIMAL(18,2)) AS v,
         row_number() OVER (PARTITION BY event_type, {_DS} ORDER BY event_id) AS rn
  FROM events),
blocks AS (
  SELECT event_type, ws, we, (rn - 1) // 3 AS b, list(v ORDER BY rn) AS vs,
         max(event_id) AS last_id, count(*) AS k
  FROM x GROUP BY event_type, ws, we, (rn - 1) // 3),
fold AS (
  SELECT event_type, ws, we, b, k, last_id, vs AS contents,
         CAST(list_sum(vs) AS DOUBLE) / len(vs) AS m
  FROM blocks WHERE b = 0
  UNION ALL
  SELECT g.event_type, g.ws, g.we, g.b, g.k, g.last_id, c.contents,
         CAST(list_sum(c.contents) AS DOUBLE) / len(c.contents) AS m
  FROM fold f
  JOIN blocks g ON g.event_type = f.event_type AND g.ws = f.ws AND g.b = f.b + 1
  CROSS JOIN LATERAL (
    SELECT list_concat(
             CASE WHEN f.k = 3 THEN list_filter(f.contents, lambda y: CAST(y AS DOUBLE) >= f.m) ELSE f.contents END,
             g.vs) AS contents) c
),
last AS (
  SELECT f.*,
         CASE WHEN f.k = 3 THEN list_filter(f.contents, lambda y: CAST(y AS DOUBLE) >= f.m) ELSE f.contents END AS rest
  FROM fold f
  JOIN (SELECT event_type, ws, max(b) AS mb FROM blocks GROUP BY ALL) t
    ON t.event_type = f.event_type AND t.ws = f.ws AND t.mb = f.b)
SELECT event_type, ws AS window_start, we AS window_end, CAST(b + 1 AS INTEGER) AS firing, 'count' AS kind,
       last_id AS at_seq, CAST(len(contents) AS BIGINT) AS n, m AS mean
FROM fold WHERE k = 3
UNION ALL
SELECT event_type, ws AS window_start, we AS window_end,
       CAST(b + 1 + CASE WHEN k = 3 THEN 1 ELSE 0 END AS INTEGER) AS firing, 'final' AS kind,
       last_id AS at_seq, CAST(len(rest) AS BIGINT) AS n, CAST(list_sum(rest) AS DOUBLE) / len(rest) AS mean
FROM last WHERE len(rest) > 0
"""

LATE_ORDERS = f"""
WITH x AS (
  SELECT o_orderkey, o_orderdate, {_OS} AS window_start, {_OE} AS window_end,
         max(epoch_us(o_orderdate)) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - 1200 * {DAY_US} AS wm
  FROM orders)
SELECT o_orderkey, o_orderdate, window_start, window_end, make_timestamp(wm) AS wm_before,
       coalesce(epoch_us(window_end) - 1000 <= wm, false) AS is_late
FROM x
"""

LATE_ORDERS_BOUND0 = LATE_ORDERS.replace(f"- 1200 * {DAY_US} AS wm", "AS wm")

ONTIME_ORDERS_DAILY = f"""
WITH x AS (
  SELECT o_orderdate, o_totalprice, {_OE} AS window_end,
         max(epoch_us(o_orderdate)) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - 1200 * {DAY_US} AS wm
  FROM orders)
SELECT {_OS} AS window_start, {_OE} AS window_end, count(o_totalprice) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS mean
FROM x WHERE NOT coalesce(epoch_us(window_end) - 1000 <= wm, false)
GROUP BY ALL
"""

_JOIN = """
SELECT l.user_id, l.event_id AS left_id, r.event_id AS right_id, r.user_id AS right_user,
       l.ts AS left_ts, r.ts AS right_ts, l.value AS left_value, r.value AS right_value
FROM events l JOIN events r
  ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL 1 HOUR AND l.ts + INTERVAL 3 HOUR
 AND l.value < r.value
WHERE l.event_type = 'click' AND r.event_type = 'purchase'
"""

INTERVAL_JOIN = f"""
SELECT user_id, left_id, right_id, left_ts, right_ts, left_value, right_value FROM ({_JOIN})
"""


def _num(x: str) -> str:
    """Grouped number with at most three decimals, as the message formatter prints it."""
    return f"regexp_replace(format('{{:,.3f}}', CAST({x} AS DOUBLE)), '\\.?0+$', '')"


def _int(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


MATCH_MESSAGE = f"""
SELECT left_id, right_id,
  'click[id:' || {_int('left_id')} || ',user:' || {_int('user_id')} || ',value:' || {_num('left_value')}
  || ',at:' || {_int('epoch_us(left_ts) // 1000')} || '] is lower than purchase[id:' || {_int('right_id')}
  || ',user:' || {_int('right_user')} || ',value:' || {_num('right_value')}
  || ',at:' || {_int('epoch_us(right_ts) // 1000')} || ']' AS message
FROM ({_JOIN})
"""

ORACLES = {
    "scan_lines": SCAN_LINES,
    "parse_orders": PARSE_ORDERS,
    "parse_marks": PARSE_MARKS,
    "render_events": RENDER_EVENTS,
    "union_orders": UNION_ORDERS,
    "route_purchases": ROUTE_PURCHASES,
    "connect_threshold": CONNECT_THRESHOLD,
    "connect_marks": CONNECT_MARKS,
    "window_members": WINDOW_MEMBERS,
    "window_report": WINDOW_REPORT,
    "running_oldest": RUNNING_OLDEST,
    "tumbling_mean": TUMBLING_MEAN,
    "tumbling_extremes": TUMBLING_EXTREMES,
    "running_lowest": RUNNING_LOWEST,
    "running_top": RUNNING_TOP,
    "tumbling_stats": TUMBLING_STATS,
    "running_mean": RUNNING_MEAN,
    "user_streaks": USER_STREAKS,
    "early_mean": EARLY_MEAN,
    "evicting_mean": EVICTING_MEAN,
    "late_orders": LATE_ORDERS,
    "late_orders_bound0": LATE_ORDERS_BOUND0,
    "ontime_orders_daily": ONTIME_ORDERS_DAILY,
    "interval_join": INTERVAL_JOIN,
    "match_message": MATCH_MESSAGE,
}
