"""tidemark: event-stream analytics operators on Spark DataFrames.

Every operator takes and returns a DataFrame; see README.md for the list.
"""

from tidemark.functions.format import grouped_number, message, render_record
from tidemark.functions.parse import parse_delimited, parse_scalar, to_line
from tidemark.functions.timecols import event_time, from_millis
from tidemark.operators.compose import (connect_latest, explode_routes, route, route_one, select_route,
                                        threshold_label, union_all)
from tidemark.operators.firing import early_mean, evicting_mean
from tidemark.operators.joins import interval_join
from tidemark.operators.lateness import classify_late, drop_late
from tidemark.operators.prefix import running, running_totals
from tidemark.operators.running import running_argmax, running_mean
from tidemark.operators.tumbling import tumbling_extremes, tumbling_mean, tumbling_members
from tidemark.session import get_session
from tidemark.sources.files import (lines_of, read_lines, read_table, start_stream, stream_lines, stream_routes,
                                    stream_table, write_routes)

__all__ = [
    "classify_late", "connect_latest", "drop_late", "early_mean", "event_time", "evicting_mean", "explode_routes",
    "from_millis", "get_session", "grouped_number", "interval_join", "lines_of", "message", "parse_delimited",
    "parse_scalar", "read_lines", "read_table", "render_record", "route", "route_one", "running",
    "running_argmax", "running_mean", "running_totals", "select_route", "start_stream", "stream_lines",
    "stream_routes", "stream_table", "threshold_label", "to_line", "tumbling_extremes", "tumbling_mean",
    "tumbling_members", "union_all", "write_routes",
]
