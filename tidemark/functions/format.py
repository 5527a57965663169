"""Rendering records and messages as text, as column expressions.

The message formatter being replaced prints numbers with the locale number
format: grouping separators and at most three decimals (168.0 -> ``168``,
1618838690000 -> ``1,618,838,690,000``).  ``format_number`` with the pattern
below gives the same strings inside the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the locale number pattern of the message formatter.
NUMBER_PATTERN = "#,##0.###"


def grouped_number(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.call_function("format_number", c, F.lit(NUMBER_PATTERN))


def message(template: str, *cols: str | Column, numeric: set[int] | None = None) -> Column:
    """``{0}``-style template filled from columns.

    Positions listed in ``numeric`` are printed with :func:`grouped_number`,
    the rest as strings.  Literal ``%`` in the template is kept.
    """
    numeric = numeric or set()
    args = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        args.append(grouped_number(col) if i in numeric else col.cast(T.StringType()))
    fmt = template.replace("%", "%%")
    fmt = re.sub(r"\{(\d+)\}", lambda m: f"%{int(m.group(1)) + 1}$s", fmt)
    return F.format_string(fmt, *args)


def render_record(*cols: str) -> Column:
    """A record as one JSON text (console/print sinks); null fields are written as null."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
