"""Record layouts of comma-separated event lines (no header, no quoting).

Positions matter, names are the fields of the input records in snake case.  Several inputs carry a readable time after
the last field; parse with ``cut_last_at_blank=True`` (the dataflows in
:mod:`tidemark.plans.textjobs` do).
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()


def _layout(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Field order of each layout.
PERSON = _layout(("id", _S), ("name", _S), ("sex", _S), ("age", _I))
SCORED = _layout(*[(f.name, f.dataType) for f in PERSON.fields], ("score", _D))
CONTROL = _layout(("mark", _D))
LEFT_AT = _layout(*[(f.name, f.dataType) for f in PERSON.fields], ("out_time", _L))
MEASURED = _layout(*[(f.name, f.dataType) for f in PERSON.fields], ("height", _D))
MEASURED_AT = _layout(*[(f.name, f.dataType) for f in MEASURED.fields], ("arrive_time", _L))
GRADED_AT = _layout(("grade", _S), *[(f.name, f.dataType) for f in MEASURED_AT.fields])

CHAR_FIELDS = ("sex",)
