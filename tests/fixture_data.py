"""The worked examples of FIXTURES.md as comma-separated lines.

Names are placeholders (``p<id>``); every value that decides a result -- ids,
sex, age, score, height, times -- is the fixture's.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixture times (epoch ms).
T0 = 1618838690000  # 2021-04-19 13:24:50 UTC; row n of L6/L7 files is T0 + n minutes
T6 = 1614697662000  # row n of the L4 file is T6 + n ms
MINUTE = 60_000

# Fixture vectors, in row order.
SEX_P2 = "m f f m m".split()
AGE_P2 = [11, 16, 26, 22, 19]
SEX_P7 = "m f f m m m f f m m m".split()
AGE_P7 = [11, 16, 26, 22, 19, 17, 18, 15, 12, 20, 27]
SCORES = [552, 649, 470, 583, 606]
PASS_MARKS = [560, 600, 650]
SEX_P9 = "m f f m m m f f m m m m".split()
HEIGHTS = [168, 162, 173, 186, 178, 171, 169, 161, 158, 170, 175, 155]
HEIGHTS_P12 = HEIGHTS + [172, 175, 148, 176, 159]
MEN_IDS = [1, 3, 4, 6, 10, 11, 13, 14, 15, 20, 22, 23, 24, 25, 27, 28, 32]
MEN_H = [168, 173, 167, 186, 178, 171, 182, 161, 188, 173, 175, 155, 172, 175, 148, 176, 159]
WOMEN_IDS = [2, 5, 7, 8, 9, 12, 16, 17, 18, 19, 21, 26, 29, 30, 31, 33, 34]
WOMEN_H = [168, 177, 179, 185, 172, 165, 169, 181, 158, 170, 175, 146, 183, 177, 176, 191, 138]


def readable(ms: int) -> str:
    """The human-readable time some fixture lines carry after the last field."""
    import datetime as dt

    return (dt.datetime.fromtimestamp(ms / 1000, dt.UTC) + dt.timedelta(hours=8)).strftime("%Y-%m-%d %H:%M:%S")


def person_lines(sexes, ages, start_id=1):
    return [f"{i},p{i},{s},{a}" for i, (s, a) in enumerate(zip(sexes, ages), start=start_id)]


def p2_lines():
    return person_lines(SEX_P2, AGE_P2)


def p3_second_file():
    return p2_lines()[1:3]


def scored_lines():
    return [f"{i},p{i},{s},{a},{sc}" for i, (s, a, sc) in enumerate(zip(SEX_P2, AGE_P2, SCORES), start=1)]


def left_at_lines(n=11):
    return [f"{i},p{i},m,20,{T6 + i - 1}" for i in range(1, n + 1)]


def measured_at_lines(sexes, heights, with_readable=True):
    out = []
    for n, (s, h) in enumerate(zip(sexes, heights)):
        t = T0 + n * MINUTE
        line = f"{n + 1},p{n + 1},{s},20,{h},{t}"
        out.append(line + (f"     {readable(t)}" if with_readable else ""))
    return out


def graded_lines(ids, heights, sex):
    return [f"302,{i},p{i},{sex},20,{h},{T0 + n * MINUTE}     {readable(T0 + n * MINUTE)}"
            for n, (i, h) in enumerate(zip(ids, heights))]


PERSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("age", T.IntegerType()),
])
SCORED = T.StructType(PERSON.fields + [T.StructField("score", T.DoubleType())])
LEFT_AT = T.StructType(PERSON.fields + [T.StructField("out_time", T.LongType())])
MEASURED = T.StructType(PERSON.fields + [T.StructField("height", T.DoubleType())])
MEASURED_AT = T.StructType(MEASURED.fields + [T.StructField("arrive_time", T.LongType())])
GRADED_AT = T.StructType([T.StructField("grade", T.StringType())] + MEASURED_AT.fields)


def lines_df(spark, lines, with_seq=True):
    """Lines as a DataFrame ``(seq, value)``; ``seq`` = line number from 1."""
    rows = [(i + 1, v) for i, v in enumerate(lines)]
    df = spark.createDataFrame(rows, "seq long, value string")
    return df if with_seq else df.select("value")
