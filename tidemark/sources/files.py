"""Sources and sinks.

Batch: text lines and parquet tables.  Streaming: the same formats as
Structured Streaming *file* sources on a landing folder -- the unbounded line
sources of the original (network sockets) are re-aimed at files, and every
operator takes any streaming DataFrame, so a Kafka source plugs in unchanged
where its connector is installed.

Sinks: batch results are DataFrames; labelled outputs are written partitioned
by their tag; streams go to parquet / memory / console with a checkpoint in the
cluster's shared checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_location


def read_lines(spark: SparkSession, path: str, with_seq: bool = False) -> DataFrame:
    """Text file(s) -> ``value`` (one row per line, line terminators removed).

    ``with_seq`` adds ``seq``: the line number (from 0) over all files taken
    in path order, then line order -- the arrival order of reading the files
    one after another.  Spark reads splits in parallel and packs them by size,
    so the number is built, not observed:

    * every line carries its split (``_metadata.file_path`` and
      ``file_block_start``) and ``monotonically_increasing_id``, which is
      consecutive inside a split;
    * a split table (one row per split: first id, line count) gets a running
      line offset in (path, start) order -- a window over #splits rows, not
      over lines;
    * ``seq = offset + (id - first id)``.

    Deterministic for a given input, so a recomputed task gets the same numbers.
    """
    df = spark.read.text(path)
    if not with_seq:
        return df
    lines = df.select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__mid"),
    )
    splits = lines.groupBy("__file", "__start").agg(F.min("__mid").alias("__first"), F.count("*").alias("__n"))
    order = Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("__file", "__start", "__first",
                           F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__offset"))
    return lines.join(splits, ["__file", "__start"]).select(
        "value", (F.col("__offset") + F.col("__mid") - F.col("__first")).alias("seq"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables: ``{sf_dir}/{name}.parquet``, as it is on disk now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_of(df: DataFrame, text: str, id_cols: tuple[str, ...] = ()) -> DataFrame:
    """Split a text column into lines the way a line reader does.

    ``\\n`` ends a line, a trailing ``\\r`` is dropped, and a final empty piece
    after a closing newline is not a line (an empty text has no lines).  Output: ``id_cols``, ``line_no``
    (from 1) and ``value``.  Whole texts, every line.
    """
    parts = F.split(F.col(text), "\n", -1)
    n = F.size(parts)
    last_empty = F.element_at(parts, -1) == F.lit("")
    keep = F.when(last_empty, F.slice(parts, 1, n - 1)).otherwise(parts)
    v = F.col("value")
    no_cr = F.when(v.endswith("\r"), F.expr("substring(value, 1, length(value) - 1)")).otherwise(v)
    return (
        df.select(*id_cols, F.posexplode(keep).alias("pos", "value"))
        .select(*id_cols, (F.col("pos") + 1).cast("long").alias("line_no"), no_cr.alias("value"))
    )


def stream_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded line source: every new file in ``folder`` is read once."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(folder)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded parquet source over a folder or glob (schema is required)."""
    r = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


# Fixed value: an event time later than any real one (epoch ms of 2200-01-01 UTC, inside the
# nanosecond range pandas uses for timestamps in Python operators).
END_OF_INPUT_MS = 7258118400000


def mark_end_of_input(spark: SparkSession, folder: str, schema: T.StructType, ts: str, keys: dict) -> None:
    """Land one sentinel record so a bounded stream flushes its windows.

    A stream of files has no "end"; the last windows stay open until the
    watermark passes them.  The sentinel carries an event time beyond any real
    one and sentinel key values (``keys``: column -> value), so it advances the
    watermark past every real window while forming its own group, whose window
    never closes -- no output includes it.  Other columns are null.  Land it
    after the real files (it is newest, so the file source reads it last).
    """
    dtype = schema[ts].dataType
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        t = END_OF_INPUT_MS
    else:
        t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=END_OF_INPUT_MS)
    row = {f.name: None for f in schema.fields}
    row.update(keys)
    row[ts] = t
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(folder)


def write_routes(df: DataFrame, path: str, route_col: str = "route", mode: str = "overwrite") -> None:
    """Labelled sink: one folder per tag (``route=<tag>/``)."""
    df.write.mode(mode).partitionBy(route_col).parquet(path)


def start_stream(
    df: DataFrame,
    name: str,
    sink: str = "parquet",
    path: str | None = None,
    output_mode: str = "append",
    trigger: dict | None = None,
    checkpoint: str | None = None,
):
    """Start a streaming query with a checkpoint below the shared folder.

    ``sink`` is ``parquet`` (needs ``path``), ``memory`` (table ``name``) or
    ``console``.  ``trigger`` is passed to ``DataStreamWriter.trigger``
    (default: ``availableNow``).
    """
    spark = df.sparkSession
    w = (
        df.writeStream.queryName(name)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
        .trigger(**(trigger or {"availableNow": True}))
    )
    if sink == "parquet":
        if not path:
            raise ValueError("parquet sink needs a path")
        return w.format("parquet").start(path)
    return w.format(sink).start()


def stream_routes(
    df: DataFrame,
    name: str,
    path: str,
    route_col: str = "route",
    checkpoint: str | None = None,
    trigger: dict | None = None,
):
    """Labelled streaming sink: each micro-batch written by tag.

    Every epoch goes to its own ``epoch=<id>`` folder in overwrite mode, so a
    micro-batch replayed after a failure replaces its earlier partial output
    instead of duplicating it.
    """

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy(route_col).parquet(os.path.join(path, f"epoch={epoch}"))

    spark = df.sparkSession
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write_batch)
        .start()
    )


def for_each_batch(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None], checkpoint: str | None = None):
    """Generic micro-batch sink (e.g. a stream-static join refreshed per batch)."""
    spark = df.sparkSession
    return (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
        .trigger(availableNow=True)
        .foreachBatch(fn)
        .start()
    )
