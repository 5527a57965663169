"""Running results on a stream, one distributed prefix scan per micro-batch.

The keyed-state processors (:mod:`tidemark.streaming.processors`) send every
row of a key through one task; with one global control value, or a key that
holds a third of the stream, that is one task for most of the data.  Here each
micro-batch is scanned like a batch table -- blocks of ``seq``, partial
aggregates, one shuffle -- and the only thing carried from batch to batch is a
state per key, the aggregates so far.

Per micro-batch ``N`` (``foreachBatch``):

1. look up the states of the batch's keys after batch ``N - 1`` (none for the first batch);
2. output = the operator's scan over the batch, seeded with those states,
   written to ``<path>/epoch=N`` (overwrite);
3. the new states of the batch's keys go to the log of states in
   ``<the query's checkpoint>/carry`` (:class:`tidemark.streaming.carry.CarryLog`):
   keys that the batch doesn't have are neither read nor written.

A batch that is replayed after a failure looks up the same states and overwrites
the same folders, so output and states stay exactly-once.  Order: rows of
earlier micro-batches come first, then ``seq`` order inside the batch.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.compose import connect_latest_spec
from tidemark.operators.fold import FoldSpec
from tidemark.operators.lateness import classify_late_spec
from tidemark.operators.prefix import DEFAULT_BLOCK, ScanSpec
from tidemark.operators.running import running_argmax_spec, running_mean_spec
from tidemark.session import checkpoint_location
from tidemark.streaming.carry import CarryLog


def stream_scan(
    spec: ScanSpec | FoldSpec,
    name: str,
    path: str,
    block: int | None = DEFAULT_BLOCK,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    carry_fan: int = 4,
    carry_buckets: int = 16,
):
    """Run ``spec`` (built on a streaming DataFrame) micro-batch by micro-batch.

    ``carry_fan`` runs of states are merged into one, ``carry_buckets`` files make
    a run; :func:`carry_log` reads the states of a query by key.
    """
    spark = spec.frame.sparkSession
    checkpoint = checkpoint or checkpoint_location(spark, name)

    def one_batch(batch: DataFrame, epoch: int) -> None:
        log = carry_log(batch.sparkSession, checkpoint, spec.keys, carry_fan, carry_buckets)
        log.expire(epoch)
        batch = batch.persist()
        try:
            carry = log.states(epoch, batch if spec.keys else None) if epoch else None
            spec.run(block, carry=carry, frame=batch).write.mode("overwrite").parquet(
                os.path.join(path, f"epoch={epoch}"))
            log.append(epoch, spec.totals(batch, carry))
        finally:
            batch.unpersist()

    return (
        spec.frame.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(one_batch)
        .start()
    )


def carry_log(spark: SparkSession, checkpoint: str, keys: Sequence[str], fan: int = 4, buckets: int = 16) -> CarryLog:
    """The states that a query with this checkpoint folder carries; goes wherever the query's own state goes."""
    return CarryLog(spark, os.path.join(checkpoint, "carry"), keys, fan, buckets)


def stream_running_mean_scan(df, keys, seq, value, name, path, exact_scale=None, block=DEFAULT_BLOCK, **kw):
    """:func:`tidemark.operators.running.running_mean` on a stream."""
    return stream_scan(running_mean_spec(df, keys, seq, value, exact_scale), name, path, block, **kw)


def stream_running_argmax_scan(df, keys, seq, value, name, path, payload=(), block=DEFAULT_BLOCK, **kw):
    """:func:`tidemark.operators.running.running_argmax` on a stream."""
    return stream_scan(running_argmax_spec(df, keys, seq, value, payload), name, path, block, **kw)


def stream_connect_latest_scan(subject, control, seq, value, control_value, initial, name, path,
                               keys=(), block=DEFAULT_BLOCK, **kw):
    """:func:`tidemark.operators.compose.connect_latest` on two streams."""
    spec = connect_latest_spec(subject, control, seq, value, control_value, initial, keys=keys)
    return stream_scan(spec, name, path, block, **kw)


def stream_classify_late_scan(df, ts, seq, bound, size, name, path, keys=(), block=DEFAULT_BLOCK, **kw):
    """:func:`tidemark.operators.lateness.classify_late` on a stream."""
    return stream_scan(classify_late_spec(df, ts, seq, bound, size, keys), name, path, block, **kw)
