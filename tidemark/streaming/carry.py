"""Keyed state of a stream as a log of deltas.

What a micro-batch carries to the next is one row per key.  Rewriting all keys
in every batch costs as much as the stream has keys; here a batch writes the
keys it touched and nothing else:

* micro-batch N writes a *run* with the new states of its keys (level 0);
* after every ``fan`` runs of a level they are merged into one run of the next
  level, the newest state of each key winning, so a state is rewritten once a
  level, that is about log(batches) times, and a lookup reads no more than
  ``fan`` runs a level;
* which runs are alive after N batches follows from N alone (N written to the
  base ``fan``), so there is no list of runs that could be wrong after a crash.

A batch that is replayed reads the runs that were alive before it and
overwrites its own, merges included; the inputs of a merge stay until the batch
after the next has begun, so a crash in the middle of a merge loses nothing.
Runs are stored by a hash of the key, so a lookup opens the buckets of the keys
it asks for.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

_HASH, _BUCKET, _EPOCH = "__hash", "__bucket", "__epoch"


class CarryLog:
    """States by key below ``folder``, one run per micro-batch, merged in levels."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], fan: int = 4, buckets: int = 16):
        if fan < 2:
            raise ValueError("fan must be 2 or more")
        self.spark, self.folder, self.keys, self.fan, self.buckets = spark, folder, list(keys), fan, buckets

    def runs(self, batches: int) -> list[tuple[int, int, int]]:
        """(level, first, last micro-batch) of the runs alive after so many batches, oldest first."""
        out, at = [], 0
        sizes = [1]
        while sizes[-1] * self.fan <= batches:
            sizes.append(sizes[-1] * self.fan)
        for level in reversed(range(len(sizes))):
            while at + sizes[level] <= batches:
                out.append((level, at, at + sizes[level] - 1))
                at += sizes[level]
        return out

    def path(self, run: tuple[int, int, int]) -> str:
        level, first, last = run
        return os.path.join(self.folder, f"level={level}", f"batches={first}-{last}")

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys) if self.keys else F.lit(0).cast("long")

    def _read(self, run: tuple[int, int, int], buckets: list[int] | None = None) -> DataFrame | None:
        try:
            df = self.spark.read.parquet(self.path(run))
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # written, but no key was touched
                return None
            raise RuntimeError(f"state of micro-batches {run[1]} to {run[2]} is missing: {self.path(run)}") from e
        return df if buckets is None else df.filter(F.col(_BUCKET).isin(buckets))

    def _newest(self, runs: list[DataFrame]) -> DataFrame:
        every = reduce(lambda a, b: a.unionByName(b), runs)
        state = [c for c in every.columns if c not in (*self.keys, _HASH, _BUCKET, _EPOCH)]
        held = F.struct(*[F.col(c) for c in state])
        last = every.groupBy(*self.keys, _HASH).agg(F.max_by(held, _EPOCH).alias("__s"), F.max(_EPOCH).alias(_EPOCH))
        return last.select(*self.keys, *[F.col(f"__s.{c}").alias(c) for c in state], _HASH, _EPOCH)

    def states(self, batches: int, of: DataFrame | None = None) -> DataFrame | None:
        """The newest state of every key after so many micro-batches, or of the keys in ``of`` only (None: no state yet).

        ``of`` has the key columns; its buckets (no more than ``buckets`` numbers) say which files are opened.
        """
        buckets = None
        if of is not None and self.keys:
            of = of.select(*self.keys).distinct().withColumn(_HASH, self._hash())
            buckets = [r[0] for r in of.select(F.pmod(_HASH, F.lit(self.buckets)).cast("int")).distinct().collect()]
        runs = [r for r in (self._read(run, buckets) for run in self.runs(batches)) if r is not None]
        if not runs:
            return None
        if of is not None and self.keys:
            asked = of.select(F.col(_HASH).alias("__h"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)])
            runs = [r.join(asked, (F.col(_HASH) == F.col("__h")) & same, "left_semi") for r in runs]
        return self._newest(runs).drop(_HASH, _EPOCH)

    def _write(self, df: DataFrame, run: tuple[int, int, int]) -> None:
        stored = df.withColumn(_BUCKET, F.pmod(_HASH, F.lit(self.buckets)).cast("int"))
        stored.repartition(_BUCKET).sortWithinPartitions(_BUCKET, _HASH).write.mode("overwrite").partitionBy(_BUCKET).parquet(self.path(run))

    def append(self, epoch: int, states: DataFrame) -> None:
        """Write the new states of the keys that micro-batch ``epoch`` touched, then the merges that are due."""
        self._write(states.withColumn(_HASH, self._hash()).withColumn(_EPOCH, F.lit(epoch).cast("long")), (0, epoch, epoch))
        level, size = 0, self.fan
        while (epoch + 1) % size == 0:
            part = size // self.fan
            inputs = [(level, epoch + 1 - size + i * part, epoch - size + (i + 1) * part) for i in range(self.fan)]
            level, due = level + 1, [r for r in (self._read(run) for run in inputs) if r is not None]
            merged = self._newest(due) if due else states.limit(0).withColumn(_HASH, self._hash()).withColumn(_EPOCH, F.lit(0).cast("long"))
            self._write(merged, (level, epoch + 1 - size, epoch))
            size *= self.fan

    def expire(self, epoch: int) -> list[str]:
        """Remove the runs that no batch from ``epoch`` - 1 on reads or merges; their paths."""
        if epoch < 2:
            return []
        needed = {run for n in (epoch - 1, epoch, epoch + 1) for run in self.runs(n)}
        needed |= {(0, e, e) for e in (epoch - 1, epoch)}
        # Runs that a replay of the last batch would merge again.
        size, level = 1, 0
        while epoch % (size * self.fan) == 0:
            needed |= {(level, epoch - size * self.fan + i * size, epoch - size * self.fan + (i + 1) * size - 1) for i in range(self.fan)}
            size, level = size * self.fan, level + 1
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs, gone = root.getFileSystem(conf), []
        keep = {"/".join(self.path(run).split("/")[-2:]) for run in needed}
        if not fs.exists(root):
            return []
        for level_dir in fs.listStatus(root):
            for status in fs.listStatus(level_dir.getPath()):
                name = f"{level_dir.getPath().getName()}/{status.getPath().getName()}"
                if name not in keep and name.startswith("level=") and int(name.rsplit("-", 1)[1]) < epoch:
                    fs.delete(status.getPath(), True)
                    gone.append(name)
        return gone
