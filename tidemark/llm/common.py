"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handled at once inside a Python task: bounds the Python objects alive, whatever the Arrow batch size is.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file (a parameter everywhere; the files are never copied)."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of an Arrow batch: whole texts are long, and a batch is held on both sides of the pipe.
BATCH_ROWS = 1024


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` again; its session's Arrow batches hold no more than ``BATCH_ROWS`` rows from now on."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, null text as empty; other columns, whatever their names, stay behind."""
    return small_batches(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` over bounded slices; ``fn`` turns one slice into one batch."""

    def run(batches):
        for b in slices(batches):
            yield fn(b)

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a fresh local one only where it is unset (tests on a local master)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-llm-"))
        return sc.getCheckpointDir()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


class Scratch:
    """A folder below the shared one for what is computed once; it goes when nothing reads it any more."""

    def __init__(self, spark):
        self.spark, self.path = spark, f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"

    def written(self, df: DataFrame) -> DataFrame:
        """``df`` as Parquet; what was shuffled for it leaves the disk, later reads survive lost executors."""
        key, path = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", f"{self.path}/{uuid.uuid4().hex}"
        was = self.spark.conf.get(key, "false")
        self.spark.conf.set(key, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(key, was)
        return self.spark.read.parquet(path)

    def drop(self) -> None:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def keep(df: DataFrame) -> DataFrame:
    """Computed once into the shared folder; later reads survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
