"""Session settings the operators rely on.

Everything here is ordinary Spark configuration.  Two settings matter for
results, not just speed:

* ``spark.sql.session.timeZone = UTC`` -- input timestamps are stored as
  TIMESTAMP_NTZ; event-time (``withWatermark``) needs TIMESTAMP, and the cast
  between them goes through the session zone.
* the RocksDB state store provider -- ``transformWithState`` refuses the
  default provider, and the provider has to be set when the session starts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

STATE_STORE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE_PROVIDER,
    # Call-site capture for error messages costs a JVM round trip per column
    # function while plans are built; off for jobs, on for interactive debugging.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` is left to ``spark-submit`` when not given, so the same code runs
    on a cluster and in ``local[N]`` tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Event-time casts between TIMESTAMP_NTZ and TIMESTAMP assume UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A cluster must set it: a machine-local folder is not seen by executors and
    not found again by a new driver.  Only a local master without the setting
    (tests) gets a fresh local folder.  It is registered, so streaming
    checkpoints and ``DataFrame.checkpoint`` both land in the same place.
    """
    global _local_root
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        root = _local_root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_local_root: str | None = None


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Per-query streaming checkpoint folder below :func:`checkpoint_root`."""
    return os.path.join(checkpoint_root(spark), "streams", name)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    A reliable checkpoint (``DataFrame.checkpoint``) under
    ``spark.checkpoint.dir``: survives executor loss, and later plans read the
    written rows instead of recomputing an expensive input.  Runs a job now.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
