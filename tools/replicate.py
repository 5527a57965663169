"""Derive a larger copy of the driver tables the queries read, for scaling runs.

    python tools/replicate.py SRC_DIR DST_DIR COPIES

Every table is repeated ``COPIES`` times with its key shifted by a per-copy
offset (so keys stay unique and ascending-key arrival order is kept) and, for
``events``, time shifted by 30 days per copy (the source spans 30 days), so
copies follow each other like a longer recording.  Users, event types and order
dates repeat, which makes each key ``COPIES`` times hotter.  Written with Spark
as parquet folders named like the source files, so ``bench.py`` reads them
unchanged.  Scratch data only -- never part of the repository.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.session import get_session  # noqa: E402

KEYS = {"events": "event_id", "orders": "o_orderkey", "documents": "doc_id"}


def main() -> None:
    src, dst, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = get_session("local[8]", shuffle_partitions=8)
    for name, key in KEYS.items():
        df = spark.read.parquet(os.path.join(src, f"{name}.parquet"))
        span = df.agg(F.max(key)).first()[0] + 1
        out = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        out = out.withColumn(key, F.col(key) + F.col("__copy") * F.lit(span))
        if name == "events":
            out = out.withColumn("ts", F.col("ts") + F.make_dt_interval(F.col("__copy") * F.lit(30)))
        out.drop("__copy").repartition(8 * copies // 10 or 1).write.mode("overwrite").parquet(
            os.path.join(dst, f"{name}.parquet"))
    spark.stop()


if __name__ == "__main__":
    main()
