"""Time the scalable forms against the plain ones.

    python tools/compare_forms.py [sf_dir] [copies]

``events`` is replicated ``copies`` times (event ids shifted per copy, so ids
stay unique and arrival order is kept) to get a table where per-key skew
matters: five event types, one running frame each in the plain form.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.joins import interval_join  # noqa: E402
from tidemark.operators.prefix import running, running_plain  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = get_session("local[8]", shuffle_partitions=8)
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    span = ev.agg(F.max("event_id")).first()[0] + 1
    big = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .withColumn("event_id", F.col("event_id") + F.col("copy") * F.lit(span))
           .withColumn("ts", F.col("ts") + F.make_dt_interval(F.col("copy") * F.lit(30)))
           .drop("copy"))
    n = big.count()
    aggs = {"s": ("sum", F.col("value").cast("decimal(18,2)")), "n": ("sum", F.lit(1).cast("long"))}
    res = {"rows": n}
    res["running_plain_by_type"] = timed(running_plain(big, "event_id", aggs, keys=["event_type"]))
    res["running_prefix_by_type_block_65536"] = timed(running(big, "event_id", aggs, keys=["event_type"],
                                                              block=65536))
    res["running_plain_global"] = timed(running_plain(big, "event_id", aggs))
    res["running_prefix_global_block_65536"] = timed(running(big, "event_id", aggs, block=65536))
    left = big.filter("event_type = 'click'").select(
        F.col("event_id").alias("lid"), F.col("user_id").alias("lu"), F.col("ts").alias("lts"),
        F.col("value").alias("lv"))
    right = big.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("rid"), F.col("user_id").alias("ru"), F.col("ts").alias("rts"),
        F.col("value").alias("rv"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for method in ("plain", "bucketed"):
        j = interval_join(left, right, "lu", "ru", "lts", "rts", "-1 hour", "3 hours",
                          residual=F.col("lv") < F.col("rv"), method=method)
        res[f"interval_join_{method}_smj"] = timed(j)
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
