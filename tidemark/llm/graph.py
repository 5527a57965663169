"""Connected groups of linked rows, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep

#: Links up to which one task works on them: shuffling so few would cost more than the work.
FEW = 100_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root``: every linked id and the smallest id it can reach.

    Alternating large-star and small-star steps: each hooks a row's neighbours
    to the smallest of them, so paths shorten geometrically while the number of
    links doesn't grow.  Each step aggregates a minimum per id (partial
    aggregation takes the heat out of hubs) and joins it back; the links are
    written to the shared folder once a step.  Links counted to be few are
    worked on in one partition, by the same steps without their shuffles.  No links give no rows; links of a
    row to itself and repeated links are harmless.
    """
    def star(e: DataFrame, large: bool, few: bool) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if few:
            both = both.coalesce(1)
        if not large:
            both = both.filter("b <= a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        if large:
            return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        # A row is among its own smaller neighbours too: (a, a) makes the link from a to the least.
        return joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").filter("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = keep(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct())
    seen = state(edges)
    while seen[0]:
        few = seen[0] <= FEW
        edges = keep(star(star(edges, True, few), False, few))
        now = state(edges)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("id"), "root")).groupBy("id").agg(F.min("root").alias("root"))
