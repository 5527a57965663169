"""Centroid clustering, nearest centroids found by the threshold algorithm.

A vector's nearest centroid is found without comparing it with them all first.
Per dimension the centroids stand in a list sorted by their value there.  From
the vector's own value each list is walked outward, the nearer side first; a
centroid met for the first time in any list gets its exact distance.  No
centroid that has not been met can be nearer than the sum, over the dimensions,
of the squared distances at which the walks stand, so a vector is done when that
sum strictly exceeds the best exact distance: an unmet centroid at the very same
distance could still have a smaller number.

Components are integers, so distances, sums and floors are exact and don't
depend on how rows are dealt out.  Each round is one pass over the vectors: a
task folds its rows into one sum a centroid, and Spark adds those up.  Only the
centroids themselves (``clusters`` x ``dims`` integers) pass the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep, slices, table

#: Rows walked at once: bounds the arrays of a walk (rows x dimensions and rows x centroids).
WALK_ROWS = 1024


@dataclass(frozen=True)
class Settings:
    clusters: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    seed: str = "1"
    #: Integer components beyond this would give distances that no long holds: such vectors take no part.
    largest: int = 1 << 27


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of each row (ties: the smaller), its squared distance, and how many
    exact distances that took."""
    n, dims = x.shape
    k = len(centroids)
    span = int(max(np.abs(x).max(initial=0), np.abs(centroids).max()))
    kind = np.int32 if dims * (2 * span) ** 2 < 1 << 31 else np.int64  # both exact
    x, c = x.astype(kind), centroids.astype(kind)
    order = np.argsort(c, axis=0, kind="stable")
    lists = np.take_along_axis(c, order, 0)
    dim = np.arange(dims)
    high = np.stack([np.searchsorted(lists[:, d], x[:, d]) for d in dim], axis=1) if n else np.zeros((0, dims), np.int64)
    low = high - 1
    far = np.iinfo(np.int64).max
    distance = np.full((n, k), far, np.int64)
    rows, scored = np.arange(n), 0
    for _ in range(k):
        if not len(rows):
            break
        a, lo, hi = x[rows], low[rows], high[rows]
        below = np.abs(a - lists[np.maximum(lo, 0), dim])
        above = np.abs(lists[np.minimum(hi, k - 1), dim] - a)
        down = (hi >= k) | ((lo >= 0) & (below <= above))
        met = np.zeros((len(rows), k), bool)
        met[np.arange(len(rows))[:, None], order[np.where(down, lo, hi), dim]] = True
        at, which = np.nonzero(met & (distance[rows] == far))
        gap = a[at] - c[which]
        distance[rows[at], which] = np.einsum("ij,ij->i", gap, gap, dtype=np.int64)
        scored += len(at)
        step = np.where(down, below, above)
        frontier = np.einsum("ij,ij->i", step, step, dtype=np.int64)
        low[rows], high[rows] = lo - down, hi + ~down
        best = distance[rows].min(axis=1)
        whole = (distance[rows] < far).all(axis=1)  # every centroid was met: nothing is left to find
        rows = rows[~((frontier > best) | whole)]
    label = distance.argmin(axis=1) if n else np.zeros(0, np.int64)
    return label, distance[np.arange(n), label], scored


def _integers(b: pa.RecordBatch, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that take part, and their integer components."""
    vec = b["vec"]
    whole = np.asarray(pa.compute.equal(pa.compute.list_value_length(vec), settings.dims).fill_null(False))
    whole = np.flatnonzero(whole)
    flat = pa.compute.list_flatten(vec.take(pa.array(whole, pa.int64()))).cast(pa.float64())
    values = np.asarray(flat.fill_null(np.nan)).reshape(-1, settings.dims)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(settings.scale * values)
        fits = (np.isfinite(values) & (np.abs(x) <= settings.largest)).all(axis=1)
    return whole[fits], x[fits].astype(np.int64)


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))


def start(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The kept vectors whose ids have the smallest hashes, as integers; no more than ``clusters`` rows come to the driver."""

    def run(batches):
        for b in slices(batches, WALK_ROWS):
            rows, x = _integers(b, settings)
            yield pa.RecordBatch.from_arrays([b["vec_id"].take(pa.array(rows, pa.int64())), pa.array(list(x), pa.list_(pa.int64()))], ["vec_id", "x"])

    first = vectors.filter("vec_id IS NOT NULL").mapInArrow(run, "vec_id long, x array<long>")
    hashed = F.sha2(F.concat(F.lit(settings.seed + ":"), F.col("vec_id").cast("string")), 256)
    got = first.orderBy(hashed, "x").limit(settings.clusters).collect()
    return np.array([r["x"] for r in got], np.int64).reshape(-1, settings.dims)


def assign(vectors: DataFrame, centroids: np.ndarray, settings: Settings) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector that takes part."""

    def run(batches):
        for b in slices(batches, WALK_ROWS):
            rows, x = _integers(b, settings)
            label, distance, _ = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"].take(pa.array(rows, pa.int64())), pa.array(label, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray, settings: Settings) -> np.ndarray:
    """Centroids after one round: the floor of their vectors' mean; those without vectors stay."""
    k = len(centroids)

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, settings.dims), np.int64)
        for b in slices(batches, WALK_ROWS):
            _, x = _integers(b, settings)
            label, _, _ = nearest(x, centroids)
            n += np.bincount(label, minlength=k)
            for c in np.unique(label):
                total[c] += x[label == c].sum(axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(n[used], pa.int64()), pa.array(list(total[used]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    sums = [F.sum(F.col("total")[d]).alias(f"s{d}") for d in range(settings.dims)]
    out = centroids.copy()
    # One row per task and centroid goes to the aggregate, one per centroid to the driver.
    for r in vectors.mapInArrow(run, "cluster int, n long, total array<long>").groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        out[r["cluster"]] = [r[f"s{d}"] // r["n"] for d in range(settings.dims)]
    return out


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """Cluster of every vector after ``rounds`` rounds, with its squared distance, the sums of distances and the centroid's hash.

    Takes part: every row whose vector has exactly ``dims`` components, none null
    or non-finite (or so large that a distance would not fit a long).  Repeated
    rows count as often as they stand there and give a row each; rows without an
    id are clustered too, but none of them starts a centroid.  Rows of equal ids
    start in order of their components.  With fewer vectors than ``clusters``
    each one starts a centroid; an empty table gives no rows.  Other columns,
    whatever their names, are ignored.
    """
    vectors = _vectors(df, id_col, vec_col)
    centroids = start(vectors, settings)
    if not len(centroids):
        return vectors.limit(0).selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(settings.rounds):
        centroids = moved(vectors, centroids, settings)
    # Written once: the sums and the rows both read it, at three numbers a vector.
    found = keep(assign(vectors, centroids, settings))
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    pick = lambda values: F.array(*[F.lit(v) for v in values])[F.col("cluster")]
    return found.select(
        "vec_id", "cluster", "distance", pick([sums.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), pick(hashes).alias("centroid_sha256"))


def op13_centroid_clustering(spark, sf_dir) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))
