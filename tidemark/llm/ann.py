"""Approximate nearest neighbours by a forest of random-projection trees.

*Forest.*  Trees are grown on a bounded sample (``sample_rows`` rows, by the
hash of their ids): a node's hyperplane is the difference of two random rows,
cut at the median, so leaves hold equal shares even of a dense cluster.  Every
row of the table is put into a leaf of every tree.

*Search.*  All trees share one priority queue: a node's priority is the least
margin by which the query lies on its side of the hyperplanes above.  The best
node is taken first, whichever tree it is in, until ``leaves`` leaves are open;
how many it takes for the wanted recall is measured on the sample, where
neighbours are farther apart, hence harder to find, than in the whole table.

*Rerank.*  A row's vector is sent with its leaf numbers, a query's with a bit for
every leaf it opened, and not once a leaf: blocks of rows meet chunks of queries, both
of bounded size.  Rows of leaves that a query opened are scored exactly, and its best of
the block go on to be merged by query.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.common import Scratch, slices, small_batches, table
from tidemark.llm.shingles import mix


@dataclass(frozen=True)
class Settings:
    nearest: int = 20
    trees: int = 8
    #: Rows of a leaf that the number of leaves aims at, rows of the sample (at least ``least`` a leaf).
    leaf: int = 256
    sample_rows: int = 16_384
    least: int = 16
    #: Bytes of a block of rows and of a chunk of queries that meet; those of tables that need few are smaller, in numbers up to these.
    held: int = 32 << 20
    blocks: int = 8
    chunks: int = 2
    #: Queries and rows whose scores are held at once.
    asked: int = 128
    scored: int = 16_384
    #: Recall on the sample's own queries that sets how many leaves are opened.
    recall: float = 0.95
    sample_queries: int = 256
    seed: int = 17


class Forest:
    """Hyperplanes of complete binary trees, node k's children being 2 k and 2 k + 1."""

    def __init__(self, sample: np.ndarray, depth: int, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.depth, self.leaves = depth, 1 << depth
        self.normals = np.zeros((settings.trees, self.leaves, sample.shape[1]))
        self.cuts = np.zeros((settings.trees, self.leaves))
        for t in range(settings.trees):
            members = {1: np.arange(len(sample))}
            for k in range(1, self.leaves):
                m = members.pop(k)
                x = rng.normal(size=sample.shape[1])
                if len(m) > 1:
                    a, b = rng.choice(m, 2, replace=False)
                    if (sample[a] != sample[b]).any():
                        x = sample[a] - sample[b]
                x = x / np.linalg.norm(x)
                side = sample[m] @ x
                cut = float(np.median(side)) if len(m) else 0.0
                self.normals[t, k], self.cuts[t, k] = x, cut
                members[2 * k], members[2 * k + 1] = m[side <= cut], m[side > cut]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """[row, tree, node]: how far to the second child's side."""
        trees, leaves, dim = self.normals.shape
        return (x @ self.normals.reshape(-1, dim).T).reshape(len(x), trees, leaves) - self.cuts

    def leaf_of(self, x: np.ndarray, at_once: int = 512) -> np.ndarray:
        """[row, tree] leaf numbers; margins of ``at_once`` rows are held at a time."""
        out = np.ones((len(x), len(self.cuts)), np.int64)
        trees = np.arange(len(self.cuts))[None, :]
        for i in range(0, len(x), at_once):
            node, m = out[i : i + at_once], self.margins(x[i : i + at_once])
            rows = np.arange(len(node))[:, None]
            for _ in range(self.depth):
                node[:] = 2 * node + (m[rows, trees, node] > 0)
        return out - self.leaves

    def search(self, margins: np.ndarray, most: int) -> list[tuple[int, int]]:
        """The ``most`` leaves (tree, leaf) to open for one query, best first."""
        queue = [(-np.inf, t, 1) for t in range(margins.shape[0])]
        heapq.heapify(queue)
        found = []
        rows = margins.tolist()
        while queue and len(found) < most:
            priority, t, k = heapq.heappop(queue)
            if k >= self.leaves:
                found.append((t, k - self.leaves))
                continue
            m = rows[t][k]
            # The heap takes the smallest first: priorities are negated least margins.
            heapq.heappush(queue, (max(priority, m), t, 2 * k))
            heapq.heappush(queue, (max(priority, -m), t, 2 * k + 1))
        return found


def leaves_for(forest: Forest, sample: np.ndarray, settings: Settings) -> int:
    """Leaves to open so that the sample's queries find the wanted share of their nearest rows in it."""
    queries = np.arange(0, len(sample), max(1, len(sample) // settings.sample_queries))[: settings.sample_queries]
    near = min(settings.nearest, len(sample) - 1)
    every = settings.trees * forest.leaves
    if near < 1:
        return every
    home = forest.leaf_of(sample)
    score = sample[queries] @ sample.T
    score[np.arange(len(queries)), queries] = -np.inf
    found = np.zeros(every + 1)
    for i, q in enumerate(queries):
        rank = np.full((settings.trees, forest.leaves), every)
        for n, (t, leaf) in enumerate(forest.search(forest.margins(sample[q : q + 1])[0], every)):
            rank[t, leaf] = n
        best = np.argpartition(-score[i], near - 1)[:near]
        opened = rank[np.arange(settings.trees), home[best]].min(axis=1)
        found += np.searchsorted(np.sort(opened), np.arange(every + 1), side="left")
    return int(np.searchsorted(found, settings.recall * near * len(queries)))


def usable(vector: Column) -> Column:
    """Neither null nor zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _packs(places: np.ndarray, what: str, **columns: np.ndarray) -> pa.RecordBatch:
    """One row per place with all that goes there; ``what`` names the place."""
    order = np.argsort(places, kind="stable")
    found, first = np.unique(places[order], return_index=True)
    parts = [order[i:j] for i, j in zip(first, [*first[1:], len(order)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *[pa.array([c[p].tobytes() for p in parts], pa.binary()) for c in columns.values()]], [what, *columns])


def _dealt(ids: np.ndarray, n: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int32)


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Indices of each query's ``n`` best rows, each row once, ties to the smaller id; in order."""
    order = np.lexsort((vec, -score, query))
    query, vec = query[order], vec[order]
    new = np.ones(len(order), bool)
    new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    order, query = order[new], query[new]
    first = np.r_[0, np.flatnonzero(np.diff(query)) + 1]
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    return order[rank < n]


def _scored(qid: np.ndarray, q: np.ndarray, opened: np.ndarray, vid: np.ndarray, v: np.ndarray, home: np.ndarray, near: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """The best of rows ``near`` for each query, of those in a leaf it opened ([query, tree, leaf]): query ids, row ids and scores."""
    query, vec, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.full(len(qid), -np.inf)
    # By tree and leaf a bit for each query, so that a row's trees are put together for eight queries at once.
    bits = np.ascontiguousarray(np.packbits(opened, axis=0).transpose(1, 2, 0))
    for at in range(0, len(near), settings.scored):
        rows = near[at : at + settings.scored]
        x = v[rows].astype(np.float64)
        s = x @ q.T
        met = bits[0][home[rows, 0]]
        for t in range(1, len(bits)):
            met |= bits[t][home[rows, t]]
        met = np.unpackbits(met, axis=1, count=len(qid)).view(bool)
        n = min(settings.nearest, len(rows))
        if not at:  # the first rows set the mark, what they brought is the mark for later ones
            least = np.partition(np.where(met & (qid[None, :] != vid[rows][:, None]), s, -np.inf), len(rows) - n, axis=0)[len(rows) - n]
        b, a = np.nonzero((s >= least - 1e-9 * np.abs(least)) & met)
        others = qid[a] != vid[rows][b]
        a, b = a[others], b[others]
        exact = np.einsum("kd,kd->k", q[a], x[b])  # the same sum for a pair, whatever block it stands in
        query, vec, score = np.r_[query, a], np.r_[vec, vid[rows][b]], np.r_[score, exact]
        got = _best(query, vec, score, settings.nearest)
        query, vec, score = query[got], vec[got], score[got]
        full = np.bincount(query, minlength=len(qid)) == settings.nearest
        lowest = np.full(len(qid), np.inf)
        np.minimum.at(lowest, query, score)
        least = np.where(full, lowest, -np.inf)
    return qid[query], vec, score


MERGED = "query_id long, rank int, vec_id long, score double"


def search(vectors: DataFrame, queries: Column, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every query row's nearest other rows by inner product: ``query_id, rank, vec_id, score``.

    ``queries`` tells query rows by columns of the table.  Rows whose id or
    vector is null, whose vector is zero or has null or non-finite components,
    or another length than the table's most frequent one, take no part; of rows
    that share an id the one with the smallest vector counts.  Of equal vectors
    only the smallest ids can be among a query's nearest, so no more than those
    are indexed.  With fewer rows than asked for all are returned, an empty table
    gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    # Vectors go over the network and to disk as they are given.
    kind, exact = ("float", np.float32) if isinstance(vectors.schema[vector_col].dataType.elementType, FloatType) else ("double", np.float64)
    rows = small_batches(vectors).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).select("id", F.col("v").cast(f"array<{kind}>").alias("v"), "asks")
    whole, kept = Scratch(spark), Scratch(spark)
    rows = whole.written(rows.groupBy("id").agg(F.min(F.struct("v", "asks")).alias("m")).select("id", "m.v", "m.asks"))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], MERGED)
    dim = lengths[0]["d"]
    rows = rows.filter(F.size("v") == dim)
    same = Window.partitionBy("v").orderBy("id")
    base = rows.select("id", "v", F.row_number().over(same).alias("turn")).filter(F.col("turn") <= settings.nearest + 1).select("id", "v")
    base, asking = kept.written(base), kept.written(rows.filter("asks").select("id", "v"))
    whole.drop()
    total, asks = base.count(), asking.count()
    sample = base.orderBy(F.xxhash64("id"), "id").limit(settings.sample_rows).toArrow()
    points = _matrix(sample["v"], dim)
    depth = max(0, min(int(np.ceil(np.log2(max(1, total / settings.leaf)))), int(np.log2(max(1, len(points) / settings.least)))))
    forest = Forest(points, depth, settings)
    most = leaves_for(forest, points, settings)
    number = np.min_scalar_type(forest.leaves)
    size = np.dtype(exact).itemsize * dim
    blocks = max(-(-total * size // settings.held), min(-(-total // 4096), settings.blocks), 1)
    chunks = max(-(-asks * (size + settings.trees * forest.leaves // 8) // settings.held), min(-(-asks // 512), settings.chunks), 1)
    sent = spark.sparkContext.broadcast(forest)  # trees x leaves hyperplanes: bounded by the sample

    def place(batches):
        for b in slices(batches):
            if b.num_rows:
                ids, x = b["id"].to_numpy(), _matrix(b["v"], dim)
                yield _packs(_dealt(ids, blocks), "block", ids=ids, vectors=x.astype(exact), leaves=sent.value.leaf_of(x).astype(number))

    def route(batches):
        for b in slices(batches):
            if b.num_rows:
                ids, x = b["id"].to_numpy(), _matrix(b["v"], dim)
                forest = sent.value
                opened = np.zeros((len(ids), len(forest.cuts), forest.leaves), bool)
                for i in range(len(ids)):
                    for t, leaf in forest.search(forest.margins(x[i : i + 1])[0], most):
                        opened[i, t, leaf] = True
                yield _packs(_dealt(ids, chunks), "chunk", ids=ids, vectors=x.astype(exact), opened=np.packbits(opened.reshape(len(ids), -1), axis=1))

    buckets = max(16, total // 20_000)

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        read = lambda t, c, k: np.frombuffer(b"".join(t[c].to_pylist()), k)
        out = []
        if left.num_rows and right.num_rows:
            forest = sent.value
            trees, leaves = len(forest.cuts), forest.leaves
            vid, v, home = read(left, "ids", np.int64), read(left, "vectors", exact).reshape(-1, dim), read(left, "leaves", number).reshape(-1, trees)
            qid, q = read(right, "ids", np.int64), read(right, "vectors", exact).reshape(-1, dim)
            bits = read(right, "opened", np.uint8).reshape(len(qid), -1)
            # Queries that lie together open the same leaves: rows of no opened leaf are not scored.
            order = np.argsort(forest.leaf_of(q.astype(np.float64))[:, 0], kind="stable")
            for at in range(0, len(order), settings.asked):
                part = order[at : at + settings.asked]
                opened = np.unpackbits(bits[part], axis=1, count=trees * leaves).reshape(-1, trees, leaves).view(bool)
                near = np.flatnonzero(np.any([opened[:, t].any(axis=0)[home[:, t]] for t in range(trees)], axis=0))
                out.append(_scored(qid[part], q[part].astype(np.float64), opened, vid, v, home, near, settings))
        query, vec, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        bucket = (query // 20) % buckets
        rows = [(int(k), *(c[bucket == k].tobytes() for c in (query, vec, score))) for k in np.unique(bucket)]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({f: pa.array([r[j] for r in rows], k) for j, (f, k) in enumerate(zip(("bucket", "query", "vec", "score"), kinds, strict=True))})

    def merge(t: pa.Table) -> pa.Table:
        query, vec, score = (np.frombuffer(b"".join(t[c].to_pylist()), k) for c, k in (("query", np.int64), ("vec", np.int64), ("score", np.float64)))
        got = _best(query, vec, score, settings.nearest)
        query, vec, score = query[got], vec[got], score[got]
        first = np.r_[0, np.flatnonzero(np.diff(query)) + 1] if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)])) + 1
        return pa.table({"query_id": query, "rank": rank.astype(np.int32), "vec_id": vec, "score": score})

    pair = ("block", "chunk")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = base.mapInArrow(place, "block int, ids binary, vectors binary, leaves binary").withColumn("chunk", every(chunks)).groupBy(*pair)
    routed = asking.mapInArrow(route, "chunk int, ids binary, vectors binary, opened binary").withColumn("block", every(blocks)).groupBy(*pair)
    found = placed.cogroup(routed).applyInArrow(rerank, "bucket long, query binary, vec binary, score binary")
    return found.groupBy("bucket").applyInArrow(merge, MERGED)


def op2_nearest_neighbours(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
