"""Centroid clustering against a plain version that compares every vector with every centroid."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings as hyp
from hypothesis import strategies as st

from tidemark.llm import centroids
from tidemark.llm.queries import QUERIES


def plain(rows, clusters=16, rounds=3, dims=64):
    """Rows of (vec_id, cluster, distance, cluster_inertia, inertia, hash), with Python's integers."""
    kept = [(i, [math.floor(64 * float(v)) for v in x]) for i, x in rows
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    cents = [x for _, x in sorted(((digest(i), x) for i, x in kept if i is not None))[:clusters]]

    def put():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = put()
        for c in range(len(cents)):
            mine = [x for (_, x), (label, _) in zip(kept, at) if label == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    at = put()
    per = [sum(d for label, d in at if label == c) for c in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, per[c], sum(per), sha[c]) for (i, _), (c, d) in zip(kept, at)), key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in df.collect()), key=str)


def test_query_equals_the_plain_version(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    df = QUERIES["op13_centroid_clustering"](spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    assert got(df) == plain(rows)


@hyp(max_examples=60, deadline=None)
@given(st.data())
def test_walk_finds_the_nearest_and_the_smaller_of_ties(data):
    dims, k = data.draw(st.integers(1, 5)), data.draw(st.integers(1, 6))
    reach = data.draw(st.sampled_from([2, 9, 1 << 27]))
    vec = st.lists(st.integers(-reach, reach), min_size=dims, max_size=dims)
    x = np.array(data.draw(st.lists(vec, min_size=1, max_size=8)), np.int64)
    c = np.array(data.draw(st.lists(vec, min_size=k, max_size=k)), np.int64)
    label, distance, _ = centroids.nearest(x, c)
    for row, at, d in zip(x.tolist(), label, distance):
        want = [sum((a - b) ** 2 for a, b in zip(row, y)) for y in c.tolist()]
        assert (at, d) == (want.index(min(want)), min(want))


def test_walk_stops_before_it_met_every_centroid():
    rng = np.random.default_rng(1)
    c = rng.integers(-1000, 1000, (16, 4))
    x = np.repeat(c, 20, axis=0) + rng.integers(-3, 4, (320, 4))
    _, _, scored = centroids.nearest(x, c)
    assert scored < 320 * 16 * 0.7


SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, vec string, n int, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "d", "v", 1, "x") for i, v in rows], SCHEMA)


EDGES = [
    (1, [0.5, -0.25]), (1, [0.5, -0.25]), (1, [0.25, 0.75]), (2, [1.0, 1.0]), (3, None), (4, [1.0]), (5, [1.0, None]), (6, [float("nan"), 0.0]),
    (7, [float("inf"), 0.0]), (None, [0.1, 0.2]), (8, [0.0, 0.0]), (9, []), (10, [-0.001, 2.0]), (11, [1000.0, -1000.0]),
]


@pytest.mark.parametrize("clusters", [2, 4, 16])
def test_edges(spark, clusters):
    s = centroids.Settings(clusters=clusters, dims=2)
    assert got(centroids.cluster_vectors(frame(spark, EDGES), settings=s)) == plain(EDGES, clusters, 3, 2)


def test_values_too_large_for_a_long_take_no_part(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.5, 0.5]), (3, [0.25, 0.5])]
    assert got(centroids.cluster_vectors(frame(spark, rows), settings=centroids.Settings(dims=2))) == plain(rows[1:], 16, 3, 2)


def test_empty_table(spark):
    df = centroids.cluster_vectors(frame(spark, []), settings=centroids.Settings(dims=2))
    assert df.count() == 0 and [f.dataType.simpleString() for f in df.schema] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_one_vector_a_thousand_times(spark):
    rows = [(i, [0.5, 0.5]) for i in range(1000)] + [(5000, [0.25, 0.5])]
    assert got(centroids.cluster_vectors(frame(spark, rows).repartition(7), settings=centroids.Settings(dims=2))) == plain(rows, 16, 3, 2)
