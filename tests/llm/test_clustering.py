"""Clustering against comparing every vector with every centroid in plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tillroll.llm import clustering
from tillroll.llm.clustering import ClusterParams, Neighbours


def brute(rows, params):
    """[(vec_id, cluster, distance)] and the last centroids."""
    kept = [(i, [max(-clustering.LIMIT, min(clustering.LIMIT, math.floor(params.scale * float(np.float32(x))))) for x in v]) for i, v in rows
            if v is not None and len(v) == params.width and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{params.seed}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:params.k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]
    for _ in range(params.rounds):
        groups = {}
        for (_, v), (_, k) in zip(kept, assign()):
            groups.setdefault(k, []).append(v)
        for k, own in groups.items():
            centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, k, d) for (i, _), (d, k) in zip(kept, assign())], centroids


def frame(spark, rows, extra=()):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
                          + [T.StructField(c, T.StringType()) for c in extra])
    return spark.createDataFrame([(i, v) + ("x",) * len(extra) for i, v in rows], schema).repartition(3)


def check(spark, rows, params, extra=()):
    assigned, centroids = clustering.cluster_vectors(frame(spark, rows, extra), params=params)
    expected, places = brute(rows, params)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, assigned.collect()), key=key) == sorted(expected, key=key)
    assert centroids.tolist() == places
    out = clustering.describe_clusters(assigned, centroids).collect()
    sums = {}
    for _, k, d in expected:
        sums[k] = sums.get(k, 0) + d
    assert sorted((r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"]) for r in out) == sorted(
        (k, d, sums[k], sum(sums.values())) for _, k, d in expected)
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, places[r["cluster"]])).encode()).hexdigest() for r in out)


def blobs(n, width, seed, spread=0.1):
    rng = random.Random(seed)
    hubs = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    return [(k, [x + rng.gauss(0, spread) for x in rng.choice(hubs)]) for k in range(n)]


@pytest.mark.parametrize("k,rounds", [(1, 2), (2, 3), (12, 5), (40, 1)])
def test_equals_brute_force(spark, k, rounds):
    check(spark, blobs(150, 5, k), ClusterParams(k=k, rounds=rounds, width=5))


def test_ties_repeats_and_unusable_rows(spark, clashes):
    rng = random.Random(5)
    grid = [(k, [float(rng.randint(0, 1)) / 256 for _ in range(3)]) for k in range(60)]  # many equal vectors and ties
    rows = grid + grid[:20] + [(None, [0.0, 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (70, None), (71, [1.0]), (72, [None, 0.0, 0.0]),
                               (73, [float("nan"), 0.0, 0.0]), (74, [float("inf"), 0.0, 0.0]), (75, []), (76, [3e38, -3e38, 0.0])]
    check(spark, rows, ClusterParams(k=9, rounds=4, width=3), clashes + ["cluster", "second", "c", "rank"])


def test_one_vector_holds_most_rows(spark):
    rows = blobs(60, 4, 3) + [(1000 + k, [0.5, 0.5, 0.25, 0.125]) for k in range(200)]
    check(spark, rows, ClusterParams(k=10, rounds=5, width=4))


def test_few_and_no_rows(spark):
    check(spark, blobs(3, 4, 1), ClusterParams(k=10, rounds=2, width=4))
    assigned, centroids = clustering.cluster_vectors(frame(spark, []))
    assert not len(centroids) and clustering.describe_clusters(assigned, centroids).collect() == []


@settings(max_examples=120, deadline=None)
@given(st.integers(2, 9), st.integers(1, 3), st.integers(0, 10 ** 6), st.sampled_from([2, 50, 1 << 27]))
def test_search_finds_the_two_nearest(k, width, seed, top):
    rng = np.random.default_rng(seed)
    centroids, vectors = rng.integers(-top, top + 1, (k, width)), rng.integers(-top, top + 1, (60, width))
    first = rng.integers(0, k, 60)
    second = (first + rng.integers(1, k, 60)) % k
    near, next_, d1, d2 = Neighbours(centroids).search(vectors, first, second)
    for row in range(60):
        ranked = sorted((int(((vectors[row] - c) ** 2).sum()), j) for j, c in enumerate(centroids))
        assert [(d1[row], near[row]), (d2[row], next_[row])] == ranked[:2]


def test_few_distances_are_measured(monkeypatch):
    """The ball leaves out most centroids on well-parted data."""
    rng = np.random.default_rng(2)
    hubs = rng.integers(-10_000, 10_000, (40, 8))
    vectors = hubs[rng.integers(0, 40, 2000)] + rng.integers(-50, 50, (2000, 8))
    near = Neighbours(hubs)
    first, second, *_ = near.search(vectors, np.zeros(2000, np.int64), np.ones(2000, np.int64))
    measured = []
    plain = clustering._squares
    monkeypatch.setattr(clustering, "_squares", lambda v, c: measured.append(len(v)) or plain(v, c))
    again = near.search(vectors, first, second)
    assert (again[0] == first).all() and sum(measured) < 2000 * 10
