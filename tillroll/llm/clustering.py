"""Exact k-means on integer vectors with bounds on the two nearest centroids.

Every vector remembers its nearest and second-nearest centroid and bounds on its distance to the
nearest one (from above) and to all others (from below). A round moves the bounds by what the
centroids moved; only vectors whose bounds still leave room are looked at. These measure the two
remembered centroids, start from the closer one and walk its neighbours in order of distance, as far
as a ball that holds every centroid that could still be among the two nearest; the ball shrinks
with every better second one. Measured distances are compared as integers, so ties go to the
smaller number and the result is that of comparing every vector with every centroid.

Vectors and their state are rows of a table that every round writes to the shared folder; the
driver holds the centroids alone (k vectors).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written

#: Integers stay within this, so that a squared distance of 128 of them fits 64 bits.
LIMIT = 1 << 27
#: Room for rounding where an integer's root becomes a bound.
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12


@dataclass(frozen=True)
class ClusterParams:
    """``k`` centroids, ``rounds`` of assignment and update (then one more assignment); vectors have
    ``width`` components, which count ``scale`` times, rounded down; ``seed`` goes into the hash
    that picks the first centroids."""

    k: int = 40
    rounds: int = 5
    width: int = 64
    scale: int = 256
    seed: str = "2:"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, params: ClusterParams) -> DataFrame:
    """(vec_id, vector array<int>): rows whose vector has the right width, no null and no infinite
    component; floor(scale * component), at most ``LIMIT`` either way (beyond, distances would
    not fit 64 bits)."""
    usable = ((F.size(vector_col) == params.width)
              & F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    whole = F.transform(vector_col, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(
        F.lit(float(LIMIT)), x.cast("double") * F.lit(float(params.scale))))).cast("int"))
    return vectors.filter(F.coalesce(usable, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vector"))


def first_centroids(rows: DataFrame, params: ClusterParams) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids, in that order (repeated ids: by vector;
    a null id counts as empty text)."""
    rank = F.sha2(F.concat(F.lit(params.seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = rows.select(rank.alias("rank"), "vector").orderBy("rank", "vector").limit(params.k).collect()
    return np.array([r["vector"] for r in chosen], np.int64).reshape(len(chosen), params.width)


def _squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    difference = vectors - centroids
    return np.einsum("ij,ij->i", difference, difference)


class Neighbours:
    """Distances between centroids: bounds from below, and each one's others in ascending order."""

    def __init__(self, centroids: np.ndarray):
        k = len(centroids)
        self.centroids = centroids
        difference = centroids[:, None, :] - centroids[None, :, :]
        between = np.sqrt(np.einsum("ijk,ijk->ij", difference, difference).astype(np.float64)) * _DOWN
        np.fill_diagonal(between, -1)  # itself comes first
        self.order = np.argsort(between, axis=1, kind="stable")
        self.distance = np.take_along_axis(between, self.order, axis=1)
        self.half_gap = self.distance[:, 1] / 2 if k > 1 else np.full(k, np.inf)

    def search(self, vectors: np.ndarray, first: np.ndarray, second: np.ndarray):
        """(nearest, second nearest, squared distance to each) of vectors that remember two
        different centroids; among equal distances the smaller number is nearer."""
        n, c = len(vectors), self.centroids
        if len(c) == 1:
            return np.zeros(n, np.int64), np.zeros(n, np.int64), _squares(vectors, c[0]), np.full(n, np.iinfo(np.int64).max)
        d1, d2 = _squares(vectors, c[first]), _squares(vectors, c[second])
        swap = (d2 < d1) | ((d2 == d1) & (second < first))
        near, next_ = np.where(swap, second, first), np.where(swap, first, second)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        start, skip = near.copy(), next_.copy()
        out = np.sqrt(d1.astype(np.float64)) * _UP
        ball = out + np.sqrt(d2.astype(np.float64)) * _UP  # a nearer one can't lie further from the start
        active = np.arange(n)
        for rank in range(1, len(c)):
            active = active[self.distance[start[active], rank] <= ball[active]]
            if not len(active):
                break
            other = self.order[start[active], rank]
            fresh = other != skip[active]
            rows, other = active[fresh], other[fresh]
            d = _squares(vectors[rows], c[other])
            first_now = (d < d1[rows]) | ((d == d1[rows]) & (other < near[rows]))
            second_now = ~first_now & ((d < d2[rows]) | ((d == d2[rows]) & (other < next_[rows])))
            a, b = rows[first_now], rows[second_now]
            next_[a], d2[a] = near[a], d1[a]
            near[a], d1[a] = other[first_now], d[first_now]
            next_[b], d2[b] = other[second_now], d[second_now]
            changed = rows[first_now | second_now]
            ball[changed] = out[changed] + np.sqrt(d2[changed].astype(np.float64)) * _UP
        return near, next_, d1, d2


def _drifts(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each centroid moved, and how far any other one did (bounds from above)."""
    difference = new - old
    moved = np.sqrt(np.einsum("ij,ij->i", difference, difference).astype(np.float64)) * _UP
    others = np.array([np.max(np.delete(moved, c), initial=0) for c in range(len(moved))])
    return moved, others


STATE = "vec_id long, vector array<int>, cluster int, second int, upper double, lower double"


def _assigned(rows: DataFrame, centroids: np.ndarray, moved: tuple[np.ndarray, np.ndarray] | None, width: int,
              final: bool) -> DataFrame:
    """The next state of every row (``STATE``); ``final`` measures every distance and gives it as
    ``distance`` instead of the bounds. Without ``moved`` the rows have no state yet."""
    def run(batches):
        near = Neighbours(centroids)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(n, width)
            if moved is None:
                cluster, second = np.zeros(n, np.int64), np.full(n, min(1, len(centroids) - 1), np.int64)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                cluster, second = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
                upper = (batch.column(4).to_numpy() + moved[0][cluster]) * _UP
                lower = (batch.column(5).to_numpy() - moved[1][cluster]) * _DOWN
                lower[lower < 0] = 0
            room = np.flatnonzero(upper >= np.maximum(lower, near.half_gap[cluster]))
            if moved is not None and len(room):  # a measured distance may settle it
                d = np.sqrt(_squares(vectors[room], centroids[cluster[room]]).astype(np.float64)) * _UP
                upper[room] = d
                room = room[d >= np.maximum(lower[room], near.half_gap[cluster[room]])]
            if len(room):
                a, b, d1, d2 = near.search(vectors[room], cluster[room], second[room])
                cluster[room], second[room] = a, b
                upper[room], lower[room] = np.sqrt(d1.astype(np.float64)) * _UP, np.sqrt(d2.astype(np.float64)) * _DOWN
            if final:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(_squares(vectors, centroids[cluster]))],
                                                 names=["vec_id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), pa.array(second.astype(np.int32)),
                                                  pa.array(upper), pa.array(lower)], names=["vec_id", "vector", "cluster", "second", "upper", "lower"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long" if final else STATE)


def _means(state: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Each centroid's new place: the exact floor of its vectors' mean; empty ones stay."""
    sums = [F.sum(F.get("vector", F.lit(k))).alias(f"s{k}") for k in range(width)]
    out = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # k rows at most
        out[row["cluster"]] = [row[f"s{k}"] // row["n"] for k in range(width)]
    return out


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    params: ClusterParams = ClusterParams()) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every usable row, the centroids that it was assigned to).

    Rows whose vector is null, has another width or a component that is null or not finite are left
    out. Rows that repeat an id are vectors of their own. With fewer than k usable rows there are
    as many centroids as rows; with none the result is empty. Only the two named columns are read.
    """
    rows = integer_vectors(vectors, id_col, vector_col, params)
    centroids = first_centroids(rows, params)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    state, moved = rows, None
    for k in range(params.rounds):
        state = written(_assigned(state, centroids, moved, params.width, final=False), f"vectors{k}")
        fresh = _means(state, centroids, params.width)
        centroids, moved = fresh, _drifts(centroids, fresh)
    return written(_assigned(state, centroids, moved, params.width, final=True), "clusters"), centroids


def describe_clusters(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every row with its cluster's and the whole inertia (exact sums of squared distances) and the
    digest of its centroid. The joined side has one row per centroid."""
    sums = {r["cluster"]: int(r["part"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("part")).collect()}
    fits = lambda x: min(x, 2 ** 63 - 1)
    each = [(k, fits(sums.get(k, 0)), fits(sum(sums.values())), centroid_digest(c)) for k, c in enumerate(centroids)]
    table = assigned.sparkSession.createDataFrame(each, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), assigned["cluster"] == table["c"]).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
