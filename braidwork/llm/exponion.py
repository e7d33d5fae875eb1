"""Clustering around centroids over whole numbers, with Exponion's bounds.

Vectors are scaled to whole numbers, so all distances, sums and ties are exact and every rerun gives the same clusters.
Each row carries its cluster, an upper bound of the distance to its centroid and a lower bound of the distance to any
other. Centroids move, the bounds widen by how far; a row whose upper bound stays below the lower one, or below half
the way from its centroid to the next, keeps its cluster unread. For the rest only the centroids in a ball around
their current one are scanned: with u the exact distance to it and s the way to its nearest neighbour, the nearest
two centroids lie within 2u + s of it, so a prefix of that centroid's neighbours, sorted by distance, will do. The
radius is inclusive and the bounds have a margin above their rounding error, so ties go to the smaller number.

Rows never move: a round reads the stored state of the one before, writes its own, and sums its clusters in each task
before the shuffle, so a cluster with most of the rows costs no more than others. What reaches the driver and is
shipped with the tasks is the centroids alone, ``k`` x ``dim`` numbers, at every size.

Defined cases: a null vector, one with another number of components, or with a null, NaN or infinite one is left out;
a component beyond ``LARGEST`` after scaling counts as ``LARGEST``, so that a squared distance fits a long; fewer kept
vectors than ``k``: so many centroids; equal centroids: the smaller number takes the rows; a cluster without rows keeps
its centroid; repeated rows count each; a null id is hashed as an empty string; equal hashes stand by id, then vector;
empty table: empty result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stored

#: Scaled components are held to this, so that the squared distance of ``dim`` <= 128 of them fits a long.
LARGEST = 1 << 27
#: More than the rounding error of a bound, whose size is below 2^32.
MARGIN = 1e-5
STATE = "vec_id long, vector array<int>, cluster int, upper double, lower double"
#: Rows that one vectorised step looks at.
STEP = 4096


def _whole(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are kept, and their vectors as whole numbers."""
    lists = column.cast(pa.large_list(pa.float64()))
    rows = np.flatnonzero(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dim)
    values = lists.take(pa.array(rows)).flatten()
    x = values.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dim)
    fine = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        return rows[fine], np.clip(np.floor(x[fine] * scale), -LARGEST, LARGEST).astype(np.int32)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel().astype(np.int32)))


def whole_vectors(embeddings: DataFrame, dim: int = 64, scale: float = 64.0) -> DataFrame:
    """embeddings(vec_id, embedding) -> the state before the first round: no bounds yet."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _whole(batch.column(1), dim, scale)
            n = len(rows)
            start = [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, np.inf)), pa.array(np.zeros(n))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), _lists(x), *start], ["vec_id", "vector", "cluster", "upper", "lower"])

    own = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return own.mapInArrow(prepare, STATE)


@dataclass
class Centroids:
    """Centroids and what the search knows of them; ``moved``: how far each went since the bounds were set."""

    at: np.ndarray
    moved: np.ndarray

    def __post_init__(self) -> None:
        steps = self.at[:, None, :] - self.at[None, :, :]
        between = np.sqrt((steps * steps).sum(axis=2).astype(np.float64))
        self.order = np.argsort(between, axis=1, kind="stable")
        self.sorted = np.take_along_axis(between, self.order, axis=1)
        k = len(self.at)
        np.fill_diagonal(between, np.inf)
        self.near = between.min(axis=1)
        most = np.argsort(-self.moved)
        self.others_moved = np.where(np.arange(k) == most[0], self.moved[most[1]] if k > 1 else 0.0, self.moved[most[0]])


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", d, d)


def assign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, known: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroids and new bounds, and how many distances that took."""
    cluster, upper, lower = cluster.copy(), upper + known.moved[cluster], lower - known.others_moved[cluster]
    enough = np.maximum(lower, known.near[cluster] / 2)
    rest = np.flatnonzero(~(upper + MARGIN < enough))
    work = len(rest)
    own = squares(x[rest], known.at[cluster[rest]])
    upper[rest] = np.sqrt(own.astype(np.float64))
    still = ~(upper[rest] + MARGIN < enough[rest])
    rest, own = rest[still], own[still]
    from_ = cluster[rest]
    for a in np.unique(from_):
        mine = np.flatnonzero(from_ == a)
        rows = rest[mine]
        reach = np.searchsorted(known.sorted[a], 2 * upper[rows] + (known.near[a] if len(known.at) > 1 else 0.0) + MARGIN, "right")
        best, which = own[mine], np.full(len(rows), a, np.int64)
        second = np.full(len(rows), np.iinfo(np.int64).max)
        for place in range(reach.max()):
            j = known.order[a, place]
            if j == a:
                continue
            inside = np.flatnonzero(reach > place)
            d = squares(x[rows[inside]], known.at[j])
            work += len(inside)
            ahead = (d < best[inside]) | ((d == best[inside]) & (j < which[inside]))
            second[inside] = np.where(ahead, best[inside], np.minimum(second[inside], d))
            best[inside], which[inside] = np.where(ahead, d, best[inside]), np.where(ahead, j, which[inside])
        cluster[rows], upper[rows] = which, np.sqrt(best.astype(np.float64))
        lower[rows] = np.where(second == np.iinfo(np.int64).max, np.inf, np.sqrt(second.astype(np.float64)))
    return cluster, upper, lower, work


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def assigned(state: DataFrame, known: Centroids) -> DataFrame:
    """The state with every row at its nearest centroid."""
    dim = known.at.shape[1]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1), dim)
            before = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4)]
            parts = [assign(x[i : i + STEP], *(b[i : i + STEP] for b in before), known)[:3] for i in range(0, len(x), STEP)]
            after = [np.concatenate(p) for p in zip(*parts, strict=True)] if parts else before
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(after[0].astype(np.int32)), pa.array(after[1]), pa.array(after[2])], ["vec_id", "vector", "cluster", "upper", "lower"]
            )

    return state.mapInArrow(step, STATE)


def moved_centroids(state: DataFrame, known: Centroids) -> Centroids:
    """Centroids at the floor of their rows' mean; each task sends one row of sums a cluster."""
    k, dim = known.at.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            x, cluster = _vectors(batch.column(0), dim), batch.column(1).to_numpy(zero_copy_only=False)
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += x[cluster == c].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(n)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dim), pa.array(total[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), rows], ["cluster", "n", "sums"])

    each = state.select("vector", "cluster").mapInArrow(sums, "cluster int, n long, sums array<long>")
    each = each.select("cluster", "n", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    at = known.at.copy()
    for r in each.collect():  # at most k x dim rows
        at[r["cluster"], r["place"]] = int(r["x"]) // r["n"]
    return Centroids(at, np.sqrt(((at - known.at) ** 2).sum(axis=1).astype(np.float64)))


def cluster_vectors(embeddings: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every kept row of ``embeddings``."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    state = stored(whole_vectors(embeddings, dim, scale), "vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.orderBy(name, F.col("vec_id").asc_nulls_last(), "vector").limit(k).select("vector").collect()
    if not first:
        return state.select("vec_id", "cluster", F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    known = Centroids(np.array([r["vector"] for r in first], np.int64), np.zeros(len(first)))
    for n in range(rounds):
        state = stored(assigned(state, known), f"vectors-{n}")
        known = moved_centroids(state, known)
    final = stored(_measured(assigned(state, known), known), "clusters")
    per = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most k rows
    rows = [(r["cluster"], r["cluster_inertia"], sum(p["cluster_inertia"] for p in per), hashlib.sha256(",".join(map(str, known.at[r["cluster"]].tolist())).encode()).hexdigest()) for r in per]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _measured(state: DataFrame, known: Centroids) -> DataFrame:
    dim = known.at.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, cluster = _vectors(batch.column(1), dim), batch.column(2).to_numpy(zero_copy_only=False)
            parts = [squares(x[i : i + STEP], known.at[cluster[i : i + STEP]]) for i in range(0, len(x), STEP)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))], ["vec_id", "cluster", "distance"])

    return state.mapInArrow(measure, "vec_id long, cluster int, distance long")
