"""Centroid clustering in whole numbers, by a progressive search over Walsh-Hadamard coefficients.

Vectors become integers, so every step is exact and has one result whatever the
partitioning. The transform keeps distances: the squared differences of all
coefficients sum to ``size`` times the squared distance, and any of them sum to a
lower bound. Coefficients are taken coarse to fine (by sign changes); after each
band, centroids whose bound is above the full distance of the best candidate so
far are given up, and what is left is summed to the end.

A round reads the vectors once and sends one row per task and centroid; only the
``k * size`` numbers of the centroids come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Components are held within this: all sums of squared coefficients then fit in 64 bits.
MOST = 1 << 24
# Vectors that a task searches at once.
ROWS = 2048


@dataclass(frozen=True)
class ClusterParams:
    """``k`` centroids, ``rounds`` of moving them; ``size`` components (a power of two), each ``floor(scale * x)``;
    ``salt`` orders the vectors that begin as centroids; ``bands``: coefficients after which centroids are given up."""

    k: int = 40
    rounds: int = 5
    size: int = 64
    scale: int = 256
    salt: str = "2"
    bands: tuple[int, ...] = (4, 8, 16, 32)

    def __post_init__(self) -> None:
        if self.size < 1 or self.size & (self.size - 1):
            raise ValueError("size must be a power of two")
        if self.k < 1 or self.rounds < 0:
            raise ValueError("k must be at least 1 and rounds at least 0")


@cache
def hadamard(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix, rows by their number of sign changes."""
    rows = np.ones((1, 1))
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1))]


def coefficients(vectors: np.ndarray) -> np.ndarray:
    """The transform of each row. Products and sums stay below 2^53, so floating point is exact here."""
    return (vectors @ hadamard(vectors.shape[1]).T).astype(np.int64)


def _whole(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    difference = v - c
    return (difference * difference).sum(axis=1)


def _least(row: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Of each row's pairs (rows ascend) the place of the first that is smallest."""
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    lowest = np.repeat(np.minimum.reduceat(part, begin), np.diff(np.append(begin, len(row))))
    hits = np.flatnonzero(part == lowest)
    return hits[np.append(True, row[hits][1:] != row[hits][:-1])]


def nearest(vectors: np.ndarray, centroids: np.ndarray, bands: tuple[int, ...] = ClusterParams.bands) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid (the first of equal ones) and the squared distance."""
    size = vectors.shape[1]
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    v, c = coefficients(vectors), coefficients(centroids)
    row, own = np.divmod(np.arange(len(v) * len(c)), len(c))
    part = np.zeros(len(row), np.int64)
    bound = np.full(len(v), np.iinfo(np.int64).max)
    at = 0
    for end in (*[b for b in bands if b < size], size):
        part += _whole(v[row, at:end], c[own, at:end])
        at = end
        best = own[_least(row, part)]
        if end < size:
            np.minimum(bound, _whole(v, c[best]), out=bound)
            stay = part <= bound[row]
            row, own, part = row[stay], own[stay], part[stay]
    least = _least(row, part)
    return own[least], part[least] // size


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)


def whole_vectors(frame: DataFrame, params: ClusterParams, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: the vectors of ``size`` finite components, as integers."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def integer(x: Column) -> Column:
        return F.least(F.greatest(F.floor(x.cast("double") * params.scale), F.lit(-MOST)), F.lit(MOST)).cast("int")

    kept = frame.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    kept = kept.where((F.size("x") == params.size) & F.forall("x", finite))
    return kept.select("id", F.transform("x", integer).alias("v"))


def first_centroids(vectors: DataFrame, params: ClusterParams) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id, in that order; fewer if there are fewer."""
    name = F.concat(F.lit(f"{params.salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    first = vectors.select(F.sha2(name, 256).alias("h"), "id", "v").orderBy("h", "id", "v").limit(params.k).select("v").collect()
    return np.array([r["v"] for r in first], np.int64).reshape(-1, params.size)


def moved(vectors: DataFrame, centroids: np.ndarray, params: ClusterParams) -> np.ndarray:
    """The centroids after one round: floored means of their vectors; one without vectors stays."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = _vectors(batch.slice(at, ROWS), params.size)
                cluster, _ = nearest(own, centroids, params.bands)
                np.add.at(sums, cluster, own)
                counts += np.bincount(cluster, minlength=len(centroids))
        have = np.flatnonzero(counts)
        columns = [pa.array(have.astype(np.int32)), pa.array(counts[have]), pa.array(sums[have].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    partial = vectors.select("v").mapInArrow(step, "cluster int, n long, sums array<long>")
    totals = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(params.size)])
    out = centroids.copy()
    for row in totals.collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(params.size)]
    return out


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    frame: DataFrame, params: ClusterParams = ClusterParams(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that is kept.

    Null vectors, those of another length and those with a null, NaN or infinite
    component are left out. Components beyond ``2^24`` after scaling count as that
    bound, so that sums fit in 64 bits. Null ids are hashed as ``null``; rows that
    repeat are vectors of their own, ties among the first centroids go by id and then
    by components. With fewer vectors than ``k`` there are as many centroids as
    vectors; an empty table gives no rows. Other columns are not read.
    """
    vectors = written(whole_vectors(frame, params, id_col, vector_col), "vectors")
    kind = dict(vectors.dtypes)["id"]
    centroids = first_centroids(vectors, params)
    if not len(centroids):
        schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return frame.sparkSession.createDataFrame([], schema)
    for _ in range(params.rounds):
        centroids = moved(vectors, centroids, params)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                cluster, distance = nearest(_vectors(part, params.size), centroids, params.bands)
                columns = [part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = written(vectors.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = [(i, d, sum(sums.values()), _digest(centroids[i])) for i, d in sums.items()]
    # At most k rows.
    per_cluster = frame.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
