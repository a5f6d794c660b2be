"""Centroid clustering of integer vectors by scalar lookup tables.

Components are whole numbers, so a dimension takes few different values. Each
round tabulates, for every dimension, value that occurs and centroid, the
squared difference; a vector's distances are gathers from these tables, added
up. All sums are exact: results do not depend on partitioning.

Only centroids pass the driver: a fixed number of them, of fixed width.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.session import stage

#: Components below this size and at most this many dimensions: squared distances fit into a long.
LIMIT, DIMENSIONS = 1 << 25, 1024
#: Vectors coded and looked up together: bounds tables and distances.
TOGETHER = 4096


def scaled(vector: Column, dimension: int, factor: int = 1024) -> Column:
    """floor(factor * x) of each component as longs; null unless all of `dimension` components are finite numbers."""
    wide = vector.cast("array<double>")
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(wide) == dimension) & fine, F.transform(wide, lambda x: F.floor(x * F.lit(float(factor)))))


def coded(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a column, ascending, and the place of each row's value among them."""
    low, high = int(column.min()), int(column.max())
    if high - low < 8 * len(column):  # count the values in place of sorting
        seen = np.zeros(high - low + 1, bool)
        seen[column - low] = True
        return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[column - low]
    return np.unique(column, return_inverse=True)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to each centroid, gathered from one table per dimension."""
    out = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        values, code = coded(vectors[:, d])
        table = np.square(values[:, None] - centroids[None, :, d])
        out += table[code]
    return out


def _blocks(batch: pa.RecordBatch, dimension: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for at in range(0, batch.num_rows, TOGETHER):
        part = batch.slice(at, TOGETHER)
        yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _totals(centroids: np.ndarray):
    """Per task and centroid: vectors, component sums, distance sum in two halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dimension = centroids.shape
        count, sums = np.zeros(k, np.int64), np.zeros((k, dimension), np.int64)
        inertia = np.zeros((2, k), np.int64)  # upper and lower halves: a sum of distances may be longer than a long

        def row():
            values = [np.arange(k), count, pa.array(sums.tolist(), pa.list_(pa.int64())), *inertia]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["cluster", "n", "sums", "upper", "lower"])

        for batch in batches:
            for _, vectors in _blocks(batch, dimension):
                away = distances(vectors, centroids)
                nearest = away.argmin(axis=1)  # the smaller number among equals
                count += np.bincount(nearest, minlength=k)
                for c in range(k):
                    sums[c] += vectors[nearest == c].sum(axis=0)
                    own = away[nearest == c, c]
                    inertia[:, c] += (own >> 32).sum(), (own & 0xFFFFFFFF).sum()
            if count.sum() > 1 << 16:  # given on long before any sum could overflow
                yield row()
                count, sums, inertia = np.zeros_like(count), np.zeros_like(sums), np.zeros_like(inertia)
        if count.any():
            yield row()

    return run


def round_totals(vectors: DataFrame, centroids: np.ndarray) -> list:
    """Per centroid that has vectors: n, component sums s0, s1, ..., and its distance sum as upper * 2^32 + lower, all exact."""
    parts = vectors.mapInArrow(_totals(centroids), "cluster bigint, n bigint, sums array<bigint>, upper bigint, lower bigint")
    wide = "decimal(38,0)"
    each = [F.sum(F.col("sums")[d].cast(wide)).alias(f"s{d}") for d in range(centroids.shape[1])]
    halves = [F.sum(F.col(c).cast(wide)).alias(c) for c in ("upper", "lower")]
    return parts.filter("n > 0").groupBy("cluster").agg(F.sum("n").alias("n"), *halves, *each).collect()


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    dimension: int = 64,
    k: int = 8,
    rounds: int = 10,
    factor: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each whole vector.

    Vectors that are null, of another length, or with a null or non-finite
    component are left out. The first centroids are the `k` vectors lowest by
    the SHA-256 of `seed:id` (a null id counts as empty text, rows of one id by
    their components), all of them if there are fewer. A vector goes to its
    nearest centroid, the smaller number among equals. A centroid becomes the
    floor of its vectors' mean; one without vectors stays. Rows that repeat each
    count and each get a row. An empty table gives an empty table. Components
    of `LIMIT` or more after scaling raise an error: their squared distances
    are no longs. Other columns are not read.
    """
    if dimension > DIMENSIONS:
        raise ValueError(f"more than {DIMENSIONS} dimensions: squared distances may not fit into a long")
    rows = vectors.select(F.col(id_col).alias("_id"), scaled(F.col(vector), dimension, factor).alias("_v")).filter("_v IS NOT NULL")
    rows = stage(rows)
    biggest = rows.agg(F.max(F.greatest(F.array_max("_v"), -F.array_min("_v")))).first()[0]
    if biggest is not None and biggest >= LIMIT:
        raise ValueError(f"a component of {biggest} after scaling; squared distances need less than {LIMIT}")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    first = rows.select(place.alias("_place"), "_v").orderBy("_place", "_v").limit(k).collect()
    id_type = rows.schema["_id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return rows.sparkSession.createDataFrame([], schema)
    centers = np.array([r["_v"] for r in first], np.int64)
    for _ in range(rounds):
        for r in round_totals(rows, centers):
            centers[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dimension)]
    inertia = np.zeros(len(centers), np.int64)
    for r in round_totals(rows, centers):
        inertia[r["cluster"]] = (int(r["upper"]) << 32) + int(r["lower"])
    digests = [centroid_digest(c) for c in centers]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, own in _blocks(batch, dimension):
                away = distances(own, centers)
                nearest = away.argmin(axis=1)
                values = [
                    ids, pa.array(nearest.astype(np.int32)), pa.array(away[np.arange(len(own)), nearest]), pa.array(inertia[nearest]),
                    pa.array(np.full(len(own), inertia.sum())), pa.array([digests[c] for c in nearest], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(values, names=[id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return rows.mapInArrow(assign, schema)
