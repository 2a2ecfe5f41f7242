"""Centroid clustering in integers, with a PCA-rotated filter.

Components become integers, and everything that decides is exact integer arithmetic.  What saves work is a
table that is written once: for each vector the integers, its ``LEAD`` leading coordinates in the rotation of
the principal axes, and the norm of the rest.  The squared distance of the leading coordinates plus the
squared difference of the rest's norms is at most the squared distance of the vectors; a centroid whose bound
is above a distance already known can't be nearest.  The survivors are verified in integers.

Rounds are passes over that table.  A partition sends one row of sums per centroid; centroids, a fixed number
of rows, go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Leading rotated coordinates that are stored.
LEAD = 12
#: Largest integer component: squared distances and sums of a batch stay exact in 64 bits.
LARGEST = 1 << 27
#: Bounds are computed in floating point; a centroid is left out only if its bound is above by this share.
_SLACK = 1e-9


def integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component as a double; an error beyond ``LARGEST``."""
    whole = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    too_large = F.exists(vector, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) > LARGEST)
    return F.when(too_large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(
        F.transform(vector, whole)
    )


def is_whole(vector: Column, dims: int) -> Column:
    """Exactly ``dims`` components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _moments(dims: int):
    """Per partition: number of rows, sums and products of all components, in floating point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims).astype(float)
            n, total, products = n + len(x), total + x.sum(0), products + x.T @ x
        if n:
            values = np.concatenate([[n], total, products.ravel()])
            yield pa.RecordBatch.from_pydict({"pos": np.arange(len(values), dtype=np.int32), "x": values})

    return run


def principal_axes(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and all principal axes (columns, leading ones first) of the integer vectors of all rows."""
    sums = rows.select("v").mapInArrow(_moments(dims), "pos int, x double").groupBy("pos").agg(F.sum("x").alias("x"))
    found = {r.pos: r.x for r in sums.collect()}  # 1 + dims + dims * dims numbers
    if not found:
        return np.zeros(dims), np.eye(dims)
    values = np.array([found[i] for i in range(len(found))])
    mean = values[1 : 1 + dims] / values[0]
    spread = values[1 + dims :].reshape(dims, dims) / values[0] - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1]


def rotated(v: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int) -> np.ndarray:
    """Leading coordinates in the rotation, and the norm of the rest as last column."""
    every = (v - mean) @ axes
    rest = np.sqrt((every[:, lead:] ** 2).sum(1))
    return np.concatenate([every[:, :lead], rest[:, None]], 1)


def _rotate(mean: np.ndarray, axes: np.ndarray, lead: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filtered = rotated(_matrix(batch.column(1), dims).astype(float), mean, axes, lead)
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(len(filtered) + 1, dtype=np.int32) * filtered.shape[1]), pa.array(filtered.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], ["id", "v", "z"])

    return run


def nearest(v: np.ndarray, z: np.ndarray, centroids: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: smallest number), its squared distance, and how many were verified.

    ``z`` and ``turned`` are the rotated rows and centroids.  Both filter columns and the norm of the rest
    count alike: a squared difference of norms is at most the squared distance of what they are norms of.
    """
    low = np.maximum((z * z).sum(1)[:, None] + (turned * turned).sum(1)[None] - 2 * z @ turned.T, 0)
    slack = _SLACK * ((z * z).sum(1)[:, None] + (turned * turned).sum(1)[None] + 1)
    low -= slack
    cluster = low.argmin(1)
    distance = ((v - centroids[cluster]) ** 2).sum(1)
    verified = len(v)
    for c in range(len(centroids)):
        left = np.flatnonzero((low[:, c] <= distance) & (cluster != c))
        verified += len(left)
        own = ((v[left] - centroids[c]) ** 2).sum(1)
        better = (own < distance[left]) | ((own == distance[left]) & (c < cluster[left]))
        cluster[left[better]], distance[left[better]] = c, own[better]
    return cluster, distance, verified


def _sums(centroids: np.ndarray, turned: np.ndarray, lead: int):
    """Per partition and cluster: rows and sums of the components; and how many distances were verified."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), dims)
            cluster, *_ = nearest(v, _matrix(batch.column(1), lead + 1), centroids, turned)
            np.add.at(total, cluster, v)
            n += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(n)
        if len(used):
            yield pa.RecordBatch.from_pydict(
                {"cluster": used.astype(np.int32), "n": n[used], "total": pa.array(total[used].tolist(), pa.list_(pa.int64()))}
            )

    return run


def _assign(centroids: np.ndarray, turned: np.ndarray, lead: int):
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, verified = nearest(
                _matrix(batch.column(1), dims), _matrix(batch.column(2), lead + 1), centroids, turned
            )
            out = [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(out, ["id", "cluster", "distance"])

    return run


def _seeds(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of ``seed:id``; equal ids by their components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()  # k rows
    return np.array([r.v for r in first], np.int64)


def fit(rows: DataFrame, k: int, rounds: int, seed: str, mean: np.ndarray, axes: np.ndarray, lead: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds over the written rows ``(id, v, z)``."""
    centroids = _seeds(rows, k, seed)
    if not len(centroids):
        return centroids
    for _ in range(rounds):
        turned = rotated(centroids.astype(float), mean, axes, lead)
        parts = rows.select("v", "z").mapInArrow(_sums(centroids, turned, lead), "cluster int, n long, total array<long>")
        cells = parts.select("cluster", "n", F.posexplode("total").alias("pos", "x"))
        sums = cells.groupBy("cluster", "pos").agg(
            F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n")
        )
        for r in sums.collect():  # k * dims rows
            centroids[r.cluster, r.pos] = int(r.x) // int(r.n)
    return centroids


def clusters(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: str = "1",
    lead: int = LEAD,
) -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` of the kept vectors, and the centroids.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; a component ``x`` counts as the
    integer ``floor(scale * x)``.  Centroids start as the ``k`` kept vectors with the smallest SHA-256 of
    ``seed:id`` (null ids last; fewer vectors, fewer centroids) and become the floored means of their vectors,
    ``rounds`` times; an empty one stays.  Ties go to the smaller number.  Repeated rows stay repeated, equal
    vectors get one cluster, and an empty table gives no rows and no centroids.
    """
    lead = min(lead, dims)
    own = vectors.select(F.col(id_column).alias("id"), F.col(vector).alias("x")).filter(is_whole(F.col("x"), dims))
    whole = materialize(own.select("id", integers(F.col("x"), scale).alias("v")))
    mean, axes = principal_axes(whole, dims)
    id_type = whole.schema["id"].dataType.simpleString()
    rows = whole.mapInArrow(_rotate(mean, axes, lead, dims), f"id {id_type}, v array<long>, z array<double>")
    rows = materialize(rows)
    centroids = fit(rows, k, rounds, seed, mean, axes, lead)
    if not len(centroids):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    turned = rotated(centroids.astype(float), mean, axes, lead)
    found = rows.mapInArrow(_assign(centroids, turned, lead), f"id {id_type}, cluster int, distance long")
    return materialize(found), centroids


def summary(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; one row per centroid joins."""
    # At most one row per centroid, a parameter of the fit.
    per_cluster = found.groupBy(F.col("cluster").alias("of")).agg(F.sum("distance").alias("cluster_inertia"))
    all_of = per_cluster.agg(F.sum("cluster_inertia").alias("inertia"))
    names = found.sparkSession.createDataFrame(
        [(i, ",".join(map(str, c.tolist()))) for i, c in enumerate(centroids)], "of int, centroid string"
    ).select("of", F.sha2("centroid", 256).alias("centroid_sha256"))
    held = per_cluster.join(names, "of").crossJoin(F.broadcast(all_of))
    return found.join(F.broadcast(held), F.col("cluster") == F.col("of")).drop("of")
