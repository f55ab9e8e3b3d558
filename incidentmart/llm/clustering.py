"""Centroid clustering of integer vectors by scalar lookup tables.

Components are integers, so a round needs few different squared differences:
for each dimension one per occurring value and centroid.  A task tabulates them
for the values of a batch of vectors; the distances to all centroids are then
table gathers and sums, in exact integers, without a multiplication per vector.

A round sends the centroids out (their number times the dimensions) and gets
back sums and counts per task, cluster and dimension.  Vectors are never
shuffled, and nothing that grows with them reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stage, without

BATCH = 4096                    # vectors whose values are tabulated at once
OUT = ["cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def largest(dims: int) -> int:
    """The largest size of a component at which squared distances are 32-bit differences summed in 64 bits."""
    return min(isqrt((1 << 63) // (4 * max(dims, 1))) - 1, (1 << 30) - 1)


def quantise(vectors: DataFrame, vec_col: str, dims: int, scale: int, name: str) -> DataFrame:
    """Rows whose vector has ``dims`` components, none null or not finite, with ``name``: floor(scale * x) of each.

    A component beyond ``largest(dims)`` fails the query, since its squared
    distances may be no 64-bit numbers.
    """
    limit = largest(dims)
    x = F.transform(F.col(f"`{vec_col}`"), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.when(F.abs(v * scale) < limit, F.floor(v * scale)).otherwise(
        F.raise_error(F.lit(f"a component is beyond {limit} / {scale}")).cast("bigint")).cast("int"))
    kept = vectors.filter((F.size(F.col(f"`{vec_col}`")) == dims) & F.coalesce(finite, F.lit(False)))
    return kept.withColumn(name, whole)


def first_centroids(rows: DataFrame, id_col: str, vec: str, k: int, seed: int) -> list[list[int]]:
    """The vectors of the ``k`` smallest SHA-256 of ``seed:id``, in that order; equal hashes by their components."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_col}`").cast("string")), 256)
    best = rows.select(h.alias("h"), F.col(vec).alias("v")).filter("h IS NOT NULL").orderBy("h", "v").limit(k)
    return [list(r.v) for r in best.collect()]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of integers the number of the nearest centroid, the smaller on ties, and the squared distance."""
    total = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(x.shape[1]):
        values, place = np.unique(x[:, d], return_inverse=True)
        table = values[:, None].astype(np.int64) - centroids[:, d]      # one row per occurring value, one column per centroid
        table *= table
        total += table[place]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(x)), best]


def _batches(batches: Iterator[pa.RecordBatch], vec: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, BATCH):
            part = b.slice(i, BATCH)
            yield part, part.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)


def round_sums(rows: DataFrame, vec: str, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per cluster with vectors: how many, and the exact sum of each component.

    Tasks add up their own vectors; ``k * dims`` sums per task are combined and
    as many reach the driver.
    """
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x in _batches(batches, vec, dims):
            own, _ = nearest(x, centroids)
            order = np.argsort(own, kind="stable")
            met, first = np.unique(own[order], return_index=True)
            sums[met] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            counts += np.bincount(own, minlength=k)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = rows.select(vec).mapInArrow(run, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("d", "x"))
    total = each.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(total, key=lambda r: (r.cluster, r.d)):
        out.setdefault(r.cluster, (r.n, []))[1].append(int(r.x))
    return out


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Every centroid with vectors at their componentwise floor(sum / count); the others stay."""
    out = centroids.copy()
    for c, (n, x) in sums.items():
        out[c] = [v // n for v in x]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5,
            scale: int = 256, seed: int = 2, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all) of every row with a usable vector, plus ``cluster, distance, cluster_inertia, inertia, centroid``.

    Usable: exactly ``dims`` components, none null, NaN or infinite; other rows
    are left out.  Components are floor(scale * x).  The first centroids are the
    ``k`` vectors whose id has the smallest SHA-256 of ``seed:id``; a null id
    starts no cluster, ids that repeat may start several, equal ones by their
    components.  Each round assigns every vector to the nearest centroid
    (squared Euclidean distance, ties to the smaller number), then moves
    non-empty centroids to the componentwise floor of the mean.  A last
    assignment gives the result: ``distance`` squared, its sum per cluster and
    over all, and the cluster's ``centroid``.

    Fewer vectors than ``k`` make fewer clusters; without a vector or without
    an id the result is empty.  Repeated rows count each.  Input columns named
    like an output column are replaced.  A component beyond ``largest(dims)`` (1.9 * 10^8 at 64)
    fails, as does an inertia beyond 64 bits.
    """
    keep = without(vectors.select(*[F.col(f"`{c}`") for c in columns]) if columns is not None else vectors, OUT)
    names = keep.columns
    spark = vectors.sparkSession
    vec, key, of = fresh([*names, *OUT], "whole_vector", "vector_key", "of_cluster")
    rows = quantise(vectors, vec_col, dims, scale, vec)
    rows = stage(rows.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{id_col}`").alias(key), vec), "vectors")
    centroids = np.array(first_centroids(rows, key, vec, k, seed), np.int64).reshape(-1, dims)
    kind = T.StructType([*keep.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not len(centroids):
        rows = rows.limit(0)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, round_sums(rows, vec, centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _batches(batches, vec, dims):
            own, far = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(own, pa.int32()), pa.array(far)], names=[*names, "cluster", "distance"])

    placed = stage(rows.mapInArrow(run, kind), "clustered")
    per = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()         # at most k rows
    total = sum((r.x for r in per), Decimal(0))
    if total >= 1 << 63:
        raise OverflowError("the inertia is beyond 64 bits")
    known = spark.createDataFrame([(r.cluster, int(r.x), int(total), centroids[r.cluster].tolist()) for r in per],
                                  f"`{of}` int, cluster_inertia long, inertia long, centroid array<long>")
    return placed.join(F.broadcast(known), F.col("cluster") == F.col(of)).select(*[F.col(f"`{c}`") for c in names], *OUT)
