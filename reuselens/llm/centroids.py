"""Centroid clustering of integer vectors over subvector dictionaries.

The kept vectors are turned into integers and written once, in chunks of up to
``CHUNK`` rows: the dimensions are cut into blocks of ``WIDTH``, each block's
distinct subvectors are the chunk's dictionary of that block, and a vector is
its codes. Nothing is lost: the codes give the integers back. A round computes
the exact distance of every dictionary entry to every centroid once, sums a
vector's distances up by its codes, and counts codes per cluster, so that the
cluster sums come from the dictionary too. All numbers are 64-bit integers.

Dictionaries belong to a chunk, as in columnar files: they are never larger
than the chunk, need no shuffle and no broadcast, and a lost task is read
again from its chunk. The driver holds the centroids (clusters x dimensions)
and receives that many sums a round.

Defined results: vectors that are null, of another length, or with a null or
non-finite component are left out; repeated rows count as rows; a null vec_id
hashes as the empty string. Fewer vectors than clusters give as many clusters
as vectors; an empty table gives an empty result. A scaled component beyond
``LARGEST`` could overflow a distance and is an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reuselens.llm.common import materialise

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
WIDTH = 2                    # dimensions of a block
CHUNK = 16_384               # vectors that share dictionaries; codes are 16-bit
LARGEST = 1 << 27            # of a scaled component


# ---------------------------------------------------------------- in a task

def encode(x: np.ndarray, width: int = WIDTH):
    """``(codes, entries)`` of integer rows: ``codes[:, b]`` are the places of
    block b's subvectors in ``entries[b]``."""
    codes, entries = [], []
    for lo in range(0, x.shape[1], width):
        part = x[:, lo:lo + width]
        key = np.zeros(len(x), np.int64)
        for d in range(part.shape[1]):
            values, at = np.unique(part[:, d], return_inverse=True)
            first, key = np.unique(key * len(values) + at, return_index=True, return_inverse=True)[1:]
        codes.append(key.astype(np.uint16))
        entries.append(part[first])
    return np.stack(codes, axis=1), entries


def nearest(codes: np.ndarray, entries: list[np.ndarray], centroids: np.ndarray):
    """``(cluster, distance)`` of every row; the smaller number wins a tie."""
    total = np.zeros((len(codes), len(centroids)), np.int64)
    lo = 0
    for b, e in enumerate(entries):
        apart = e[:, None, :] - centroids[None, :, lo:lo + e.shape[1]]
        total += (apart * apart).sum(axis=2)[codes[:, b]]
        lo += e.shape[1]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(codes)), cluster]


def cluster_sums(codes: np.ndarray, entries: list[np.ndarray], cluster: np.ndarray, k: int) -> np.ndarray:
    """Sum of each cluster's rows, from the times each code occurs in it."""
    parts = []
    for b, e in enumerate(entries):
        times = np.bincount(cluster * len(e) + codes[:, b], minlength=k * len(e)).reshape(k, len(e))
        parts.append(times.astype(np.int64) @ e)
    return np.concatenate(parts, axis=1)


def _chunks(dimensions: int, scale: int, width: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
                x = np.floor(flat.astype(np.float64) * scale)
                if len(x) and np.abs(x).max() > LARGEST:
                    raise ValueError(f"a component beyond {LARGEST} once scaled")
                codes, entries = encode(x.astype(np.int64).reshape(part.num_rows, dimensions), width)
                ids = pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64()))
                yield pa.record_batch({
                    "ids": ids, "codes": pa.array([codes.tobytes()]), "sizes": pa.array([[len(e) for e in entries]], pa.list_(pa.int32())),
                    "entries": pa.array([np.concatenate([e.ravel() for e in entries]).astype("<i8").tobytes()])})

    return run


def _decoded(batch, dimensions: int, width: int):
    """The chunks of a batch: ``(ids, codes, entries)``."""
    widths = [min(width, dimensions - lo) for lo in range(0, dimensions, width)]
    for i in range(batch.num_rows):
        codes = np.frombuffer(batch.column("codes")[i].as_py(), np.uint16).reshape(-1, len(widths))
        flat = np.frombuffer(batch.column("entries")[i].as_py(), "<i8")
        sizes = batch.column("sizes")[i].as_py()
        ends = np.cumsum([n * w for n, w in zip(sizes, widths, strict=True)])
        entries = [flat[e - n * w:e].reshape(n, w) for e, n, w in zip(ends, sizes, widths, strict=True)]
        yield batch.column("ids")[i].values, codes, entries


def _task_sums(centroids: np.ndarray, width: int):
    """Per task and cluster the rows, and per dimension their sums."""
    def run(batches):
        k, dims = centroids.shape
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, codes, entries in _decoded(batch, dims, width):
                cluster, _ = nearest(codes, entries, centroids)
                total += cluster_sums(codes, entries, cluster, k)
                count += np.bincount(cluster, minlength=k)
        yield pa.record_batch({"cluster": pa.array(np.repeat(np.arange(k), dims), pa.int32()), "dim": pa.array(np.tile(np.arange(dims), k), pa.int32()),
                               "total": pa.array(total.ravel()), "n": pa.array(np.repeat(count, dims))})

    return run


def _assigned(centroids: np.ndarray, width: int):
    def run(batches):
        for batch in batches:
            for ids, codes, entries in _decoded(batch, centroids.shape[1], width):
                cluster, distance = nearest(codes, entries, centroids)
                yield pa.record_batch({"vec_id": ids, "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance)})

    return run


# ------------------------------------------------------------------ in Spark

def usable(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id, embedding`` (array<double>) of the vectors with ``dimensions``
    components, all of them finite numbers."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
    finite = F.forall("embedding", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    return rows.where(F.coalesce((F.size("embedding") == dimensions) & finite, F.lit(False)))


def first_centroids(rows: DataFrame, k: int = CLUSTERS, seed: str = SEED, scale: int = SCALE) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    whole = F.transform("embedding", lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    picked = rows.select(mark.alias("mark"), whole.alias("x")).orderBy("mark", "x").limit(k).collect()
    return np.array([r["x"] for r in picked], np.int64)


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, scale: int = SCALE,
            dimensions: int = DIMENSIONS, width: int = WIDTH):
    """``(assigned, centroids)``: rows ``vec_id, cluster, distance`` and the
    final centroids (an integer array; row i is cluster i)."""
    rows = usable(vectors, dimensions)
    centroids = first_centroids(rows, k, seed, scale)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    coded = materialise(rows.mapInArrow(_chunks(dimensions, scale, width), T.StructType([
        T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType()),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("entries", T.BinaryType())])))
    for _ in range(rounds):
        sums = coded.mapInArrow(_task_sums(centroids, width), "cluster int, dim int, total long, n long") \
            .groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).where(F.col("n") > 0).collect()
        centroids = centroids.copy()
        for r in sums:                                   # clusters x dimensions
            centroids[r["cluster"], r["dim"]] = r["total"] // r["n"]
    return materialise(coded.mapInArrow(_assigned(centroids, width), "vec_id long, cluster int, distance long")), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with their cluster's and the whole inertia, and the SHA-256 of
    their final centroid."""
    spark = assigned.sparkSession
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    per = spark.createDataFrame(
        [(c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
