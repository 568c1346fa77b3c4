"""Centroid clustering of vectors with bounds that geometry keeps tight.

Each vector carries an upper bound on the distance to its centroid and a lower bound on the distance to
all others. While the upper one is smaller, the vector cannot change its cluster and no distance is
computed. When centroids move, the upper bound grows by the own centroid's drift. The lower one would
shrink by the largest drift; it shrinks by less, as only vectors inside the cluster's sphere matter.
Look at the plane through the sphere's centre and a centroid's way from p to q, with m half way. For
any x the distances' difference is |x-p| - |x-q| = 2 (x-m)(q-p) / (|x-p| + |x-q|), and the two lengths
add up to at least 2 |x-m|. So x comes closer to the centroid by at most |q-p| times the cosine of the
angle at m between x and q. Seen from m, a sphere of radius r at distance d spans arcsin(r/d) about its
centre's angle, which leaves the smallest angle any vector of the cluster can have. Vectors that the
bounds do not settle are scanned against all centroids, in exact integers.

A round is one pass over the vectors. It writes each vector with its bounds, and per task what the
vectors that moved add to and take from their clusters. The driver holds the centroids and their sums,
a row per cluster. The pass before is deleted once the next is written.

Nulls and edges: vectors of another length, null or with null or non-finite components stay out.
A null identifier is one like any other, and last in the choice of first centroids. Repeated rows count
each. With fewer vectors than clusters there are as many clusters as vectors; an empty table gives no
rows. A component whose integer passes ``LIMIT`` is an error, as squared distances would pass a long.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import id_text, settled, table
from kerbside.session import scratch_dir
from kerbside.sources import paths

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
LIMIT = 2**27  # the largest integer of a component
IN_DOUBLES = 2**22  # up to here squared distances are exact in doubles
SLACK = 1e-9  # what rounding may add to a bound, relative


class Step(NamedTuple):
    """What one update of the centroids does to the bounds, by cluster."""

    drift: np.ndarray
    loosening: np.ndarray


def packed(ints: np.ndarray) -> pa.Array:
    """Rows of whole numbers as binary: two bytes a component where all of a row's fit, else four."""
    small = (np.abs(ints) < 2**15).all(axis=1)
    if small.all():
        data = ints.astype("<i2").tobytes()
        ends = np.arange(len(ints) + 1, dtype=np.int32) * (2 * ints.shape[1])
        return pa.Array.from_buffers(pa.binary(), len(ints), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.array([row.astype("<i2" if s else "<i4").tobytes() for row, s in zip(ints, small)], pa.binary())


def unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    """The rows of whole numbers, as doubles while these are exact, else as 64-bit integers."""
    rows = column.to_pylist()
    if all(len(r) == 2 * dimensions for r in rows):
        return np.frombuffer(b"".join(rows), "<i2").reshape(-1, dimensions).astype(np.float64)
    ints = np.array([np.frombuffer(r, "<i2" if len(r) == 2 * dimensions else "<i4") for r in rows], np.int64)
    return ints.astype(np.float64) if np.abs(ints).max() <= IN_DOUBLES else ints


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors to cluster, as :func:`packed` integers floor(scale * x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            fits = pc.fill_null(pc.equal(pc.list_value_length(lists), dimensions), False)
            flat = lists.filter(fits).flatten().to_numpy(zero_copy_only=False)
            x = flat.astype(np.float64).reshape(-1, dimensions)  # a null component becomes a NaN
            finite = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                ints = np.floor(x[finite] * scale)
            if len(ints) and np.abs(ints).max() > LIMIT:
                raise ValueError(f"a component times {scale} passes {LIMIT}")
            ids = batch.column(0).filter(fits).filter(pa.array(finite))
            yield pa.RecordBatch.from_arrays([ids, packed(ints.astype(np.int64))], ["vec_id", "v"])

    vec_id = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {vec_id}, v binary")


def squared_distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per vector and a column per centroid."""
    if v.dtype == np.float64 and np.abs(centroids).max() <= IN_DOUBLES:
        c = centroids.astype(np.float64)
    else:
        v, c = v.astype(np.int64), centroids
    return (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster how much closer any other centroid can have come to any of its vectors.

    ``radius`` is that of the sphere about the old centroid that holds the cluster's vectors.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    most = np.zeros(len(old))
    for j, (p, q) in enumerate(zip(old, new)):
        drift = np.linalg.norm(q - p)
        if drift == 0:
            continue
        way = old - (p + q) / 2
        distance = np.linalg.norm(way, axis=1)
        outside = distance > radius
        far = np.where(outside, distance, 1)
        angle = np.arccos(np.clip(way @ (q - p) / (far * drift), -1, 1))
        least = np.maximum(angle - np.arcsin(np.where(outside, radius / far, 0)), 0)
        closer = np.where(outside, drift * np.maximum(np.cos(least), 0), drift)
        closer[j] = 0
        most = np.maximum(most, closer)
    return most * (1 + SLACK) + SLACK


def half_gaps(centroids: np.ndarray) -> np.ndarray:
    """Half the distance of each centroid to the next one: what lies nearer than this is its own."""
    between = squared_distances(centroids, centroids).astype(np.float64)
    np.fill_diagonal(between, np.inf)
    return np.sqrt(between.min(axis=1)) / 2 * (1 - SLACK)


def scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, the smaller number on ties, and the bounds: its distance and the next one's."""
    d = squared_distances(v, centroids)
    near = d.argmin(axis=1)
    d = d.astype(np.float64)
    rows = np.arange(len(v))
    own = d[rows, near]
    d[rows, near] = np.inf
    return near, np.sqrt(own) * (1 + SLACK), np.sqrt(d.min(axis=1)) * (1 - SLACK)


def reassigned(
    v: np.ndarray, was: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, step: Step
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after a step, and how many vectors had to be scanned."""
    near, upper, lower = was.copy(), upper + step.drift[was], lower - step.loosening[was]
    enough = np.maximum(lower, half_gaps(centroids)[was]) if len(centroids) > 1 else lower
    unsure = np.nonzero(~(upper < enough))[0]
    if len(unsure):  # first the own centroid alone
        own, at = v[unsure] - centroids[was[unsure]], unsure
        upper[at] = np.sqrt((own * own).sum(axis=1).astype(np.float64)) * (1 + SLACK)
        unsure = at[~(upper[at] < enough[at])]
    if len(unsure):
        near[unsure], upper[unsure], lower[unsure] = scan(v[unsure], centroids)
    return near, upper, lower, len(unsure)


class Clustering(NamedTuple):
    """The vectors (vec_id, v, cluster, upper, lower), the final centroids, vectors scanned by pass."""

    vectors: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def _schema(rows: DataFrame) -> str:
    """What a pass writes."""
    return (
        f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, v binary, cluster int, upper double,"
        " lower double, delta array<long>, scanned long, part string"
    )


def _pass(rows: DataFrame, centroids: np.ndarray, step: Step | None, path: str) -> None:
    """Assign all vectors and write them under ``path``, beside what each task's moved ones change.

    Rows of part ``change`` have, by cluster, the largest upper bound, the vectors scanned and in
    ``delta`` the number and the sums by which the cluster grew.
    """
    k, dimensions = centroids.shape
    schema = _schema(rows)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        delta = np.zeros((k, dimensions + 1), np.int64)
        radius, scanned, id_type = np.zeros(k), 0, None
        for batch in batches:
            id_type = batch.column(0).type
            if not batch.num_rows:
                continue
            v = unpacked(batch.column(1), dimensions)
            if step is None:
                near, upper, lower = scan(v, centroids)
                was, n = np.full(len(v), -1), len(v)
            else:
                was, upper, lower = (batch.column(i).to_numpy() for i in (2, 3, 4))
                near, upper, lower, n = reassigned(v, was, upper, lower, centroids, step)
            scanned += n
            np.maximum.at(radius, near, upper)
            for c in range(k):
                gone, come = v[(was == c) & (near != c)], v[(near == c) & (was != c)]
                delta[c, 0] += len(come) - len(gone)
                delta[c, 1:] += come.astype(np.int64).sum(axis=0) - gone.astype(np.int64).sum(axis=0)
            n = len(v)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(upper),
                    pa.array(lower), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64()),
                    pa.array(["vector"] * n),
                ],
                names,
            )
        if id_type is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(k, id_type), pa.nulls(k, pa.binary()), pa.array(np.arange(k, dtype=np.int32)),
                    pa.array(radius), pa.array(np.zeros(k)), pa.array(delta.tolist(), pa.list_(pa.int64())),
                    pa.array([scanned] + [0] * (k - 1)), pa.array(["change"] * k),
                ],
                names,
            )

    rows.mapInArrow(run, schema).write.partitionBy("part").parquet(path)


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> Clustering:
    """``rounds`` rounds of assigning and averaging, then one more assignment.

    The first centroids are the vectors with the smallest SHA-256 of ``seed:vec_id``. Rounds that
    follow one in which no centroid moved would change nothing and are left out.
    """
    spark = vectors.sparkSession
    whole = settled(whole_vectors(vectors, dimensions, scale), "cluster-vectors")
    spread = F.sha2(F.concat(F.lit(f"{seed}:"), id_text("vec_id")), 256)
    chosen = whole.orderBy(F.col("vec_id").isNull(), spread, "vec_id", "v").limit(clusters).collect()
    if not chosen:
        return Clustering(whole.selectExpr("*", "0 AS cluster", "0D AS upper", "0D AS lower"), np.zeros((0, dimensions), np.int64), [])
    centroids = unpacked(pa.array([bytes(r.v) for r in chosen], pa.binary()), dimensions).astype(np.int64)
    k = len(centroids)
    totals = [[0] * (dimensions + 1) for _ in range(k)]
    rows, path, step, scanned = whole, None, None, []
    sums = [F.sum(F.col("delta")[i].cast("decimal(38,0)")).alias(f"d{i}") for i in range(dimensions + 1)]
    for done in range(rounds + 1):
        before, path = path, scratch_dir(spark, f"cluster-pass-{done}")
        _pass(rows, centroids, step, path)
        written = spark.read.schema(_schema(whole)).parquet(path)
        rows = written.filter("part = 'vector'").select("vec_id", "v", "cluster", "upper", "lower")
        # One row per cluster.
        changes = written.filter("part = 'change'").groupBy("cluster").agg(
            F.max("upper").alias("radius"), F.sum("scanned").alias("scanned"), *sums
        )
        radius = np.zeros(k)
        scanned.append(0)
        for r in changes.collect():
            radius[r.cluster] = r.radius
            scanned[-1] += r.scanned
            totals[r.cluster] = [a + int(r[f"d{i}"]) for i, a in enumerate(totals[r.cluster])]
        if before:
            paths.delete(spark, before)
        if done == rounds:
            break
        moved = centroids.copy()
        for c, (n, *total) in enumerate(totals):
            if n:
                moved[c] = [x // n for x in total]
        if (moved == centroids).all():
            break
        drift = np.linalg.norm((moved - centroids).astype(np.float64), axis=1) * (1 + SLACK)
        step, centroids = Step(drift, loosening(centroids, moved, radius)), moved
    return Clustering(rows, centroids, scanned)


def distances(found: Clustering) -> DataFrame:
    """(vec_id, cluster, distance): the exact squared distance to the final centroid."""
    centroids = found.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = unpacked(batch.column(1), centroids.shape[1])
                near = batch.column(2).to_numpy()
                gap = v.astype(np.int64) - centroids[near]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array((gap * gap).sum(axis=1))],
                    ["vec_id", "cluster", "distance"],
                )

    vec_id = found.vectors.schema["vec_id"].dataType.simpleString()
    chosen = found.vectors.select("vec_id", "v", "cluster")
    return chosen.mapInArrow(run, f"vec_id {vec_id}, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with their cluster, distance and the clusters' inertia."""
    found = cluster_vectors(table(spark, sf_dir, "embeddings"))
    measured = settled(distances(found), "cluster-distances")
    digests = spark.createDataFrame(
        [(c, digest(x)) for c, x in enumerate(found.centroids)], "cluster int, centroid_sha256 string"
    )
    # One row per cluster, which bounds both broadcasts.
    inertia = measured.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = measured.agg(F.sum("distance").alias("inertia"))
    by_cluster = inertia.join(F.broadcast(digests), "cluster").join(F.broadcast(total))
    return measured.join(F.broadcast(by_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
