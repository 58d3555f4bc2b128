"""Centroid clustering of integer vectors by scalar lookup tables.

A component x becomes floor(scale * x). In each round a task looks at a batch of
vectors: per dimension it finds the integer values that occur, and tabulates the
squared difference of every value and every centroid; the distances of the batch
are then gathers from these tables, added over the dimensions. A task sends one
row per centroid on, with the count and the sums of its vectors. So a round moves
(tasks x centroids) rows, and the driver holds the centroids only. All sums are
of whole numbers: neither the order of the rows nor their partitions change a
result.

The first centroids are the vectors with the smallest SHA-256 of `<seed>:<id>`.
An assignment takes the nearest centroid, of equally near ones the one with the
smallest number. A round moves every centroid that has vectors to the floor of
their mean; others stay.

Defined results: a vector that is null, has another number of components, or a
component that is null, NaN or infinite is left out. Components beyond
+-LARGEST after scaling count as that, so that squared distances fit in 63 bits.
A null id is hashed as the empty string. Rows that repeat an id are vectors of
their own; where the hash is the same, the smaller vector goes first. With fewer
vectors than centroids, all of them are centroids. A sum of distances that does
not fit in a long is null. An empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.operators.skew import spread
from skeinwork.session import materialize

LARGEST = 1 << 27
ROWS = 4096         # vectors whose distances are held at once
DENSE = 4           # a range of values up to so many times the rows is counted, a wider one is sorted


def whole_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 64, scale: int = 64) -> DataFrame:
    """(`id`, `q`): the vectors that take part, with whole components."""
    x = F.col("v")
    whole = lambda e: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(e.cast("double") * scale))).cast("int")
    finite = lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("v")).where(F.size(x) == components).where(F.forall(x, finite))
    return rows.select("id", F.transform(x, whole).alias("q"))


def first_centroids(vectors: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """Components of the first centroids, a row each; the driver gets k rows."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(order.alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in rows], np.int64)


def _occurring(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur, ascending, and the place of each element among them."""
    low, high = int(values.min()), int(values.max())
    if high - low < DENSE * len(values) + 256:
        there = np.zeros(high - low + 1, bool)
        there[values - low] = True
        return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[values - low]
    return np.unique(values, return_inverse=True)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, and the squared distance, of each row of whole numbers."""
    distances = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        values, places = _occurring(vectors[:, d])
        table = (values[:, None] - centroids[None, :, d]) ** 2
        distances += table[places]
    best = distances.argmin(axis=1)     # the first of equal ones
    return best, distances[np.arange(len(vectors)), best]


def _blocks(column: pa.Array) -> Iterator[np.ndarray]:
    width = len(column[0])
    for at in range(0, len(column), ROWS):
        part = column.slice(at, ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(part), width)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per task and centroid with vectors: `cluster`, `n`, `sums`."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for block in _blocks(batch.column(0)):
                cluster, _ = nearest(block, centroids)
                order = np.argsort(cluster, kind="stable")
                present, begin = np.unique(cluster[order], return_index=True)
                sums[present] += np.add.reduceat(block[order], begin, axis=0)
                counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    return vectors.select("q").mapInArrow(run, "cluster int, n long, sums array<bigint>")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, width = centroids.shape
    total = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)]
    rows = _sums(vectors, centroids).groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"]] = [r[f"s{d}"] // r["n"] for d in range(width)]
    return out


def fit_centroids(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> np.ndarray:
    """Centroids after some rounds over all vectors of `whole_vectors`; read `rounds` + 1 times, so pass a written table."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per vector: `id`, `cluster`, `distance` (squared)."""
    kind = vectors.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [nearest(block, centroids) for block in _blocks(batch.column(1))]
            cluster, distance = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
            )

    return vectors.select("id", "q").mapInArrow(run, f"id {kind.simpleString()}, cluster int, distance long")


def centroid_sha256(centroid: np.ndarray) -> str:
    """Lowercase hex of the components as decimal numbers, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 64, scale: int = 64,
    k: int = 16, rounds: int = 3, seed: int = 1,
) -> DataFrame:
    """Per vector that takes part: id, `cluster`, `distance`, `cluster_inertia`, `inertia`, `centroid_sha256`."""
    spark = df.sparkSession
    # rounds are heavy per row: a file of few splits is dealt out, a large table stays where it is
    vectors = materialize(spread(whole_vectors(df, id, vector, components, scale)), "vectors")
    centroids = fit_centroids(vectors, k, rounds, seed)
    placed = materialize(assign(vectors, centroids), "assigned")
    # one row per centroid
    inertia = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    fits = lambda total: total if total < 1 << 63 else None
    schema = T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType()),
    ])
    total = sum(inertia.values())
    rows = [(c, fits(own), fits(total), centroid_sha256(centroids[c])) for c, own in sorted(inertia.items())]
    return placed.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
