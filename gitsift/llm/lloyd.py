"""Centroid clustering: Lloyd's rounds with the dimensions dealt to shards, in exact integers.

Vectors are cut into blocks of rows, and every block by dimension into shards. A record is
the matrix of one block in one shard, so that a task sees a few columns and the slice of
the centroids that belongs to them. A round is three steps:

1. every (block, shard) computes the squared distances of its columns to the centroids'
   slices; ``reduceByKey`` by block adds the shards' parts, and the least sum names the
   nearest centroid (the smaller number on a tie);
2. the numbers go back to the block's shards, which hold the columns; those never move
   after they have been dealt once;
3. every shard adds its own columns by cluster, and floors the means of its own slice.

Only slices, k times the number of dimensions, reach the driver, and go to all tasks in
the next round. Everything else is keyed by block, whose size is bounded, so equal vectors
or one large cluster do not gather anywhere. The rounds read one written table; nothing but
the small slices is carried from round to round, so a lost executor costs its own tasks.

* Kept are rows with an id and a vector of exactly the asked length without null or
  non-finite components; others are in no cluster and not in the result.
* Repeated rows are rows like others. Rows of the same id tie by their components when the
  first centroids are chosen. Fewer rows than clusters give fewer centroids; an empty
  table gives no rows.
* A centroid without vectors stays as it is. Further columns, whatever their names, are
  not looked at.
* A component whose scaled value is so large that squared distances could leave 64 bits
  is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitsift.session import materialise

#: Dimensions of a shard and vectors of a block.
SHARD_DIMENSIONS = 16
BLOCK_ROWS = 4096


def _scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as longs."""
    out = np.floor(scale * vectors.astype(np.float64))
    limit = np.sqrt(2.0 ** 62 / max(1, out.shape[-1])) / 2
    if np.abs(out).max(initial=0) >= limit:
        raise ValueError("squared distances of such components would not fit 64 bits")
    return out.astype(np.int64)


def _kept(df: DataFrame, row_id: Column, vector: Column, dimensions: int) -> DataFrame:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(row_id.cast("long").alias("id"), vector.alias("vector"))
            .filter(F.col("id").isNotNull() & (F.size("vector") == dimensions)).filter(finite))


def blocks(rows: DataFrame, dimensions: int, scale: int, shard_dimensions: int = SHARD_DIMENSIONS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """block, data, shard: longs of a block's columns, row after row; shard -1 holds the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                matrix = _scaled(values.reshape(part.num_rows, dimensions), scale)
                data = {-1: part.column("id").to_numpy().astype(np.int64)}
                for shard, first in enumerate(range(0, dimensions, shard_dimensions)):
                    data[shard] = matrix[:, first:first + shard_dimensions]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([number] * len(data), pa.int64()),
                    "data": [x.tobytes() for x in data.values()],
                    "shard": pa.array(list(data), pa.int32())})
                number += 1

    return materialise(rows.mapInArrow(run, "block long, data binary, shard int"), "blocks", ["shard"])


def partial_distances(columns: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids over some of the dimensions."""
    out = np.empty((len(columns), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids):
        apart = columns - centroid
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def _nearest(held: RDD, slices: list[np.ndarray], parts: int) -> RDD:
    """(block, (numbers of the nearest centroids, squared distances))."""
    shipped = held.context.broadcast(slices)

    def part(record):
        (block, shard), columns = record
        return block, partial_distances(columns, shipped.value[shard])

    def least(sums):
        numbers = sums.argmin(axis=1)
        return numbers.astype(np.int32), sums[np.arange(len(sums)), numbers]

    return held.map(part).reduceByKey(np.add, parts).mapValues(least)


def _updated(held: RDD, nearest: RDD, slices: list[np.ndarray], parts: int) -> list[np.ndarray]:
    """Every shard's slice after its columns have been averaged by cluster, floored."""
    k, shards = len(slices[0]), len(slices)
    numbers = nearest.flatMap(lambda x: [((x[0], shard), x[1][0]) for shard in range(shards)])

    def sums(records):
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for (_, shard), (columns, cluster) in records:
            total = np.zeros((k, columns.shape[1]), np.int64)
            np.add.at(total, cluster, columns)
            before = found.get(shard, (0, 0))
            found[shard] = before[0] + total, before[1] + np.bincount(cluster, minlength=k)
        return found.items()

    totals = held.join(numbers, parts).mapPartitions(sums).reduceByKey(
        lambda x, y: (x[0] + y[0], x[1] + y[1]), shards)

    def means(record):
        shard, (total, count) = record
        return shard, total // np.maximum(count, 1)[:, None], count

    new = list(slices)
    for shard, mean, count in totals.map(means).collect():  # k rows of a few columns per shard
        new[shard] = np.where(count[:, None] > 0, mean, slices[shard])
    return new


def first_centroids(rows: DataFrame, clusters: int, seed: str, scale: int) -> np.ndarray:
    """Vectors with the smallest sha256 of ``seed:id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.withColumn("key", key).orderBy("key", "vector").limit(clusters).collect()
    return _scaled(np.array([row.vector for row in chosen], np.float64), scale)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(df: DataFrame, row_id: Column, vector: Column, *, clusters: int = 16, rounds: int = 3,
            dimensions: int = 64, scale: int = 64, seed: str = "1",
            shard_dimensions: int = SHARD_DIMENSIONS, block_rows: int = BLOCK_ROWS,
            ) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance of every kept row; the final centroids).

    ``rounds`` times all rows go to their nearest centroid and every centroid to the floored
    mean of its rows; then the rows are assigned once more. Distances are squared.
    """
    spark = df.sparkSession
    rows = _kept(df, row_id, vector, dimensions)
    centroids = first_centroids(rows, clusters, seed, scale)
    if not len(centroids):
        empty = spark.createDataFrame([], "id long, cluster int, distance long")
        return empty, np.zeros((0, dimensions), np.int64)
    table = blocks(rows, dimensions, scale, shard_dimensions, block_rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = list(range(0, dimensions, shard_dimensions))
    slices = [centroids[:, first:first + shard_dimensions] for first in edges]
    widths = [x.shape[1] for x in slices]

    def columns(row):
        return (row.block, row.shard), np.frombuffer(row.data, np.int64).reshape(-1, widths[row.shard])

    held = table.filter("shard >= 0").rdd.map(columns).partitionBy(parts)
    for _ in range(rounds):
        slices = _updated(held, _nearest(held, slices, parts), slices, parts)
    ids = table.filter("shard < 0").rdd.map(lambda row: (row.block, np.frombuffer(row.data, np.int64)))
    final = ids.join(_nearest(held, slices, parts), parts).map(
        lambda x: (x[1][0].tolist(), x[1][1][0].tolist(), x[1][1][1].tolist()))
    packed = spark.createDataFrame(final, "id array<long>, cluster array<int>, distance array<long>")
    found = materialise(packed.select(F.inline(F.arrays_zip("id", "cluster", "distance"))), "clusters")
    return found, np.concatenate(slices, axis=1)


def with_digests(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with their cluster's and the total inertia, and a digest of their centroid."""
    totals = {row.cluster: row.total for row in
              found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # one row a cluster
    if not totals:
        return found.select("*", *(F.lit(None).cast("long").alias(x) for x in ("cluster_inertia", "inertia")),
                            F.lit(None).cast("string").alias("centroid_sha256"))
    inertia = F.array(*[F.lit(totals.get(j, 0)).cast("long") for j in range(len(centroids))])
    digests = F.array(*[F.lit(centroid_digest(c)) for c in centroids])
    return found.select("*", inertia[F.col("cluster")].alias("cluster_inertia"),
                        F.lit(sum(totals.values())).cast("long").alias("inertia"),
                        digests[F.col("cluster")].alias("centroid_sha256"))
