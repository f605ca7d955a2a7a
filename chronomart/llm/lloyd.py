"""Exact k-means over integer vectors, sharded by dimension.

Vectors are cut into blocks of rows and, across, into shards of ``SHARD_DIMS`` components.  In a round
each (block, shard) task computes exact partial squared distances to its slice of every centroid; the
partial matrices of a block are added under the block's key, and the smallest sum names the cluster.  The
labels go back to the shards of their block, where each shard adds up its own components by cluster and
updates its own slice of the centroids.

The slices of the vectors are written once, bucketed by block and shard, and stay where they are: a round
exchanges the partial distances and the labels.  Only centroids (clusters times dimensions) reach the
driver.  All sums are integers, so results do not depend on order or layout.

Vectors that are null, of another length or hold a null or non-finite component take no part.  A null id
counts as an empty one.  Equal vectors and repeated ids are rows of their own; with equal ids the smaller
vector comes first in the choice of centroids.  With fewer vectors than clusters each one is a centroid;
an empty table has an empty result.  Components so large that a distance could pass 2**63 are an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import bucketed, stored
from chronomart.sources.storage import MAX_BUCKETS

DIMS, CLUSTERS, ROUNDS = 64, 40, 5
SCALE = 256
SHARD_DIMS = 32
BLOCK_ROWS = 4096
#: Blocks that one bucket of the stored slices should hold.
BUCKET_BLOCKS = 64


def integers(vector: Column) -> Column:
    """Components as floor(256 x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def complete(vector: Column, dims: int) -> Column:
    """Whether a vector has all its components, none null or non-finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def bounded(vector: Column, dims: int) -> Column:
    """The vector, or an error where distances of such components could pass a long (or a component 31 bits)."""
    most = min(2**31 - 1, math.isqrt((2**63 - 1) // dims) // 2)
    fits = F.forall(vector, lambda x: F.abs(x) <= most)
    return F.when(fits, vector).otherwise(F.raise_error(F.lit(f"a component is above {most} in size")))


@dataclass(frozen=True)
class Slices:
    """Stored parts of the vectors: one row for each block and shard; the ids are with shard 0."""

    table: DataFrame
    dims: int

    @property
    def shards(self) -> int:
        return math.ceil(self.dims / SHARD_DIMS)


def slices(vectors: DataFrame, dims: int) -> Slices:
    """Cut ``vectors`` (id, x) into blocks and shards and write them."""
    shards, rows_of = math.ceil(dims / SHARD_DIMS), BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, rows_of):
                part = batch.slice(start, rows_of)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                for shard in range(shards):
                    own = x[:, shard * SHARD_DIMS : (shard + 1) * SHARD_DIMS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block], pa.int64()),
                            pa.array([shard], pa.int32()),
                            ids if shard == 0 else pa.nulls(1, ids.type),
                            pa.array([own.ravel()], pa.list_(pa.int32())),
                        ],
                        names=["block", "shard", "ids", "x"],
                    )
                block += 1

    id_type = vectors.schema[0].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("x", T.ArrayType(T.IntegerType())),
        ]
    )
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    rows = vectors.count()
    buckets = min(MAX_BUCKETS, max(cores, math.ceil(rows / (BLOCK_ROWS * BUCKET_BLOCKS))))
    return Slices(bucketed(vectors.mapInArrow(run, schema), buckets, "block", "shard"), dims)


# A round -------------------------------------------------------------------------------------------


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``x @ c.T`` in exact integers; by floating point where every partial sum is below 2**53."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(c).max(initial=0)) * x.shape[1]
    if most < 2**53:
        return np.rint(x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return x @ c.T


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` to rows of ``c`` over a shard's dimensions."""
    return (x * x).sum(axis=1)[:, None] - 2 * products(x, c) + (c * c).sum(axis=1)[None]


def _shard(centroids: np.ndarray, shard: int) -> np.ndarray:
    return centroids[:, shard * SHARD_DIMS : (shard + 1) * SHARD_DIMS]


def assign(parts: Slices, centroids: np.ndarray) -> DataFrame:
    """Labels and distances of every block: (block, labels, distances)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, shard, x in zip(*(batch.column(i) for i in range(3)), strict=True):
                c = _shard(centroids, shard.as_py())
                flat = x.values.to_numpy().astype(np.int64)
                found = partial_distances(flat.reshape(-1, c.shape[1]), c).ravel()
                ends = pa.array([0, len(found)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(found))],
                    names=["block", "partial"],
                )

    def add(table: pa.Table) -> pa.Table:
        total = sum(row.values.to_numpy() for row in table.column("partial"))
        distances = total.reshape(-1, len(centroids))
        labels = distances.argmin(axis=1)  # of equal ones the first
        least = distances[np.arange(len(labels)), labels]
        return pa.table(
            {
                "block": table.column("block").slice(0, 1),
                "labels": pa.array([labels.astype(np.int32)], pa.list_(pa.int32())),
                "distances": pa.array([least], pa.list_(pa.int64())),
            }
        )

    partial = parts.table.select("block", "shard", "x").mapInArrow(measure, "block long, partial array<long>")
    return partial.groupBy("block").applyInArrow(add, "block long, labels array<int>, distances array<long>")


def update(parts: Slices, labels: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """New centroids: each shard adds its components by cluster and divides its own slice."""
    k = len(centroids)

    def add_up(table: pa.Table, found: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        label = found.column("labels")[0].values.to_numpy()
        x = table.column("x")[0].values.to_numpy().astype(np.int64).reshape(len(label), -1)
        order = np.argsort(label, kind="stable")
        clusters, first = np.unique(label[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        counts = np.diff(np.r_[first, len(label)])
        return pa.table(
            {
                "shard": pa.array([shard] * len(clusters), pa.int32()),
                "cluster": pa.array(clusters, pa.int32()),
                "n": pa.array(counts, pa.int64()),
                "sums": pa.array(list(sums), pa.list_(pa.int64())),
            }
        )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of a task's blocks as one row for each shard and cluster."""
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for shard, cluster, n, sums in zip(*batch.columns, strict=True):
                own = held.setdefault((shard.as_py(), cluster.as_py()), [0, 0])
                own[0] += n.as_py()
                own[1] = own[1] + sums.values.to_numpy()
        if held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in held], pa.int32()),
                    pa.array([c for _, c in held], pa.int32()),
                    pa.array([n for n, _ in held.values()], pa.int64()),
                    pa.array([v for _, v in held.values()], pa.list_(pa.int64())),
                ],
                names=["shard", "cluster", "n", "sums"],
            )

    of_shards = labels.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts.shards - 1))).alias("shard"), "labels")
    vectors = parts.table.select("block", "shard", "x").groupBy("block", "shard")
    schema = "shard int, cluster int, n long, sums array<long>"
    sums = vectors.cogroup(of_shards.groupBy("block", "shard")).applyInArrow(add_up, schema).mapInArrow(together, schema)
    whole = F.sum(F.col("value").cast("decimal(38,0)"))
    new = (
        sums.select("shard", "cluster", "n", F.posexplode("sums").alias("dim", "value"))
        .groupBy("shard", "cluster", "dim")
        .agg(whole.alias("total"), F.sum(F.col("n").cast("decimal(38,0)")).alias("rows"))
        .select("shard", "cluster", "dim", F.expr("(total - pmod(total, rows)) div rows").alias("value"))
    )
    result = centroids.copy()
    for row in new.collect():  # clusters times dimensions, whatever the data
        result[row["cluster"], row["shard"] * SHARD_DIMS + row["dim"]] = row["value"]
    assert len(result) == k
    return result


# The operator --------------------------------------------------------------------------------------


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The vectors whose ids have the smallest SHA-256 of ``2:<id>``, in that order."""
    key = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r["x"] for r in vectors.orderBy(key, "x").limit(k).select("x").collect()], np.int64)


def cluster(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CLUSTERS, rounds: int = ROUNDS
) -> DataFrame:
    """Every complete vector with its cluster, squared distance and the sums of distances.

    Columns: ``id`` (its name and type kept), cluster, distance, cluster_inertia, inertia, centroid_sha256.
    """
    spark = df.sparkSession
    x = F.col(f"`{vector}`")
    own = df.filter(complete(x, dims)).select(F.col(f"`{id}`").alias("id"), bounded(integers(x), dims).alias("x"))
    centroids = first_centroids(own, k)
    if not len(centroids):
        nothing = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        kind = own.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{id}` {kind}, {nothing}")
    parts = slices(own, dims)
    for _ in range(rounds):
        centroids = update(parts, assign(parts, centroids), centroids)
    ids = parts.table.filter("shard = 0").select("block", "ids")
    rows = assign(parts, centroids).join(ids, "block").select(F.explode(F.arrays_zip("ids", "labels", "distances")).alias("row"))
    rows = stored(rows.select(F.col("row.ids").alias("id"), F.col("row.labels").alias("label"), F.col("row.distances").alias("distance")))
    sums = rows.groupBy("label").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = int(sum(r["total"] for r in sums))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    totals = spark.createDataFrame(
        [(r["label"], int(r["total"]), inertia, digests[r["label"]]) for r in sums],
        "label int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return rows.join(F.broadcast(totals), "label").select(  # one row for each cluster
        F.col("id").alias(id), F.col("label").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def sql(dims: int = DIMS, k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same in SQL, a round as two common table expressions."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INT) AS c, x
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT v.r, c.c, list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d
    FROM v CROSS JOIN c{i} c) GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.x, o.x) AS x FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT a.best.c AS c, g.i, sum(v.x[g.i]) AS s, count(*) AS n
      FROM a{i} a JOIN v USING (r) CROSS JOIN range(1, {dims + 1}) g(i) GROUP BY ALL) GROUP BY c) n USING (c))"""
            )
    return f"""WITH {", ".join(steps)},
rows AS (SELECT v.vec_id, a.best.c AS c, CAST(a.best.d AS BIGINT) AS d FROM a{rounds} a JOIN v USING (r))
SELECT vec_id, c AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM rows JOIN c{rounds} m USING (c)"""
