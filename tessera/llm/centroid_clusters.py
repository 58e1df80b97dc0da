"""Centroid clustering of integer vectors, all in Spark's own expressions.

Components become ``floor(scale * x)``. In every round one expression gives each vector
its nearest centroid: ``zip_with`` and ``aggregate`` compute the squared distance to
each centroid, a literal array in the plan, and ``array_min`` of ``(distance, number)``
chooses the cluster, the smaller number on a tie. One hash aggregate then sums every
component by cluster; partial sums are made before the shuffle, so a cluster that holds
most rows sends one row per task. What reaches the driver is one row per cluster,
whatever the table's size; the new centroids are its exact floor divisions.

The integer vectors are written once in the shared folder, as are the final assignments,
so a lost executor costs tasks of one round.

Defined results: a vector takes part if it has exactly ``dims`` components, none null or
non-finite; null vectors and others are in no row of the result. Repeated rows (and ids)
count and are returned as often as they occur. Start centroids are taken in the order of
the ids' hashes, rows of one id in the order of their vectors, rows without an id last;
with fewer vectors than centroids, each vector starts one. An empty table gives no rows.
Columns beside the two named are not read, so their names cannot clash. Integer
components so large that a squared distance may not fit a long (2^27.5 for 64 of them)
are refused with an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

RESULT = "{id} {type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, v``: the vectors that take part, each component ``floor(scale * x)`` as a long."""
    x = F.col(vector_col)
    # NaN is greater than infinity to Spark
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.coalesce((F.size(x) == dims) & finite, F.lit(False)))
            .select(F.col(id_col).alias("id"), F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double"))).alias("v")))


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """``(distance, cluster)`` of the nearest centroid: squared distance, ties to the smaller number."""
    def distance(centroid: list[int]) -> Column:
        literal = F.array(*[F.lit(x).cast("long") for x in centroid])
        apart = F.zip_with(v, literal, lambda a, b: a - b)
        return F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: total + d * d)

    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def start_centroids(table: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the k smallest hashes of ``seed:id``."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r["v"]) for r in table.orderBy(by_hash.asc_nulls_last(), "v").limit(k).select("v").collect()]


def moved(assigned: DataFrame, centroids: list[list[int]], exact: str) -> list[list[int]]:
    """Centroids of the next round: componentwise floor of the mean; one without vectors stays."""
    dims = len(centroids[0])
    sums = (assigned.groupBy("near.cluster")
            .agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i].cast(exact)).alias(f"s{i}") for i in range(dims)]))
    found = {r["cluster"]: [int(r[f"s{i}"]) // r["n"] for i in range(dims)] for r in sums.collect()}
    return [found.get(i, c) for i, c in enumerate(centroids)]


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
                    k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> DataFrame:
    """One row per vector that takes part: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    table = materialize(integer_vectors(vectors, id_col, vector_col, dims, scale), "vectors")
    size = F.greatest(*[F.abs(f("v").cast("decimal(20,0)")) for f in (F.array_max, F.array_min)])
    largest, n = table.agg(F.max(size), F.count("*")).first()
    if not n:
        return spark.createDataFrame([], RESULT.format(id=f"`{id_col}`", type=vectors.schema[id_col].dataType.simpleString()))
    if dims * (2 * int(largest)) ** 2 >= 1 << 63:
        raise ValueError(f"components of up to {largest} overflow the squared distance of {dims} components")
    exact = "long" if int(largest) * n < 1 << 62 else "decimal(38,0)"

    centroids = start_centroids(table, k, seed)
    for _ in range(rounds):
        centroids = moved(table.withColumn("near", nearest(F.col("v"), centroids)), centroids, exact)

    final = materialize(table.select("id", nearest(F.col("v"), centroids).alias("near")).select("id", "near.*"), "assigned")
    by_cluster = {r["cluster"]: int(r["s"]) for r in
                  final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of_cluster = F.array(*[F.struct(F.lit(by_cluster.get(i, 0)).cast("long").alias("inertia"), F.lit(d).alias("sha256"))
                           for i, d in enumerate(digests)])[F.col("cluster")]
    return final.select(F.col("id").alias(id_col), "cluster", "distance", of_cluster["inertia"].alias("cluster_inertia"),
                        F.lit(sum(by_cluster.values())).cast("long").alias("inertia"), of_cluster["sha256"].alias("centroid_sha256"))
