"""Clustering around centroids with integer distances, in built-in expressions only.

A vector is kept when it has the asked number of components and none is null, not finite, or beyond `LARGEST`
(past that a squared distance may not fit in a long). Components become whole numbers, floor(scale * x), so distances
and means are exact and no order of summation changes a result.

* Centroids are literal arrays in the query. `zip_with` and `aggregate` give the squared distance to each, `array_min`
  of (distance, number) structs picks the nearest and, among equals, the smaller number.
* New centroids are sums of columns, combined in every task before the shuffle: one row per cluster and task moves, and
  at most `clusters` rows of sums come to the driver, whatever the number of vectors. Floors are taken there on whole
  numbers. A hot cluster is therefore one row per task too.
* The first centroids are the kept vectors with the smallest SHA-256 of `<seed>:<key>`; equal hashes (repeated keys) go by
  vector, null keys come last.

Fewer vectors than clusters give as many clusters as vectors; an empty table gives an empty result. Repeated rows count and
are reported one by one. A sum of distances that passes 64 bits is null.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import column, stored

WIDTH = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
LARGEST = 2.0**27  # of a scaled component: 64 squares of twice this stay below 2^63


def points(vectors: DataFrame, key: str, vector: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """`id` and `point` (whole numbers) of the vectors that are kept."""

    def usable(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return x.isNotNull() & ~F.isnan(scaled) & (F.abs(scaled) <= LARGEST)

    whole = F.transform(column(vector), lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter((F.size(column(vector)) == width) & F.forall(column(vector), usable)).select(
        column(key).alias("id"), whole.alias("point")
    )


def _literal(numbers: list[int]) -> Column:
    """An array of whole numbers as one constant."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def nearest(centroids: list[list[int]]) -> Column:
    """Struct of `distance` and `cluster` for the centroid nearest to `point`."""

    def squared(centroid: Column) -> Column:
        parts = F.zip_with("point", centroid, lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, x: total + x)

    each = F.transform(
        F.array(*[_literal(c) for c in centroids]),
        lambda centroid, number: F.struct(squared(centroid).alias("distance"), number.cast("int").alias("cluster")),
    )
    return F.array_min(each)


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.orderBy(drawn.asc_nulls_last(), "point").select("point").limit(clusters).collect()
    return [list(row.point) for row in rows]


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the mean of each cluster; a centroid without vectors stays."""
    width = len(centroids[0])
    sums = (
        kept.select(nearest(centroids).getField("cluster").alias("cluster"), "point")
        .groupBy("cluster")
        .agg(F.count("*").alias("size"), *[F.sum(F.col("point")[i]).alias(f"s{i}") for i in range(width)])
        .collect()
    )
    after = list(centroids)
    for row in sums:
        after[row.cluster] = [row[f"s{i}"] // row.size for i in range(width)]
    return after


def fit(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """Stored `id`, `cluster`, `distance` of every kept vector, and the final centroids."""
    kept = stored(points(vectors, key, vector, width, scale), "points")
    centroids = first_centroids(kept, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids)
    best = nearest(centroids or [[0] * width])  # without vectors there is nothing to assign
    assigned = kept.select("id", best.alias("best")).select("id", "best.cluster", "best.distance")
    return stored(assigned, "assigned"), centroids


def report(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: its cluster, squared distance, inertias and a hash of its centroid."""
    assigned, centroids = fit(vectors.select("vec_id", "embedding"))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    within = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def fitting(total: int) -> Column:
        return F.lit(total if total < 1 << 63 else None).cast("bigint")

    of_cluster = F.array(*[fitting(within.get(k, 0)) for k in range(max(1, len(centroids)))])
    return assigned.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        F.get(of_cluster, F.col("cluster")).alias("cluster_inertia"),
        fitting(sum(within.values())).alias("inertia"),
        F.get(F.array(*[F.lit(d) for d in digests or [""]]), F.col("cluster")).alias("centroid_sha256"),
    )
