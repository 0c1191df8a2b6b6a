import hashlib
import math

import pytest

from aerolith.llm import centroids, registry
from tests.conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, clusters=16, rounds=3, width=64):
    """The contract, one vector at a time."""
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == width and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(64 * x) for x in vector]))
    order = sorted(kept, key=lambda kv: (kv[0] is None, hashlib.sha256(f"1:{kv[0]}".encode()).hexdigest(), kv[1]))
    middle = [v for _, v in order[:clusters]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        of = [assign(v)[1] for _, v in kept]
        for k in range(len(middle)):
            mine = [v for (_, v), c in zip(kept, of, strict=True) if c == k]
            if mine:
                middle[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    best = [assign(v) for _, v in kept]
    inertia = [sum(d for d, c in best if c == k) for k in range(len(middle))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(
        [(key, c, d, inertia[c], sum(inertia), digest[c]) for (key, _), (d, c) in zip(kept, best, strict=True)],
        key=repr,
    )


def test_whole_table_equals_a_plain_version(spark, sf_dir):
    table = registry.table(spark, sf_dir, "embeddings")
    wanted = plain([(r.vec_id, r.embedding) for r in table.collect()])
    assert len(wanted) > 100 and rows_of(registry.op13_centroid_clustering(spark, sf_dir)) == wanted


def test_odd_vectors_ties_and_repeats(spark):
    same, other = [0.5] * 64, [-0.26] * 64
    rows = [(i, same, 0) for i in range(6)] + [(6, other, 1), (6, other, 1), (None, other, 2), (7, None, None)]
    rows += [(8, [], 0), (9, [0.1] * 63, 0), (10, [0.1] * 65, 0), (11, [None] + [0.1] * 63, 0)]
    rows += [(12, [math.nan] + [0.1] * 63, 0), (13, [math.inf] + [0.1] * 63, 0), (14, [-math.inf] * 64, 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = centroids.report(table.withColumnsRenamed({"label": "point"}))  # a clashing name beside it
    assert rows_of(got) == plain([r[:2] for r in rows]) and got.count() == 9
    assert {r.cluster for r in got.collect()} == {0, min(r.cluster for r in got.collect() if r.vec_id in (6, None))}


def test_too_large_components_are_left_out(spark):
    rows = [(1, [1e30] * 64, 0), (2, [2.0**21] * 64, 0), (3, [-(2.0**21)] * 64, 0)]
    got = centroids.report(spark.createDataFrame(rows, SCHEMA))
    assert {r.vec_id for r in got.collect()} == {2, 3}


def test_empty_table(spark):
    got = centroids.report(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns[:3] == ["vec_id", "cluster", "distance"]


@pytest.mark.parametrize("clusters,rounds,width", [(2, 0, 3), (5, 7, 3), (1, 1, 3)])
def test_other_numbers_of_clusters_rounds_and_components(spark, clusters, rounds, width):
    rows = [(i, [float(i % 5), float(i * i % 7) / 3, -float(i)]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assigned, middle = centroids.fit(table, clusters=clusters, rounds=rounds, width=width)
    wanted = [r[:3] for r in plain(rows, clusters, rounds, width)]
    assert rows_of(assigned, "id", "cluster", "distance") == wanted and len(middle) == clusters


def test_distances_run_on_built_in_expressions(spark, sf_dir):
    kept = centroids.points(registry.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    plan = kept.select(centroids.nearest([[0] * 64, [1] * 64]))._jdf.queryExecution().toString()
    assert "zip_with" in plan or "zipwith" in plan.lower()
    assert "Python" not in plan and "Arrow" not in plan
