from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tessera.llm.centroid_clusters import cluster_vectors

SCHEMA = "vec_id long, embedding array<float>, v string, cluster int, id long"


def brute(rows, dims, k, rounds, scale=1024, seed=3):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and None not in v and np.isfinite(v).all()]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in start[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    near = assign()
    total = [sum(d for d, c in near if c == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, total[c], sum(total), digest[c]) for (i, _), (d, c) in zip(kept, near, strict=True))


def found(spark, rows, dims, k, rounds):
    table = spark.createDataFrame([(i, v, "x", 9, 9) for i, v in rows], SCHEMA)
    result = cluster_vectors(table, dims=dims, k=k, rounds=rounds)
    assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in result.collect())


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(6) + 3 * (i % 4)]) for i in range(200)]
    assert found(spark, rows, 6, 5, 4) == brute(rows, 6, 5, 4)
    assert found(spark, rows, 6, 5, 0) == brute(rows, 6, 5, 0)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, -2.5]), (1, [1.0, -2.5]), (1, [0.0, 0.5]), (2, None), (3, []), (4, [1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [-inf, 1.0]),
            (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (None, [-0.0001, 0.0001]), (10, [0.0, 0.0])]
    assert found(spark, rows, 2, 3, 3) == brute(rows, 2, 3, 3)
    assert found(spark, rows, 2, 50, 3) == brute(rows, 2, 50, 3)
    assert found(spark, [], 2, 3, 3) == []
    assert found(spark, [(1, None)], 2, 3, 3) == []


def test_ties_and_empty_clusters(spark):
    """Many copies of one vector, so that several centroids start equal and all but the first stay empty."""
    rows = [(i, [1.0, 1.0]) for i in range(40)] + [(50, [-1.0, 0.3]), (51, [3.0, 1.0])]
    assert found(spark, rows, 2, 8, 10) == brute(rows, 2, 8, 10)


def test_large_components(spark):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(np.random.default_rng(1).uniform(-2e4, 2e4, (30, 64)))]
    assert found(spark, rows, 64, 3, 2) == brute(rows, 64, 3, 2)
    with pytest.raises(ValueError, match="overflow"):
        found(spark, [(1, [3e38, -3e38])], 2, 1, 1)


def test_no_python_and_no_wide_rows(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    table = spark.createDataFrame([(i, v, "x", 9, 9) for i, v in rows], SCHEMA)
    plan = cluster_vectors(table, dims=2, k=2, rounds=1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
