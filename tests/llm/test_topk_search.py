from __future__ import annotations

import numpy as np
import pytest

from tessera.llm import topk_search
from tessera.llm.topk_search import SortedLists, portions, qualifying, top_k

SCHEMA = "vec_id long, embedding array<float>, id long, v string, row long, score long, own int, floor int"


def brute(rows, every=50, k=5, scale=256):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    result = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = sorted(((-sum(x * y for x, y in zip(q, v, strict=True)), j is None, j or 0) for b, (j, v) in enumerate(kept) if b != a and len(v) == len(q)))
        result += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(scores[:k])]
    return sorted(map(str, result))


def found(spark, rows, **more):
    table = spark.createDataFrame([(i, v, 1, "x", 1, 1, 1, 1) for i, v in rows], SCHEMA)
    result = top_k(table, **more)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(str(tuple(r)) for r in result.collect())


def floats(a):
    return [float(np.float32(x)) for x in a]


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, floats(rng.standard_normal(16) * (1 + i % 3))) for i in range(600)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, every=7, k=3, at_once=640, seeds=8, growth=4) == brute(rows, 7, 3)


def test_portions_grow_and_cover_every_hash():
    assert portions(0, 4096, 16) == portions(65536, 4096, 16) == [(0, 1)]
    assert portions(65537, 4096, 16) == [(0, 1), (1, 16)]
    assert portions(10 ** 9, 4096, 16) == [(0, 1), (1, 16), (16, 256), (256, 4096), (4096, 65536)][:len(portions(10 ** 9, 4096, 16))]
    assert 10 ** 9 <= 4096 * 16 * portions(10 ** 9, 4096, 16)[-1][1]


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, -1.0]), (0, [1.0, -1.0]), (0, [1.0, -1.0]), (50, [0.5, 0.5]), (None, [2.0, -2.0]), (None, [2.0, -2.0]), (1, None), (100, None), (150, [nan, 1.0]),
            (2, [inf, 0.0]), (3, [None, 1.0]), (200, []), (4, []), (5, [1.0, 2.0, 3.0]), (250, [1.0, 1.0, 1.0]), (300, [1.0] * 5), (6, [0.0, 0.0]), (350, [0.0, 0.0]), (-50, [1.0, 1.0])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_ties_in_a_hot_vector(spark):
    """A third of the rows are one vector, which is also the best for many queries."""
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 1.0, 0.0] if i % 3 == 0 else floats(rng.uniform(-1, 1, 3))) for i in range(900, 0, -1)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [*rows, *rows[:50], (None, [1.0, 1.0, 0.0])], seeds=4, growth=8) == brute([*rows, *rows[:50], (None, [1.0, 1.0, 0.0])])


def test_numbers_of_all_sizes(spark):
    """Sums beyond the whole numbers of float32, and of float64."""
    rng = np.random.default_rng(7)
    for size in (1e3, 1e5, 1e6):
        rows = [(i, floats(rng.standard_normal(8) * size)) for i in range(120)]
        assert found(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="do not fit a long"):
        found(spark, [(0, [1e30]), (1, [1e30])])


@pytest.mark.parametrize("kind", [np.float32, np.int64])
def test_bounds_hold_and_lists_are_not_read_to_the_end(kind):
    rng = np.random.default_rng(8)
    vectors, queries = (np.floor(256 * rng.standard_normal((n, 12))).astype(kind) for n in (4000, 20))
    exact, lists = queries @ vectors.T, SortedLists(vectors)
    weights = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
    for depth in topk_search.DEPTHS:
        upper, lower = (weights @ known.T for known in lists.bounds(depth))
        assert (upper >= exact).all() and (lower <= exact).all()
    assert (upper == exact).all() and (lower == exact).all()
    lists = SortedLists(vectors)
    tenth = np.sort(exact, axis=1)[:, -10].astype(float)
    q, c, score = qualifying(queries, tenth, lists, 6)
    assert max(lists.known) < 1.0
    assert (score == exact[q, c]).all()
    reached = set(zip(q, c, strict=True))
    assert all((i, j) in reached for i, j in zip(*np.nonzero(exact >= tenth[:, None]), strict=True))
