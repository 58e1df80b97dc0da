from __future__ import annotations

import numpy as np

from tessera.llm.nn_descent import Settings, near_duplicates, trees_for

SCHEMA = "vec_id long, embedding array<float>, label int, id long, vec string"


def brute(rows, threshold=0.9):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    links = [0] * len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if y else None for (_, v), y in zip(rows, ok, strict=True)]
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                label[find(a)] = find(b)
    members = {}
    for k in range(len(rows)):
        members.setdefault(find(k), []).append(rows[k][0])
    least = [min(members[find(k)], key=lambda i: (i is None, i or 0)) for k in range(len(rows))]
    return sorted((str(i), n, str(c), i is not None and i == c) for (i, _), n, c in zip(rows, links, least, strict=True))


def found(spark, rows, settings=Settings()):
    table = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in near_duplicates(table, settings).collect())


def near(rng, center, angle):
    """A float32 vector about so many radians from the center."""
    side = rng.standard_normal(len(center))
    side -= side @ center / (center @ center) * center
    v = np.cos(angle) * center / np.linalg.norm(center) + np.sin(angle) * side / np.linalg.norm(side)
    return [float(np.float32(x)) for x in v]


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
            (10, [0.0, -1.0]), (11, [1.0, 0.0, 0.0]), (None, [0.0, 1.0]), (None, [1.0, 0.1]), (12, [0.0, 3.0])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_planted_groups(spark):
    rng = np.random.default_rng(7)
    rows, i = [], 0
    for size in (1,) * 60 + (2, 2, 3, 5, 9, 60):
        center = rng.standard_normal(24)
        for _ in range(size):
            rows.append((i, near(rng, center, rng.uniform(0, 0.3))))
            i += 1
    rows += [(1000 + k, rows[-1][1]) for k in range(40)]
    assert found(spark, rows, Settings(leaf=32, block=16, k=4)) == brute(rows)


def test_links_between_groups_with_full_lists(spark):
    """Two tight groups whose links to each other never are among a node's best, a third one far away."""
    rng = np.random.default_rng(3)
    one, side = rng.standard_normal(48), rng.standard_normal(48)
    one /= np.linalg.norm(one)
    side -= side @ one * one
    two = 0.94 * one + np.sqrt(1 - 0.94 ** 2) * side / np.linalg.norm(side)
    rows = [(100 * g + i, near(rng, center, 0.1)) for g, center in enumerate((one, two, rng.standard_normal(48))) for i in range(50)]
    assert found(spark, rows, Settings(k=4)) == brute(rows)


def test_many_full_groups_meet_in_shared_leaves(spark):
    """Forty groups with full lists, every fourth linked with the one before; leaves shared by more than a block of them."""
    rng = np.random.default_rng(9)
    rows, center = [], None
    for g in range(40):
        if g % 4 == 3:
            side = rng.standard_normal(24)
            side -= side @ center / (center @ center) * center
            center = 0.95 * center / np.linalg.norm(center) + np.sqrt(1 - 0.95 ** 2) * side / np.linalg.norm(side)
        else:
            center = rng.standard_normal(24)
        rows += [(100 * g + i, near(rng, center, 0.08)) for i in range(7)]
    want = brute(rows)
    assert len({r[2] for r in want}) == 30
    assert found(spark, rows, Settings(k=4, leaf=32, block=4)) == want


def test_isolated_pairs_beside_a_large_group(spark):
    """The group's links are so many that the pairs hardly show among them."""
    rng = np.random.default_rng(4)
    center = rng.standard_normal(24)
    rows = [(i, near(rng, center, 0.1)) for i in range(100)]
    for i in range(100, 300, 2):
        center = rng.standard_normal(24)
        rows += [(i, near(rng, center, 0.0)), (i + 1, near(rng, center, 0.4))]
    result, want = found(spark, rows, Settings(leaf=8, k=3, trees=1, rounds=1)), brute(rows)
    paired = [r for r in want if int(r[0]) >= 100 and r[1]]
    assert len(paired) >= 200
    assert len(set(paired) & set(result)) >= 0.97 * len(paired)
    assert trees_for(1 << 28, Settings()) > trees_for(1 << 18, Settings()) > trees_for(1 << 8, Settings())
