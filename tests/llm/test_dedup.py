from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import xxhash

from tessera.llm import simhash_dedup
from tessera.llm.common import connected_components, prefix_sums
from tessera.llm.exact_dedup import exact_dedup, keep_first


def null_last(i):
    return (i is None, i or 0)


def normalised(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def test_exact_dedup_of_odd_rows(docs, odd_texts):
    rows = exact_dedup(docs(odd_texts), fan_in=2).collect()
    assert len(rows) == len(odd_texts)
    groups = {}
    for i, t in odd_texts:
        groups.setdefault(hashlib.sha256(normalised(t).encode()).hexdigest(), []).append(i)
    for r in rows:
        group = groups[r["text_sha256"]]
        assert r["keep_id"] == min(group, key=null_last) and r["group_size"] == len(group)
    for digest in groups:
        assert sum(r["kept"] for r in rows if r["text_sha256"] == digest) == 1
        assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert exact_dedup(docs([])).count() == 0


def test_merge_over_many_runs(docs):
    texts = [(i, f"text {i % 7}") for i in range(500, 0, -1)]
    rows = exact_dedup(docs(texts).repartition(40), fan_in=3).collect()
    assert {(r["doc_id"], r["keep_id"]) for r in rows} == {(i, (i - 1) % 7 + 1) for i, _ in texts}


def test_keep_first_keeps_columns(docs, odd_texts):
    table = docs(odd_texts)
    kept = keep_first(table)
    assert kept.columns == table.columns
    assert sorted(normalised(r["text"]) for r in kept.collect()) == sorted({normalised(t) for _, t in odd_texts})


def fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, codes, radius=3):
    label = list(range(len(ids)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if bin(codes[a] ^ codes[b]).count("1") <= radius:
                label[find(a)] = find(b)
    least = {}
    for k in range(len(ids)):
        least.setdefault(find(k), []).append(ids[k])
    return [min(least[find(k)], key=null_last) for k in range(len(ids))]


def test_simhash_of_odd_rows(docs, odd_texts):
    rows = simhash_dedup.simhash_classes(docs(odd_texts)).collect()
    codes = [fingerprint(t) for _, t in odd_texts]
    want = sorted(zip(map(str, (i for i, _ in odd_texts)), codes, map(str, classes([i for i, _ in odd_texts], codes)), strict=True))
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in rows) == want
    assert simhash_dedup.simhash_classes(docs([])).count() == 0
    table = docs(odd_texts)
    kept = simhash_dedup.keep_one_per_class(table)
    assert kept.columns == table.columns and kept.count() == len({c for _, _, c in want if c != "None"}) + ("None" in {c for _, _, c in want})


def test_links_of_planted_codes(spark):
    """Chains and clusters at 0 to 4 bits, one cluster large enough to be split."""
    r = random.Random(3)
    codes = set()
    for _ in range(60):
        c = r.getrandbits(64)
        codes.add(c)
        for _ in range(r.randint(0, 6)):
            for b in r.sample(range(64), r.randint(1, 4)):
                c ^= 1 << b
            codes.add(c)
    center = r.getrandbits(64)
    codes |= {center ^ 1 << a ^ 1 << b for a in range(30) for b in range(30)}
    codes = sorted(codes)
    fps = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "fp long")
    links = simhash_dedup.link_fingerprints(fps, 3, split=100)
    roots = {r["node"] % 2**64: r["root"] for r in connected_components(links).collect()}
    groups = {}
    for c, k in zip(codes, classes(range(len(codes)), codes), strict=True):
        groups.setdefault(k, set()).add(c)
    found = {}
    for c in codes:
        found.setdefault(roots.get(c, c), set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_bk_forest_finds_all_in_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 10, 400).astype(np.uint64)
    trees = rng.integers(0, 3, 400)
    forest = simhash_dedup.BKForest(codes, trees)
    found = {(int(q), int(n)) for qs, ns in forest.search(np.arange(400), 2) for q, n in zip(qs, ns, strict=True)}
    assert found == {(a, b) for a in range(400) for b in range(400) if trees[a] == trees[b] and int(codes[a] ^ codes[b]).bit_count() <= 2}


def test_connected_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(9, 9), (None, 1), (3, 1), (1, 2)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert roots == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 700)}, 1: 1, 2: 1, 3: 1}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_prefix_sums(spark, workdir):
    table = spark.range(1000).selectExpr("id", "id % 3 AS g", "id % 5 AS x")
    rows = prefix_sums(table, "id", "x", "before", group="g", buckets=16).collect()
    for g in range(3):
        group = sorted((r for r in rows if r["g"] == g), key=lambda r: (r["before"], r["before"] + r["x"]))
        at = 0
        for r in group:
            assert r["before"] == at
            at += r["x"]


def test_a_hot_shard_is_split_on_both_sides(spark):
    """More than 100,000 fingerprints agree in a band: no cell holds more than two blocks, and no link is lost."""
    rng = np.random.default_rng(12)
    high = rng.integers(0, 1 << 48, 102_000, dtype=np.uint64)
    chain = high[:1500]
    for _ in range(2):  # chains of copies at 1 to 3 bits, so that components have up to three members
        flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 48, (3, len(chain)), dtype=np.uint64), axis=0)
        chain = chain ^ flips
        high = np.concatenate([high, chain])
    codes = np.unique(high << np.uint64(16) | np.uint64(0xBEEF))
    fps = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    sizes = simhash_dedup.deal_cells(fps, 3, 8192).groupBy("band", "value", "low", "high").count().agg({"count": "max"}).first()[0]
    assert sizes < 2.2 * 8192
    found = {r["node"]: r["root"] for r in connected_components(simhash_dedup.link_fingerprints(fps, 3)).collect()}
    label = np.arange(len(codes))
    for i in range(0, len(codes), 256):
        a, b = np.nonzero(np.bitwise_count(codes[i:i + 256, None] ^ codes[None, i:]) <= 3)
        simhash_dedup.merge_labels(label, a[a < b] + i, b[a < b] + i)
    members = {}
    for k, root in enumerate(label.tolist()):
        members.setdefault(root, []).append(int(codes.view(np.int64)[k]))
    want = {c: min(group) for group in members.values() if len(group) > 1 for c in group}
    assert len(want) > 4000 and found == want


def test_rows_that_only_query(spark):
    rng = np.random.default_rng(13)
    codes, trees = rng.integers(0, 1 << 12, 400, dtype=np.uint64), np.sort(rng.integers(0, 9, 400))
    is_node = (rng.random(400) < 0.5) & (trees != 4)  # one tree has no node
    forest = simhash_dedup.BKForest(codes, trees, is_node)
    queries = np.flatnonzero(~is_node)
    pairs = {(int(q), int(n)) for qs, ns in forest.search(queries, 2) for q, n in zip(qs, ns, strict=True)}
    assert pairs == {(q, n) for q in queries.tolist() for n in np.flatnonzero(is_node).tolist() if trees[q] == trees[n] and int(codes[q] ^ codes[n]).bit_count() <= 2}
