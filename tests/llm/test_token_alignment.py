from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import token_alignment
from tessera.llm.minimal_hash import Slots, build, shard_of
from tessera.llm.token_alignment import align, encoders

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def whole(text):
    """Ids of the whole text by both libraries, and the byte each token ends at; none where they do not spell it out."""
    both = encoders(*PATHS)
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    spelled = [b"".join(t[i] for i in x) for t, x in ((both.a_bytes, a), (both.b_bytes, b))]
    if not text or spelled != [(" " + text).encode()] * 2:
        return [], [], [], []
    return a, b, np.cumsum([len(both.a_bytes[i]) for i in a]).tolist(), np.cumsum([len(both.b_bytes[i]) for i in b]).tolist()


def brute(rows):
    docs, counts = [], Counter()
    for i, text in rows:
        a, b, a_end, b_end = whole(text or "")
        a_at, b_at = dict(zip(a_end, range(len(a)), strict=True)), dict(zip(b_end, range(len(b)), strict=True))
        ends = sorted(a_at.keys() & b_at.keys())
        links = [(a[a_at[e]], b[b_at[e]]) for e in ends]
        groups, x, y = [], 0, 0
        for e in ends:
            groups.append(",".join(map(str, a[x:a_at[e] + 1])) + "|" + ",".join(map(str, b[y:b_at[e] + 1])))
            x, y = a_at[e] + 1, b_at[e] + 1
        counts.update(links)
        docs.append((i, len(a), len(b), links, ";".join(groups)))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(map(str, ((i, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                             hashlib.sha256(g.encode()).hexdigest() if g else "") for i, n_a, n_b, links, g in docs)))


def found(docs, rows, **more):
    result = align(docs(rows), *PATHS, **more)
    assert result.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(str(tuple(r)) for r in result.collect())


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    words = ["the", "of", "Über", "naïve", "日本語", "é", "&&&", "don't", "x1", "<|endoftext|>", "<s>", "<0x41>", "\U0001f642", "I'll", "1234", "ﬁ", "مرحبا", "antidis", "\x1c", "　"]
    spaces = [" ", " ", " ", "  ", "\n", "\n\n", "\t", " \n", "\r\n ", " ", "   "]
    return [(100 + i, "".join(w + s for w, s in zip(r.choices(words, k=i % 40), r.choices(spaces, k=i % 40), strict=True))) for i in range(300)]


def test_odd_texts_against_whole_encoding(docs, odd_texts, texts):
    more = [(200, "with ▁ sign"), (201, "▁"), (202, " leading"), (203, "trailing  "), (204, "á é"), (205, "<unk> </s>")]
    rows = odd_texts + texts + more
    assert found(docs, rows) == brute(rows)
    assert found(docs, []) == []
    assert found(docs, [(1, None), (2, "")]) == brute([(1, None), (2, "")])


def test_many_shards_and_passes(docs, texts, monkeypatch):
    """Pairs in many shards, few of which are counted at once, summed in several rounds."""
    monkeypatch.setattr(token_alignment, "FAN_IN", 2)
    assert found(docs, texts, shard=16, pairs_at_once=150) == brute(texts)


def test_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in table.collect()])
    assert sorted(str(tuple(r)) for r in align(table, *PATHS).collect()) == want


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 60_000])
def test_every_key_has_its_own_slot(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 47, n))
    shards = max(1, len(keys) // 700)
    of = shard_of(keys, shards)
    built = {s: build(keys[of == s]) for s in range(shards)}
    slots = Slots(shards, {s: levels for s, (levels, _) in built.items()})
    ordered = np.concatenate([p for _, p in built.values()])
    assert sorted(slots(keys)) == list(range(len(keys)))
    assert (ordered[slots(keys)] == keys).all()
    if n > 1000:
        assert sum(8 * len(x) for levels, _ in built.values() for x in levels) < 4.5 * len(keys)
        others = np.setdiff1d(rng.integers(0, 1 << 47, n), keys)
        at = slots(others)
        assert (ordered[at[at >= 0]] != others[at >= 0]).all()
        half = Slots(shards, {s: levels for s, (levels, _) in built.items() if s < shards // 2})
        here = of < shards // 2
        assert sorted(half(keys[here])) == list(range(here.sum())) and (half(keys[~here]) == -1).all()


def test_a_pair_that_was_not_hashed_is_noticed():
    import pyarrow as pa
    pairs = np.arange(100, dtype=np.int64)
    levels, ordered = build(pairs)
    counts = token_alignment.Counts(1, pa.table({"shard": [0], "n": [100], "levels": pa.array([levels], pa.list_(pa.binary())), "pairs": [ordered]}))
    assert (counts.pairs[counts.of(pairs)[0]] == pairs).all()
    with pytest.raises(RuntimeError, match="not in the hash"):
        counts.of(np.arange(100, 400, dtype=np.int64))
