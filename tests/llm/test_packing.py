from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def checked(rows, texts, tokenizer, capacity):
    """Pieces cover every document's ids once, sequences are gapless, and padding is nil."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["row_id"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    ids_of = sorted((i is None, i or 0, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts)
    found = []
    for (i, _), pieces in by_doc.items():
        pieces.sort(key=lambda r: r["start"])
        n = pieces[0]["doc_tokens"]
        assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1]]
        assert sum(r["length"] for r in pieces) == n
        found.append((i is None, i or 0, n, pieces))
    assert sorted((a, b, n) for a, b, n, _ in found) == sorted((a, b, len(ids)) for a, b, ids in ids_of)
    candidates = {}
    for a, b, ids in ids_of:
        candidates.setdefault((a, b, len(ids)), []).append(np.array(ids, "<u4"))
    for a, b, n, pieces in found:
        assert any(all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in pieces) for ids in candidates[a, b, n])
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in pieces)
        assert [r["offset"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1]]
        assert total == capacity or (total < capacity and total & (total - 1) == 0)


@pytest.mark.parametrize("capacity,unit", [(4096, 32), (64, 4)])
def test_odd_rows(docs, odd_texts, tokenizer, capacity, unit):
    rows = packing.pack(docs(odd_texts), capacity=capacity, unit=unit).collect()
    checked(rows, odd_texts, tokenizer, capacity)


def test_whole_table(spark, sf_dir, tokenizer):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    checked(packing.pack(table, capacity=1024, unit=16).collect(), [(r["doc_id"], r["text"]) for r in table.collect()], tokenizer, 1024)


def test_no_rows_and_one_hot_length(docs, tokenizer):
    assert packing.pack(docs([])).count() == 0
    texts = [(i, "a b c") for i in range(300)]
    checked(packing.pack(docs(texts), capacity=64, unit=4).collect(), texts, tokenizer, 64)


def test_tokens_of_odd_words(tokenizer):
    encode = packing.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("ΑΣ σΣ", "İstanbul", "it's don't 's", "%%% a%%% &&&", "x\x1cy \x85z", "½ ² ª", "é é", "<|endoftext|> a", "日本 日", "_a_ __"):
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cutting_stock_reaches_the_bound():
    counts = {s: 4000 // s for s in range(1, 65)}
    plan = packing.cutting_stock(counts, 64)
    volume = sum(s * n for s, n in counts.items()) / 64
    assert volume - 1e-6 <= sum(x for _, x in plan) <= volume + 2
    for pattern, _ in plan:
        assert sum(s * a for s, a in pattern.items()) <= 64
    for s, n in counts.items():
        assert sum(x * p.get(s, 0) for p, x in plan) == pytest.approx(n, abs=1e-3)


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes, values = np.array([3, 5, 7]), rng.random(3)
        best = max(a * values[0] + b * values[1] + c * values[2] for a in range(8) for b in range(5) for c in range(4) if 3 * a + 5 * b + 7 * c <= 21)
        value, pattern = packing.best_pattern(values, sizes, 21)
        assert value == pytest.approx(best) and pattern @ sizes <= 21 and pattern @ values == pytest.approx(best)


def test_a_plain_word_is_kept_once():
    """Lower-case words lie in the cache of words, not in that of pre-tokens as well."""
    import inspect

    packing.word_encoder.cache_clear()
    encode = packing.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    words = inspect.getclosurevars(encode).nonlocals["words"]
    encode("some plain words, Some Words. Some ÄHNLICH don't")
    assert set(inspect.getclosurevars(type(words).__missing__).nonlocals["pre_tokens"]) == {",", ".", "ähnlich", "don", "'t"}
    assert {"some", "plain", "words", "words,", "Some", "Words."} <= set(words)
