from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe
from tessera.llm.queries import op1_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab eE'st\n\t 1é%日́\x1c\x85　🙂"), max_size=40))
def test_ids_equal_those_of_the_library(text):
    codec = bpe.codec(PATH, PATTERN)
    ranks = bpe.codec(PATH, PATTERN).ranks
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = codec.encode(text)
    assert ids.tolist() == encoding.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_long_pre_tokens(reference):
    codec = bpe.codec(PATH, PATTERN)
    for text in ("a" * 30_000, "abcab" * 20_000, "ab" * 9999 + "é" * 500):
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)
    assert not any(codec.low) and not any(codec.mid) and not codec.buckets  # the queue is empty again


def test_odd_rows(docs, odd_texts, reference):
    table = docs(odd_texts)
    found = bpe.decode(bpe.encode(table, PATH, PATTERN), PATH, PATTERN).collect()
    at_once = bpe.round_trip(table, PATH, PATTERN).collect()
    key = lambda r: (str(r[0]), len(r[1]), str(r[1]))
    want = sorted(((i, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd_texts), key=key)
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in found), key=key) == want
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in at_once), key=key) == want
    assert bpe.encode(docs([]), PATH, PATTERN).count() == 0


def test_query(spark, sf_dir, reference):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
