from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from test_dedup import classes, fingerprint, normalised, null_last
from test_packing import checked
from tokenizers import Tokenizer

from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.quality_classifier import fit, score
from tessera.llm.simhash_dedup import simhash_classes


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The input of each stage, and the last stage's output."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], sf_dir).persist())
    return seen


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").distinct().collect())


def test_stages_take_effect(spark, sf_dir, stages):
    docs, good, distinct, apart, pieces = stages
    assert good.columns == distinct.columns == apart.columns == docs.columns
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(good) == sorted(r["doc_id"] for r in score(docs, model).collect() if r["score"] >= 0.3)
    assert ids(distinct) == sorted(r["doc_id"] for r in exact_dedup(good).collect() if r["kept"])
    assert ids(apart) == sorted({r["component_id"] for r in simhash_classes(distinct).collect()})
    assert ids(pieces) == ids(apart)
    assert 0 < apart.count() <= distinct.count() < good.count() < docs.count()


def test_run_equals_its_stages(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == stages[-1].columns
    key = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert sum(r[2] for r in key(rows)) == sum(r[2] for r in key(stages[-1]))
    assert {r[0] for r in key(rows)} == {r[0] for r in key(stages[-1])}


def test_no_documents(spark, docs, sf_dir):
    table = docs([])
    for _, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, sf_dir)
        assert table.count() == 0


def plain(rows, model):
    """What the filtering stages leave of (doc_id, text) rows, row by row in plain Python."""
    good = sorted(((i, t) for i, t in rows if model.probability(t or "") >= 0.3), key=lambda r: null_last(r[0]))
    first = {}
    for i, t in good:
        first.setdefault(normalised(t), (i, t))
    distinct = list(first.values())
    label = classes(list(range(len(distinct))), [fingerprint(t) for _, t in distinct])  # rows stand in the order of their ids
    return [distinct[k] for k in sorted(set(label))]


def packed_well(rows, left):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    checked(rows, left, tokenizer, 4096)


def test_run_against_plain_python(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    left = plain([(r["doc_id"], r["text"]) for r in docs.collect()], fit(docs, labels))
    assert 0 < len(left) < docs.count()
    rows = [{**r.asDict(), "row_id": r["doc_id"]} for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert {r["doc_id"] for r in rows} == {i for i, _ in left}
    packed_well(rows, left)


def test_odd_rows_through_all_stages(spark, docs, odd_texts, sf_dir):
    """Nulls, empty and very long texts, repeats; the classifier is fitted on the same few odd rows' labels, or none."""
    table = docs(odd_texts)
    left = plain(odd_texts, fit(table, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, table = table.columns, stage(spark, table, sf_dir).persist()
        assert table.columns == columns
    assert sorted((null_last(r["doc_id"]), normalised(r["text"])) for r in table.collect()) == sorted((null_last(i), normalised(t)) for i, t in left)
    rows = [{**r.asDict(), "row_id": r["doc_id"]} for r in corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).collect()]
    packed_well(rows, left)
