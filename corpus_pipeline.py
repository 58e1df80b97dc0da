"""Corpus pipeline: quality classifier, exact dedup, SimHash near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet in the
shared folder and read again as the next stage's ``docs``, so a lost executor costs
part of one stage. The first three return the rows that stay, with the columns of
``documents``; the last returns one row per piece of a packed sequence.

Defined results: null texts are empty texts throughout; no documents give no pieces;
extra columns are carried through the first three stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import materialize, read
from tessera.llm.exact_dedup import keep_first
from tessera.llm.packing import pack
from tessera.llm.quality_classifier import fit, keep_good
from tessera.llm.simhash_dedup import keep_one_per_class


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores 0.3 or more."""
    return keep_good(docs, fit(docs, read(spark, sf_dir, "labels")), threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest doc_id of each text (white space normalised)."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest doc_id of each class of fingerprints within 3 bits (3-word shingles)."""
    return keep_one_per_class(docs, shingle=3, distance=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return pack(docs).drop("row_id")


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("packing", packing)]

#: SQL can't express the classifier, the fingerprints' classes or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
