"""Registered queries of the corpus operators: each (spark, sf_dir) -> DataFrame over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.centroid_clusters import cluster_vectors
from tessera.llm.common import crc_fold, read
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.html_extract import extract
from tessera.llm.license_scan import scan_licenses
from tessera.llm.lm_scoring import score_texts
from tessera.llm.nn_descent import near_duplicates
from tessera.llm.packing import pack
from tessera.llm.quality_classifier import FOLDS, HELD_OUT_FOLD, fit, score
from tessera.llm.simhash_dedup import simhash_classes
from tessera.llm.token_alignment import align
from tessera.llm.topk_search import top_k
from tessera.llm.warc import locate_records, read_records, write_archives


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents")).drop("row_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(read(spark, sf_dir, "pages"), least=100)
    return read_records(locate_records(manifest)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(True)).alias("held_out"),
        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents")).drop("row_id")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash_classes(read(spark, sf_dir, "documents"), shingle=3, distance=3)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read(spark, sf_dir, "embeddings"), dims=64, k=8, rounds=10, scale=1024, seed=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_packing": op2_packing,
    "op3_warc": op3_warc,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_html_extraction": op5_html_extraction,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_topk_search": op12_topk_search,
    "op13_centroid_clusters": op13_centroid_clusters,
}
