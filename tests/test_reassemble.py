"""Chunk reassembly (FIXTURES 1a, 1b; hazards H1, H2, H3)."""

from pyspark.sql import functions as F

from tessera.operators import reassemble


def test_chunks_are_glued_in_index_order(chunks_df):
    chunks = chunks_df([
        ("ext-1", "B4A2EB428B04", "ImberaLink", None, "126", 1, "EVENTS", 1, "424008a8"),
        ("ext-1", "B4A2EB428B04", "ImberaLink", None, "126", 1, "EVENTS", 0, "000f"),
    ])
    docs = reassemble(chunks).collect()
    assert len(docs) == 1
    assert docs[0]["payload_hex"] == "000f424008a8"


def test_start_end_row_without_data_gives_null_type_and_payload(chunks_df):
    chunks = chunks_df([("ext-2", "B4A2EB428B04", "ImberaLink", None, "126", 1, None, None, None)])
    docs = reassemble(chunks).collect()
    assert len(docs) == 1
    assert docs[0]["type"] is None
    assert docs[0]["payload_hex"] is None  # NULL, not '' (H3)


def test_null_index_chunk_goes_last(chunks_df):
    chunks = chunks_df([
        ("e", "D", "T", None, "126", 1, "EVENTS", None, "zz"),
        ("e", "D", "T", None, "126", 1, "EVENTS", 1, "aa"),
    ])
    assert reassemble(chunks).collect()[0]["payload_hex"] == "aazz"


def test_null_chunks_are_skipped_and_null_keys_group_together(chunks_df):
    chunks = chunks_df([
        ("e", "D", None, None, None, 3, "EVENTS", 0, "ab"),
        ("e", "D", None, None, None, 3, "EVENTS", 1, None),
        ("e", "D", None, None, None, 3, "EVENTS", 2, "cd"),
    ])
    docs = reassemble(chunks).collect()
    assert [d["payload_hex"] for d in docs] == ["abcd"]


def test_two_objects_of_one_extraction_never_mix(chunks_df):
    chunks = chunks_df([
        ("e", "D", "T", None, "126", 1, "EVENTS", 0, "000f4240"),
        ("e", "D", "T", None, "126", 1, "EVENTS", 1, "08a8"),
    ])
    two = chunks.withColumn("object_key", F.lit("a.parquet")).unionByName(
        chunks.withColumn("object_key", F.lit("b.parquet")))
    payloads = sorted(r["payload_hex"] for r in reassemble(two).collect())
    assert payloads == ["000f424008a8", "000f424008a8"]


def test_missing_sequence_reads_as_zero(chunks_df):
    chunks = chunks_df([("e", "D", "T", None, "126", None, "EVENTS", 0, "ab")])
    assert reassemble(chunks).collect()[0]["document_sequence"] == 0
