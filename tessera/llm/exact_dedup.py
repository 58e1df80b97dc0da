"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

1. Every row becomes ``(doc_id, row_id, run, digest, n_bytes, check)``: the SHA-256
   of its normalised text, and the text's length and 64-bit hash, which verify that
   rows of one digest hold one text. ``run`` is the partition that read the row. This
   table is written, so that texts are read once.
2. In each round ``fan_in`` runs meet: run ``r`` goes to ``r div fan_in``. Every run
   first shrinks by itself to one row per digest (the map-side aggregate), so a text
   that a third of all rows share costs one row a task; the merged run keeps the
   smallest identifier and the row count of each digest, sorted, in a file of its own
   round. Rounds go on until one run is left; that run still lies over many tasks,
   dealt by digest.
3. Rows look up their digest in the last run. Both sides come from files, so that
   Spark splits a hot digest by itself.

Defined results. A null text counts as empty. A null ``doc_id`` is larger than any
other. Of rows that share text and smallest ``doc_id``, one is kept. No rows give no
rows. Columns other than the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import files_for, levels, materialize, numbered

WHITE_SPACE = r"[\x20\x09-\x0D]+"
IDENTITY = ["digest", "n_bytes", "check"]


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                row_col: str | None = None) -> DataFrame:
    """One written row per document: id, row_id, run, digest, n_bytes, check.

    ``row_col``: a unique long of each row; without it one is dealt out.
    """
    row_id = F.col(row_col) if row_col else F.monotonically_increasing_id()
    text = F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), WHITE_SPACE, " ")
    rows = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), row_id.alias("row_id"), text.alias("text"))
            .select("doc_id", "row_id", F.spark_partition_id().alias("run"),
                    F.unhex(F.sha2("text", 256)).alias("digest"),
                    F.octet_length("text").cast("long").alias("n_bytes"),
                    F.xxhash64("text").alias("check")))
    return materialize(rows, "digests")


def merge_runs(rows: DataFrame, fan_in: int = 8) -> DataFrame:
    """One row per text: its identity, ``first`` (doc_id, row_id) and ``group_size``."""
    last_run, n = rows.agg(F.max("run"), F.count("*")).first()
    run = rows.select("run", *IDENTITY,
                      F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id").alias("first"),
                      F.lit(1).cast("long").alias("group_size"))
    for _ in range(levels((last_run or 0) + 1, fan_in)):
        merged = (run.withColumn("run", F.expr(f"run div {fan_in}").cast("int"))
                  .groupBy("run", *IDENTITY)
                  .agg(F.min("first").alias("first"), F.sum("group_size").alias("group_size"))
                  .coalesce(files_for(n)).sortWithinPartitions("run", "digest"))
        run = materialize(merged, "runs")
    return run.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8,
                row_col: str | None = None) -> DataFrame:
    """Per row: doc_id, row_id, keep_id, group_size, kept, text_sha256."""
    rows = digest_rows(docs, id_col, text_col, row_col)
    texts = merge_runs(rows, fan_in)
    return (rows.drop("run").join(texts, IDENTITY)
            .select("doc_id", "row_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("row_id") == F.col("first.row_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without later copies; all columns of every row that stays."""
    rows, row = numbered(docs)
    kept = exact_dedup(rows, id_col, text_col, row_col=row).where("kept").select(F.col("row_id").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)
