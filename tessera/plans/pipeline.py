"""Bronze objects -> Silver files + table, as one Spark plan per batch.

The reference handles one object per call; here one call handles every object of
a batch. Documents of different objects never mix (the object key is part of the
reassembly key) and the latest delivery of an extraction wins, which is what
processing the objects one after another would leave behind.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import decodable_chunks, decode_records, last_delivery_wins, object_outcomes, observed_audit, reassemble, resolve_technology
from tessera.schemas import REJECTS
from tessera.session import Workspace, materialize
from tessera.sinks.silver import ensure_schemas, write_silver_files
from tessera.sinks.table import replace_rows, upsert_telemetry
from tessera.sources import read_objects

OUTCOME_COLUMNS = ["object_key", "n_documents", "n_records", "status", "silver_prefix", "single_device", "error"]


def documents_of(chunks: DataFrame) -> DataFrame:
    """B5 then B6: reassembled documents with the corrected technology."""
    return resolve_technology(reassemble(chunks))


def records_of(chunks: DataFrame, fields=None) -> DataFrame:
    """B5 -> B6 -> B7..B11: decoded records of every delivery (no replacement yet)."""
    return decode_records(documents_of(decodable_chunks(chunks, fields)), fields)


def write_rejects(audited: DataFrame, objects: DataFrame, table: str, location: str, buckets: int | None = None) -> None:
    """B10 side table: every document that yields no records, with the reason and
    the ids needed to find it again (extraction, device, sequence, object).

    The rejects of the batch's ``objects`` (object_key) replace those of earlier runs, also by none.
    """
    rejects = audited.where("decode_reason != 'ok'").select(*REJECTS.fieldNames())
    replace_rows(rejects, table, location, REJECTS, ["object_key"], replaced=objects, buckets=buckets)


@dataclass
class SilverTarget:
    """Where a batch goes: root of the Silver files, name of the table in the catalog, and of the rejects' (if any).

    Tables that are made now lie below ``table_root`` (default: ``tables`` below the Silver root) and
    get ``buckets`` buckets; existing ones keep their place and count.
    """
    silver_root: str
    table: str = "silver.telemetry_decoded"
    rejects_table: str | None = None
    table_root: str | None = None
    buckets: int | None = None
    file_partitions: int | None = None

    def location(self, table: str) -> str:
        return f"{(self.table_root or self.silver_root.rstrip('/') + '/tables').rstrip('/')}/{table.rsplit('.', 1)[-1]}"


def bronze_to_silver(spark: SparkSession, bronze_root: str, keys: Iterable[str] | DataFrame | None,
                     target: SilverTarget, fields=None, work: Workspace | None = None, counts: dict | None = None) -> DataFrame:
    """Read the named objects (a list, a table ``object_key``, or every object below
    ``bronze_root``), refine, write; the outcomes, one row per object.

    A bad object never fails its neighbours, and writes nothing: ``processed``, ``empty``
    (read, nothing decoded), ``unreadable`` (damaged, not fitting, or without rows) or
    ``missing``; the last two carry an ``error`` text and can be re-run with ``reprocess``.

    Chunks, audited documents and winning records are staged in one folder, which cuts the
    lineage and lets sinks and outcomes read the same rows. It is ``work``, which the caller
    removes, with the outcomes in it; without one, it is removed here, and the outcomes are
    staged on their own. ``counts`` receives the counters of the decoding (documents by
    reason, records), which come along with the staging of the documents.
    """
    if work is None:
        with Workspace(spark, "batch") as own:
            return materialize(bronze_to_silver(spark, bronze_root, keys, target, fields, own, counts), "outcomes")
    chunks, asked = read_objects(spark, bronze_root, keys, work)
    docs, counters = observed_audit(documents_of(chunks), fields)
    docs = work.materialize(docs, "documents")
    if counts is not None:
        counts.update(counters.get)
    ensure_schemas(spark, target.silver_root)
    if target.rejects_table:
        write_rejects(docs, asked, target.rejects_table, target.location(target.rejects_table), target.buckets)
    winners = work.materialize(last_delivery_wins(decode_records(docs, fields)), "records")
    if not winners.isEmpty():
        write_silver_files(winners, target.silver_root, target.file_partitions)
        upsert_telemetry(winners, target.table, target.location(target.table), target.buckets)
    decoded = object_outcomes(docs, target.silver_root, fields)
    outcomes = asked.join(decoded, "object_key", "left").select(
        "object_key",
        F.coalesce("n_documents", F.lit(0).cast("long")).alias("n_documents"),
        F.coalesce("n_records", F.lit(0).cast("long")).alias("n_records"),
        F.when(F.col("object_status") == "read", F.coalesce("status", F.lit("empty"))).otherwise(F.col("object_status")).alias("status"),
        "silver_prefix",
        F.coalesce("single_device", F.lit(True)).alias("single_device"),
        "error",
    )
    return work.materialize(outcomes.select(*OUTCOME_COLUMNS), "outcomes")


def reprocess(spark: SparkSession, bronze_root: str, keys: Iterable[str], target: SilverTarget,
              fields=None, work: Workspace | None = None) -> DataFrame:
    """Manual re-run of explicit object keys (same path as the automatic one)."""
    return bronze_to_silver(spark, bronze_root, list(keys), target, fields, work)
