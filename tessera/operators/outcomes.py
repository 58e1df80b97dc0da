"""Per-object outcome (processed or not, where it went)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import silver_prefix
from tessera.operators.decode import audit_reason


def object_outcomes(documents: DataFrame, silver_root: str, fields=None) -> DataFrame:
    """One row per object that had documents.

    ``status`` is ``processed`` when the object produced records, else ``empty``;
    ``silver_prefix`` is where its files went (NULL when empty);
    ``single_device`` is false when an object mixes devices or extractions
    (the one-device-per-object invariant is broken).

    Computed from the documents alone: a well-formed document yields exactly one
    record per field of its layout, so the record count comes from the audit
    (a broadcast join with the constant layout headers). The documents first
    collapse to one row per (object, device, extraction, technology) with counts
    only (a hash aggregate with map-side partial aggregation); the string
    min/max per object then runs on that small set. No second pass over the
    input and no join with the decoded records.
    """
    audited = audit_reason(documents, fields)
    per_device = audited.groupBy("object_key", "id_controller", "extraction_id", "technology").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum("decoded_fields").alias("n_records"))
    ok = F.col("n_records") > 0
    per_obj = per_device.groupBy("object_key").agg(
        F.sum("n_documents").alias("n_documents"),
        F.sum("n_records").alias("n_records"),
        # One device's own pair: a mixed object must not name a directory that does not exist.
        F.min(F.when(ok, F.struct("technology", "id_controller"))).alias("_place"),
        ((F.min("id_controller") == F.max("id_controller"))
         & (F.min("extraction_id") == F.max("extraction_id"))).alias("single_device"))
    n_records = F.coalesce(F.col("n_records"), F.lit(0)).cast("long")
    processed = n_records > 0
    return per_obj.select(
        "object_key",
        F.col("n_documents").cast("long").alias("n_documents"),
        n_records.alias("n_records"),
        F.when(processed, "processed").otherwise("empty").alias("status"),
        F.when(processed, silver_prefix(silver_root, F.col("_place.technology"), F.col("_place.id_controller"))).alias("silver_prefix"),
        F.coalesce(F.col("single_device"), F.lit(True)).alias("single_device"),
    )
