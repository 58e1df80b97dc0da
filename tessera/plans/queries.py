"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's ``events`` table (through the derived Bronze
fixtures) over the whole table, so its work grows with the data. Queries that
exercise a sink write to a fresh folder below the session's shared root and
return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import date_parts, epoch_millis_to_ntz, mac_prefix, path_safe, silver_prefix
from tessera.operators import (audit_reason, decodable_chunks, decode_audit, last_delivery_wins, object_outcomes, observed_audit, qualifying_objects,
                               reassemble, resolve_technology, stored_layouts, telemetry)
from tessera.plans.pipeline import SilverTarget, bronze_to_silver, documents_of, records_of
from tessera.plans.staging import notify, stage_bronze_objects, stage_notifications
from tessera.schemas import DOCUMENT_KEYS, TELEMETRY
from tessera.session import fresh_dir, materialize
from tessera.sinks.silver import ensure_schemas, read_silver_files, silver_file_rows, write_silver_files
from tessera.sinks.table import TABLE_KEY, merge_buckets, rebucket, upsert_telemetry
from tessera.sources import (bronze_chunks, bronze_deliveries, list_objects, notification_payloads, notification_records, odd_ids,
                             parse_notifications, read_table, two_layouts)
from tessera.streaming.stream import MAX_DELIVERIES, dead_letters, stream_silver

# Silver root used when a query reports paths without writing (as in production).
SILVER_ROOT = "s3://silver"


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_chunks(read_table(spark, sf_dir, "events"))


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_deliveries(_chunks(spark, sf_dir))


def q_notifications_qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = parse_notifications(notification_payloads(read_table(spark, sf_dir, "events")))
    return qualifying_objects(notes).select("notification_id", "bucket", "object_key", "correlation_id")


def q_technology_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = _chunks(spark, sf_dir).select("id_controller", "technology").distinct()
    return resolve_technology(devices).select(
        "id_controller", "reported_technology",
        mac_prefix(F.col("id_controller")).alias("mac_prefix"), "technology")


def q_documents_reassembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reassemble(_chunks(spark, sf_dir)).select(*DOCUMENT_KEYS, "payload_hex")


def q_telemetry_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(records_of(_chunks(spark, sf_dir)))


def q_decode_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_audit(documents_of(_chunks(spark, sf_dir)))


def q_silver_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_file_rows(records_of(_chunks(spark, sf_dir)))
    return (rows.groupBy("technology", "device_id", "year", "month", "day", "extraction_id")
            .agg(F.count(F.lit(1)).alias("n_records")))


def q_silver_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Documents that decode, not their records: the prefix needs no field.
    docs = audit_reason(documents_of(decodable_chunks(_chunks(spark, sf_dir)))).where("decode_reason = 'ok'")
    return docs.select(
        "extraction_id",
        silver_prefix(SILVER_ROOT, F.col("technology"), F.col("id_controller")).alias("silver_prefix"),
    ).distinct()


def q_last_delivery_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    winners = last_delivery_wins(records_of(_deliveries(spark, sf_dir)))
    return winners.select("name", "value", "timestamp", "technology", "device_id", "extraction_id",
                          "object_key")


def _new_table(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """Name and location of a table that no other run has."""
    work = fresh_dir(spark, purpose)
    return f"silver.{work.rsplit('/', 1)[-1].replace('-', '_')}", f"{work}/table"


def q_telemetry_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries upserted one after the other into a fresh bucketed table."""
    # Both upserts read the decoded deliveries: materialize once in the shared
    # folder instead of recomputing the scan and the reassembly shuffle per upsert.
    records = materialize(records_of(_deliveries(spark, sf_dir)), "q-upserted-records")
    table, location = _new_table(spark, "q-upserted")
    for seq in (1, 2):
        upsert_telemetry(records.where(F.col("delivery_seq") == seq), table, location, buckets=8)
    return telemetry(spark.table(table))


def q_object_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return object_outcomes(documents_of(_deliveries(spark, sf_dir)), SILVER_ROOT)


def q_silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write Silver files, read them back: raw envelope values and the date levels."""
    root = fresh_dir(spark, "q-silver")
    write_silver_files(materialize(records_of(_chunks(spark, sf_dir)), "q-silver-records"), root)
    back = read_silver_files(spark, root)
    return back.select("name", "value", "timestamp",
                       F.col("source_technology").alias("technology"),
                       F.col("source_device_id").alias("device_id"),
                       F.col("source_extraction_id").alias("extraction_id"),
                       "year", "month", "day")


def _new_target(spark: SparkSession, purpose: str) -> tuple[str, SilverTarget]:
    """A fresh folder and a target below it."""
    work = fresh_dir(spark, purpose)
    return work, SilverTarget(silver_root=f"{work}/silver", table=f"silver.{work.rsplit('/', 1)[-1].replace('-', '_')}", buckets=8)


def _run_stream(spark: SparkSession, feed: str, bronze_root: str, target: SilverTarget, work: str, **more) -> None:
    query = stream_silver(spark, feed, bronze_root, target, checkpoint=f"{work}/checkpoint",
                          outcomes_path=f"{work}/outcomes", available_now=True, **more)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def q_stream_availablenow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze objects + a notification feed derived from ``events``, run through
    the streaming job with an available-now trigger; returns the Silver table."""
    work, target = _new_target(spark, "q-stream")
    bronze_root, feed = f"{work}/bronze", f"{work}/notifications"
    stage_bronze_objects(_chunks(spark, sf_dir), bronze_root)
    stage_notifications(spark, bronze_root, feed)
    _run_stream(spark, feed, bronze_root, target, work)
    return telemetry(spark.table(target.table))


def q_upsert_after_interruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``telemetry_upserted``, but the second upsert first breaks off after it has written
    its merged buckets and before the catalog points at them; then it is run again."""
    records = materialize(records_of(_deliveries(spark, sf_dir)), "q-interrupted-records")
    table, location = _new_table(spark, "q-interrupted")
    first, second = (records.where(F.col("delivery_seq") == seq) for seq in (1, 2))
    upsert_telemetry(first, table, location, buckets=8)
    merge_buckets(second, second.select(*TABLE_KEY).distinct(), table, location, TELEMETRY, TABLE_KEY, 8)
    upsert_telemetry(second, table, location)
    return telemetry(spark.table(table))


def q_silver_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver files of the first deliveries, then of the second ones over them; read back."""
    records = materialize(records_of(_deliveries(spark, sf_dir)), "q-redelivered-records")
    root = fresh_dir(spark, "q-redelivered")
    for seq in (1, 2):
        write_silver_files(records.where(F.col("delivery_seq") == seq), root)
    return read_silver_files(spark, root).select(
        "name", "value", "timestamp", F.col("source_technology").alias("technology"),
        F.col("source_device_id").alias("device_id"), F.col("source_extraction_id").alias("extraction_id"))


def _extraction_no() -> Column:
    """Number of a fixture extraction, in a row of its chunks."""
    return F.substring("extraction_id", 5, 100).cast("long")


def _unfit(chunks: DataFrame) -> DataFrame:
    """Chunks whose sequence numbers no chunk column can hold."""
    return chunks.withColumn("document_sequence", F.col("document_sequence") + F.lit(1 << 40))


def q_object_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All objects are refined; then every seventh is re-delivered with numbers that do not fit,
    and all are refined again: the table keeps the rows that these objects had."""
    work, target = _new_target(spark, "q-integrity")
    bronze_root, chunks = f"{work}/bronze", _chunks(spark, sf_dir)
    stage_bronze_objects(chunks, bronze_root)
    bronze_to_silver(spark, bronze_root, None, target)
    stage_bronze_objects(_unfit(chunks.where(_extraction_no() % 7 == 0)), bronze_root)
    bronze_to_silver(spark, bronze_root, None, target)
    return telemetry(spark.table(target.table))


def q_reprocess_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every asked key: sound, without decodable documents, not fitting, and missing objects."""
    work, target = _new_target(spark, "q-outcomes")
    bronze_root, chunks = f"{work}/bronze", _chunks(spark, sf_dir)
    stage_bronze_objects(chunks.where(_extraction_no() % 7 != 0), bronze_root)
    stage_bronze_objects(_unfit(chunks.where(_extraction_no() % 7 == 0)), bronze_root)
    number = F.regexp_extract("object_key", "extraction=ext-([0-9]+)/", 1)
    keys = materialize(list_objects(spark, bronze_root), "q-keys")
    asked = keys.unionByName(keys.where(number.cast("long") % 5 == 0).select(F.concat(F.lit("telemetry/extraction=ext-"), number, F.lit("/gone +%25.parquet")).alias("object_key")))
    outcomes = bronze_to_silver(spark, bronze_root, asked, target)
    return outcomes.select(F.regexp_extract("object_key", "extraction=(ext-[0-9]+)/", 1).alias("extraction_id"), "status", "n_documents", "n_records",
                           F.col("error").isNotNull().alias("has_error"))


def q_catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts of a table in a schema of the catalog's own place, and another bucket count between them."""
    records = materialize(records_of(_deliveries(spark, sf_dir)), "q-catalog-records")
    table, location = _new_table(spark, "q-catalog")
    ensure_schemas(spark, location)
    upsert_telemetry(records.where("delivery_seq = 1"), table, location, buckets=8)
    rebucket(spark, table, TABLE_KEY, 4)
    upsert_telemetry(records.where("delivery_seq = 2"), table, location, buckets=4)
    return telemetry(spark.table(table))


def q_redelivered_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of every seventh extraction are notified before they are there; half of them appear before
    the second delivery, the others never: each object's deliveries, last status, and whether it is a dead letter."""
    work, target = _new_target(spark, "q-redelivery")
    bronze_root, feed, redelivery = f"{work}/bronze", f"{work}/notifications", f"{work}/redelivery"
    chunks = _chunks(spark, sf_dir)
    stage_bronze_objects(chunks.where(_extraction_no() % 14 != 7), bronze_root)
    never = chunks.where(_extraction_no() % 14 == 7).select("extraction_id").distinct()
    never = never.select(F.concat(F.lit("telemetry/extraction="), "extraction_id", F.lit("/never.parquet")).alias("object_key"))
    staged = materialize(list_objects(spark, bronze_root), "q-keys")
    late = F.regexp_extract("object_key", "extraction=ext-([0-9]+)/", 1).cast("long") % 14 == 0
    notify(staged.where(late).unionByName(never), feed, files=2)
    _run_stream(spark, feed, f"{work}/nothing-yet", target, work, redelivery_path=redelivery)
    notify(staged.where(~late), feed, files=4)
    _run_stream(spark, feed, bronze_root, target, work, redelivery_path=redelivery)
    for _ in range(MAX_DELIVERIES - 1):  # a batch needs something new in the feed: a notification that names nothing
        spark.range(1).select(F.lit("{}").alias("value")).write.mode("append").text(feed)
        _run_stream(spark, feed, bronze_root, target, work, redelivery_path=redelivery)
    last = (spark.read.parquet(f"{work}/outcomes").groupBy("object_key")
            .agg(F.max("deliveries").alias("deliveries"), F.max_by("status", "deliveries").alias("status")))
    dead = dead_letters(spark, redelivery).select("object_key", F.lit(True).alias("dead"))
    return last.join(dead, "object_key", "left").select(
        F.regexp_extract("object_key", "extraction=(ext-[0-9]+)/", 1).alias("extraction_id"), "deliveries", "status",
        F.coalesce("dead", F.lit(False)).alias("dead"))


def q_notification_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many notifications are valid, empty and malformed."""
    notes = parse_notifications(notification_payloads(read_table(spark, sf_dir, "events")))
    return notes.groupBy(F.col("notification_status").alias("status")).agg(F.count("*").alias("notifications"))


def q_notifications_all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every qualifying record of notifications that name several objects, some by keys with a ``+`` or
    with a percent sign that starts no escape."""
    notes = parse_notifications(notification_records(read_table(spark, sf_dir, "events")))
    return qualifying_objects(notes, all_records=True).select("notification_id", "bucket", "object_key", "correlation_id")


def q_silver_odd_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory values of ids with slashes, backslashes, spaces and colons, and of times in milliseconds."""
    events = read_table(spark, sf_dir, "events")
    return (odd_ids(events).select("event_id", path_safe(F.col("device_id")).alias("device_dir"),
                                   silver_prefix(SILVER_ROOT, F.col("technology"), F.col("device_id")).alias("silver_prefix"),
                                   *date_parts(epoch_millis_to_ntz(F.col("millis")))))


def q_telemetry_by_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded with a stored table of two layouts: the built-in one, and one of a few bits for firmware 136 that
    only documents of one id type have."""
    chunks = _chunks(spark, sf_dir).withColumn("id_type", F.when(F.col("document_sequence") % 3 == 0, "short").when(F.col("document_sequence") % 3 == 1, "long"))
    table = materialize(two_layouts(spark), "q-layouts")
    return telemetry(records_of(chunks, stored_layouts(table)))


def q_decode_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's counts and the number of records as counters of the job that writes the documents."""
    docs, counters = observed_audit(documents_of(_chunks(spark, sf_dir)))
    materialize(docs, "q-counters")
    found = dict(counters.get)
    n_records = found.pop("n_records")
    return spark.createDataFrame([(k, n, n_records) for k, n in found.items() if n], "decode_reason string, documents long, n_records long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "notifications_qualified": q_notifications_qualified,
    "technology_resolved": q_technology_resolved,
    "documents_reassembled": q_documents_reassembled,
    "telemetry_decoded": q_telemetry_decoded,
    "decode_audit": q_decode_audit,
    "silver_day_counts": q_silver_day_counts,
    "silver_prefixes": q_silver_prefixes,
    "last_delivery_wins": q_last_delivery_wins,
    "telemetry_upserted": q_telemetry_upserted,
    "object_outcomes": q_object_outcomes,
    "silver_roundtrip": q_silver_roundtrip,
    "stream_availablenow": q_stream_availablenow,
    "upsert_after_interruption": q_upsert_after_interruption,
    "silver_redelivered": q_silver_redelivered,
    "object_integrity": q_object_integrity,
    "reprocess_outcomes": q_reprocess_outcomes,
    "catalog_roundtrip": q_catalog_roundtrip,
    "redelivered_objects": q_redelivered_objects,
    "notification_audit": q_notification_audit,
    "notifications_all_records": q_notifications_all_records,
    "silver_odd_ids": q_silver_odd_ids,
    "telemetry_by_layouts": q_telemetry_by_layouts,
    "decode_counters": q_decode_counters,
}
