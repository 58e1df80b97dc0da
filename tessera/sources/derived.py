"""Bronze-shaped inputs derived from the ``events`` table, so every scale factor has them.

One event is one document; one user is one device and one extraction. The mix
covers every known MAC prefix (plain, and in lower case with separators) plus
unknown ones, null ids, null and placeholder technologies, unsupported firmware,
missing, short and non-hex payloads, and documents of one chunk without an index or
of two or three chunks, the last one first. Everything is a projection/generator over ``events`` (no joins), so
it grows with the table and partitions like it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.time import epoch_seconds_of
from tessera.operators.decode import LAYOUT, PAYLOAD_FIELDS

# Fixed values of the derived fixture: device MAC prefixes chosen by user_id % 9
# (the seven known prefixes, then two unknown ones) and the low payload byte
# chosen by event_id % 8.
FIXTURE_PREFIXES = ["001BC5", "B4A2EB", "3CA551", "00E44C", "F412FA", "7CDFA1", "4827E2", "AABBCC", "DDEEFF"]
FIXTURE_LOW_BYTES = ["00", "80", "20", "a0", "08", "88", "28", "a8"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def bronze_chunks(events: DataFrame) -> DataFrame:
    """Chunk rows in the Bronze schema (FIXTURES 5.1)."""
    uid, eid = F.col("user_id"), F.col("event_id")
    mac = F.concat(_pick(FIXTURE_PREFIXES, uid % 9), F.lpad(F.hex(uid), 6, "0"))
    pairs = F.array(*[F.lower(F.substring(mac, i, 2)) for i in range(1, 13, 2)])
    whole = F.concat(F.lpad(F.lower(F.hex(epoch_seconds_of(F.col("ts")))), 8, "0"),
                     F.when(eid % 2 == 1, "08").otherwise("00"), _pick(FIXTURE_LOW_BYTES, eid % 8))
    docs = events.select(
        F.concat(F.lit("ext-"), uid.cast("string")).alias("extraction_id"),
        F.when(eid % 31 == 30, F.lit(None).cast("string")).when(uid % 5 == 1, F.array_join(pairs, ":"))
         .when(uid % 5 == 2, F.array_join(pairs, "-")).otherwise(mac).alias("id_controller"),
        F.when(uid % 4 == 0, "Softel").when(uid % 4 == 1, "ELTEC").when(uid % 4 == 2, "Villa")
         .alias("technology"),
        F.lit(None).cast("string").alias("id_type"),
        F.when(eid % 10 == 0, "136").when(eid % 10 == 1, "not-a-number").otherwise("126")
         .alias("ble_version"),
        eid.cast("int").alias("document_sequence"),
        F.when(eid % 17 == 0, F.lit(None).cast("string")).otherwise(F.lit("EVENTS")).alias("type"),
        F.when(eid % 13 == 12, F.lit(None).cast("string")).when(eid % 19 == 18, F.concat(F.lit("zz"), F.substring(whole, 3, 100)))
         .when(eid % 23 == 22, F.substring(whole, 1, 10)).otherwise(whole).alias("payload"),
        (eid % 41 == 40).alias("one"), (eid % 3 == 0).alias("three"),
    )
    # A typed document becomes two or three chunks, the last one first, or one without
    # an index; a START/END-like row stays one row with null index and data.
    parts = (F.when(F.col("type").isNull() | F.col("one"), F.array(F.lit(0)))
             .when(F.col("three"), F.array(F.lit(2), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(0))))
    chunked = docs.select("*", F.explode(parts).alias("part"))
    return chunked.select(
        "extraction_id", "id_controller", "technology", "id_type", "ble_version",
        "document_sequence", "type",
        F.when(F.col("type").isNotNull() & ~F.col("one"), F.col("part")).cast("int").alias("chunk_index"),
        F.when(F.col("type").isNull(), F.lit(None).cast("string"))
         .when(F.col("one"), F.col("payload"))
         .when(F.col("part") == 0, F.substring("payload", 1, 4))
         .when(F.col("part") == 2, F.expr("substr(payload, 9)"))
         .when(F.col("three"), F.substring("payload", 5, 4))
         .otherwise(F.expr("substr(payload, 5)")).alias("data_chunk_hex"),
    )


def bronze_deliveries(chunks: DataFrame) -> DataFrame:
    """Chunks with ``delivery_seq`` and ``object_key`` (FIXTURES 5.2).

    Extractions with id % 3 = 0 get a smaller second delivery that replaces the
    first; id % 3 = 1 get a payload-less second delivery that replaces nothing.
    The first and the smaller second delivery come from one scan (each chunk row
    is exploded into its delivery copies); only the payload-less delivery, one
    row per extraction, needs its own (distinct) branch.
    """
    ext_no = F.substring("extraction_id", 5, 100).cast("int")

    def key(seq: F.Column) -> F.Column:
        return F.concat(F.lit("telemetry/extraction_id="), F.col("extraction_id"),
                        F.lit("/d"), seq.cast("string"), F.lit(".parquet"))

    copies = F.when((ext_no % 3 == 0) & (F.col("document_sequence") % 2 == 0),
                    F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    delivered = (chunks.select("*", F.explode(copies).alias("delivery_seq"))
                 .withColumn("object_key", key(F.col("delivery_seq"))))
    empty = (chunks.where(ext_no % 3 == 1)
             .select("extraction_id", "id_controller", "technology", "id_type").distinct()
             .select("extraction_id", "id_controller", "technology", "id_type",
                     F.lit("126").alias("ble_version"), F.lit(0).alias("document_sequence"),
                     F.lit(None).cast("string").alias("type"), F.lit(None).cast("int").alias("chunk_index"),
                     F.lit(None).cast("string").alias("data_chunk_hex"),
                     F.lit(2).alias("delivery_seq"), key(F.lit(2)).alias("object_key")))
    return delivered.unionByName(empty)


def notification_payloads(events: DataFrame) -> DataFrame:
    """Notification JSON text, one per event (FIXTURES 5.3).

    Includes malformed text, ``{}``, a non-qualifying first record, removals,
    non-telemetry keys, metadata files and URL-encoded keys.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    body = F.concat(
        F.lit('{"EventName":"x","Records":[{"eventName":"s3:ObjectRemoved:Delete","s3":{"bucket":'
              '{"name":"bronze"},"object":{"key":"telemetry%2Fgone.parquet"}}},{"eventName":"'),
        F.when(eid % 5 == 0, "s3:ObjectRemoved:Delete").otherwise("s3:ObjectCreated:Put"),
        F.lit('","s3":{"bucket":{"name":"bronze"},"object":{"size":5,"key":"'),
        F.when(eid % 7 == 0, "other").otherwise("telemetry"),
        F.lit("%2Fdevice%3D"), uid.cast("string"),
        F.when(eid % 3 == 0, "").otherwise(F.concat(F.lit("%2Fextraction_id%3Dext-"), uid.cast("string"))),
        F.lit("%2Ffile"),
        F.when(eid % 11 == 0, ".metadata.json").otherwise(".parquet"),
        F.lit('"}}}]}'),
    )
    payload = F.when(eid % 23 == 0, "not json").when(eid % 29 == 0, "{}").otherwise(body)
    return events.select(eid.alias("notification_id"), payload.alias("payload"))


def notification_records(events: DataFrame) -> DataFrame:
    """Notification JSON text of several records, one per event: a removal, a key with ``+``, a key with
    a broken escape, and one that qualifies for every second event; every seventh list is empty."""
    eid, uid = F.col("event_id"), F.col("user_id").cast("string")

    def record(event: str, *key: F.Column) -> F.Column:
        return F.concat(F.lit(f'{{"eventName":"{event}","s3":{{"bucket":{{"name":"bronze"}},"object":{{"key":"'), *key, F.lit('"}}}'))

    records = F.concat_ws(",", record("s3:ObjectRemoved:Delete", F.lit("telemetry%2Fgone.parquet")),
                          record("s3:ObjectCreated:Put", F.lit("telemetry%2Fdevice%3D"), uid, F.lit("%2Fa+b%2Ffile.parquet")),
                          record("s3:ObjectCreated:Copy", F.lit("telemetry%2F100%zz.parquet")),
                          record("s3:ObjectCreated:Put", F.lit("telemetry%2Fextraction_id%3Dext-"), uid, F.lit("%2Ffile"),
                                 F.when(eid % 2 == 0, ".parquet").otherwise(".metadata.json")))
    return events.select(eid.alias("notification_id"),
                         F.concat(F.lit('{"Records":['), F.when(eid % 7 == 0, "").otherwise(records), F.lit("]}")).alias("payload"))


def odd_ids(events: DataFrame) -> DataFrame:
    """Device ids and technologies with characters that no directory may have, and times in milliseconds."""
    eid, uid = F.col("event_id"), F.col("user_id").cast("string")
    device = (F.when(eid % 6 == 0, F.concat(F.lit("a/"), uid)).when(eid % 6 == 1, F.concat(F.lit("a\\"), uid)).when(eid % 6 == 2, F.concat(F.lit("a b"), uid))
              .when(eid % 6 == 3, F.concat(F.lit(" a:"), uid, F.lit(" "))).when(eid % 6 == 4, "  "))
    return events.select("event_id", device.alias("device_id"), F.when(eid % 3 == 0, "Imbera Link").when(eid % 3 == 1, ":").otherwise("EL/TEC").alias("technology"),
                         (epoch_seconds_of(F.col("ts")) * 1000 + eid % 1000).alias("millis"))


#: Fixed values of the derived fixture: a second payload layout, of firmware 136 and one id type.
FIXTURE_LAYOUT = [("ImberaLink", "136", "short", "EVENTS", 6, "mode", 35, 3), ("ImberaLink", "136", "short", "EVENTS", 6, "level", 40, 8)]


def two_layouts(spark: SparkSession) -> DataFrame:
    """A table of payload layouts: the built-in ones and ``FIXTURE_LAYOUT``."""
    return spark.createDataFrame([(*r[:2], None, *r[2:]) for r in PAYLOAD_FIELDS] + FIXTURE_LAYOUT, LAYOUT)
