"""Explicit schemas of every table the pipeline reads or writes (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of a Bronze chunk object, in the order the ingestion side writes them.
BRONZE_CHUNKS = T.StructType([
    T.StructField("extraction_id", T.StringType(), True),
    T.StructField("id_controller", T.StringType(), True),
    T.StructField("technology", T.StringType(), True),
    T.StructField("id_type", T.StringType(), True),
    T.StructField("ble_version", T.StringType(), True),
    T.StructField("document_sequence", T.IntegerType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("chunk_index", T.IntegerType(), True),
    T.StructField("data_chunk_hex", T.StringType(), True),
])

# The seven columns that identify one document inside one object.
DOCUMENT_KEYS = ["extraction_id", "id_controller", "technology", "id_type",
                 "ble_version", "document_sequence", "type"]

# Bucket notification payload; unknown keys are ignored, every field may be missing.
NOTIFICATION = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("eventName", T.StringType(), True),
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType(), True)]), True),
            T.StructField("object", T.StructType([T.StructField("key", T.StringType(), True)]), True),
        ]), True),
    ])), True),
])

# Decoded records as the Silver table holds them.
TELEMETRY_COLUMNS = ["name", "value", "timestamp", "technology", "device_id", "extraction_id"]
TELEMETRY = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("technology", T.StringType(), True),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("extraction_id", T.StringType(), True),
])

# Documents that yield no records, with the reason.
REJECT_COLUMNS = ["extraction_id", "id_controller", "document_sequence", "technology", "ble_version", "type", "object_key", "decode_reason"]
REJECTS = T.StructType([T.StructField(c, T.IntegerType() if c == "document_sequence" else T.StringType(), True) for c in REJECT_COLUMNS])

# Silver files: raw envelope values are kept as data columns, the sanitized ones
# become the Hive partition directories.
SILVER_PARTITIONS = ["technology", "device_id", "year", "month", "day", "extraction_id"]
SILVER_FILE = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("source_technology", T.StringType(), True),
    T.StructField("source_device_id", T.StringType(), True),
    T.StructField("source_extraction_id", T.StringType(), True),
    T.StructField("technology", T.StringType(), True),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("extraction_id", T.StringType(), True),
])
