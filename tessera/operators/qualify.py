"""B3 (+B4, B5a): pick the object a notification asks us to process."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import correlation_id, decoded_key

# What makes a notification record worth processing.
CREATED_EVENT_PREFIX = "s3:ObjectCreated:"
KEY_MARKER = "telemetry/"
KEY_SUFFIX = ".parquet"


def _qualifies(record: Column) -> Column:
    key = decoded_key(record["s3"]["object"]["key"])
    return (record["eventName"].startswith(CREATED_EVENT_PREFIX)
            & key.contains(KEY_MARKER) & key.endswith(KEY_SUFFIX))


def qualifying_objects(notifications: DataFrame, all_records: bool = False) -> DataFrame:
    """Rows of parsed notifications that name a Bronze telemetry object.

    Adds ``bucket``, ``object_key`` (URL-decoded) and ``correlation_id``. By
    default only the first qualifying record of a notification counts and a
    notification without one gives no row; ``all_records=True`` keeps every
    qualifying record. Input needs the ``notification`` struct of
    ``parse_notifications``.
    """
    hits = F.filter(F.col("notification.Records"), _qualifies)
    if all_records:
        picked = notifications.select("*", F.explode(hits).alias("_record"))
    else:
        picked = notifications.select("*", F.get(hits, 0).alias("_record")).where(F.col("_record").isNotNull())
    key = decoded_key(F.col("_record.s3.object.key"))
    return (picked
            .withColumn("bucket", F.col("_record.s3.bucket.name"))
            .withColumn("object_key", key)
            .withColumn("correlation_id", correlation_id(key))
            .drop("_record"))
