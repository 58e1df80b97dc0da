"""B2: bucket notifications (JSON text) to nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import NOTIFICATION

#: Where ``from_json`` puts a text that it cannot parse.
CORRUPT = "_corrupt_record"
_PARSED = T.StructType([*NOTIFICATION.fields, T.StructField(CORRUPT, T.StringType(), True)])


def parse_notifications(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``notification`` (struct with ``Records``) parsed from the JSON text column, and
    ``notification_status``.

    Unknown keys are ignored. ``malformed``: the text is no JSON of a notification's shape;
    ``empty``: it names no record (``{}``, an empty text or list, null); else ``valid``.
    Only valid ones have records, so the others drop out at qualification without failing
    the batch.
    """
    parsed = F.from_json(F.col(payload), _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    blank = F.coalesce(F.trim(F.col(payload)) == "", F.lit(True))
    records = F.coalesce(F.size("notification.Records"), F.lit(-1))
    return (df.withColumn("notification", parsed)
            .withColumn("notification_status", F.when(~blank & F.col(f"notification.{CORRUPT}").isNotNull(), "malformed")
                        .when(blank | (records <= 0), "empty").otherwise("valid")))


def rejected_notifications(notifications: DataFrame, payload: str = "payload") -> DataFrame:
    """The texts of malformed notifications, of those that ``parse_notifications`` has parsed."""
    return notifications.where("notification_status = 'malformed'").select(payload)
