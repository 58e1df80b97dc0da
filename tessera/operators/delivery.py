"""Batch form of "each delivery replaces the previous one"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTION_KEY = ["technology", "device_id", "extraction_id"]


def delivery_order(records: DataFrame) -> str:
    """Column that orders deliveries: an explicit ``delivery_seq`` if present, else
    (object modification time, object key)."""
    return "delivery_seq" if "delivery_seq" in records.columns else "delivery_rank"


def with_delivery_rank(records: DataFrame) -> DataFrame:
    if "delivery_seq" in records.columns or "delivery_rank" in records.columns:
        return records
    return records.withColumn("delivery_rank", F.struct("delivery_time", "object_key"))


def last_delivery_wins(records: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Keep only the records of the latest delivery of every extraction.

    Applied to *decoded* records, so a delivery that yields nothing does not
    compete (as in sequential processing, where an empty delivery writes and
    deletes nothing).

    The records first collapse to one row per delivery (a hash aggregate with
    map-side partial aggregation, so a hot extraction shrinks to a few rows per
    task before the shuffle); the ``max`` per extraction then runs on that small
    set (the delivery order may hold a string, which Spark cannot keep in a hash
    aggregation buffer). The winners are applied with a left-semi join: AQE turns
    it into a broadcast when they are small at runtime, and otherwise splits a
    skewed partition of the records side. No window puts a whole extraction into
    one task.
    """
    key = key or EXTRACTION_KEY
    ranked = with_delivery_rank(records)
    order = delivery_order(ranked)
    deliveries = ranked.select(*key, order).distinct()
    winners = deliveries.groupBy(*key).agg(F.max(order).alias(order))
    return ranked.join(winners, on=key + [order], how="left_semi")
