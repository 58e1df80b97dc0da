"""Inputs: Bronze objects, notification payloads, and fixtures derived from ``events``."""

from tessera.sources.bronze import keys_table, list_objects, read_bronze, read_objects
from tessera.sources.derived import bronze_chunks, bronze_deliveries, notification_payloads, notification_records, odd_ids, read_table, two_layouts
from tessera.sources.notifications import parse_notifications, rejected_notifications

__all__ = ["keys_table", "list_objects", "read_bronze", "read_objects", "bronze_chunks", "bronze_deliveries",
           "notification_payloads", "notification_records", "odd_ids", "read_table", "two_layouts", "parse_notifications", "rejected_notifications"]
