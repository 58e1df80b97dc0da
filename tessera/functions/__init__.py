"""Column functions (pure JVM expressions, codegen-friendly, no Python UDFs)."""

from tessera.functions.keys import correlation_id, decoded_key
from tessera.functions.device import mac_prefix, path_safe, silver_prefix
from tessera.functions.time import date_parts, epoch_millis_to_ntz, epoch_seconds_to_ntz

__all__ = [
    "correlation_id", "decoded_key", "mac_prefix", "path_safe", "silver_prefix",
    "date_parts", "epoch_millis_to_ntz", "epoch_seconds_to_ntz",
]
