"""Device-id and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading/trailing characters that count as blank: Java whitespace plus Unicode
# space, line and paragraph separators.
_EDGE_BLANKS = r"^[\p{javaWhitespace}\p{Z}]+|[\p{javaWhitespace}\p{Z}]+$"


def mac_prefix(device_id: Column) -> Column:
    """First six hex digits of a MAC address, separators ':' and '-' removed, upper case."""
    return F.upper(F.substring(F.translate(device_id, ":-", ""), 1, 6))


def path_safe(value: Column) -> Column:
    """Make a value usable as one path segment.

    Trim; blank becomes ``unknown``; ``/``, ``\\`` and space become ``_``; ``:`` is
    dropped (after the blank test, so ``':'`` gives an empty segment).
    """
    trimmed = F.regexp_replace(value, _EDGE_BLANKS, "")
    return (F.when(trimmed.isNull() | (trimmed == ""), F.lit("unknown"))
            .otherwise(F.translate(trimmed, "/\\ :", "___")))


def silver_prefix(root: str, technology: Column, device_id: Column) -> Column:
    """``<root>/telemetry/technology=<t>/device_id=<d>/`` with sanitized segments."""
    base = root.rstrip("/")
    return F.concat(F.lit(f"{base}/telemetry/technology="), path_safe(technology),
                    F.lit("/device_id="), path_safe(device_id), F.lit("/"))
