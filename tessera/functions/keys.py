"""Object-key expressions: URL decoding and the correlation id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Hive-style segment that carries the extraction id in a Bronze key.
EXTRACTION_SEGMENT = r"extraction_id=([^/]+)/"


def decoded_key(key: Column) -> Column:
    """URL-decode an object key; a missing key decodes to ''.

    ``+`` becomes a space (form decoding). Broken percent escapes give NULL instead
    of failing the whole batch.
    """
    return F.try_url_decode(F.coalesce(key, F.lit("")))


def correlation_id(key: Column) -> Column:
    """First ``extraction_id=<id>/`` segment of a key, else the whole key."""
    return F.coalesce(F.nullif(F.regexp_extract(key, EXTRACTION_SEGMENT, 1), F.lit("")), key)
