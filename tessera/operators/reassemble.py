"""Glue the hex chunks of each document back together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.schemas import DOCUMENT_KEYS

# Object-level columns that travel with a document when present (each is constant
# within one object, so grouping by them does not split a document).
OBJECT_COLUMNS = ["object_key", "delivery_time", "delivery_seq"]

_ORDERED_CONCAT = "listagg(data_chunk_hex, '') WITHIN GROUP (ORDER BY chunk_index ASC NULLS LAST)"


def reassemble(chunks: DataFrame) -> DataFrame:
    """One row per document with ``payload_hex`` = its chunks in ``chunk_index`` order.

    Grouped by the seven document columns *and* the object the chunks came from,
    so two deliveries of one extraction never mix. Null chunks are skipped, a
    document with only null chunks gets a NULL payload, null-index chunks go
    last, null keys group together. ``document_sequence`` null reads as 0.

    The group key is the full document identity, so one hot extraction or device
    spreads over many shuffle partitions; the aggregate plans as a partial
    (map-side) plus final ObjectHashAggregate with one shuffle.
    """
    keys = DOCUMENT_KEYS + [c for c in OBJECT_COLUMNS if c in chunks.columns]
    docs = chunks.groupBy(*keys).agg(F.expr(_ORDERED_CONCAT).alias("payload_hex"))
    return docs.withColumn("document_sequence", F.coalesce(F.col("document_sequence"), F.lit(0)))
