"""Decoder dispatch, bit-field decoding, flattening, audit and envelope.

A decoder is data, not code: each decodable (technology, firmware, id type, document
type) has one row per output field, in ``PAYLOAD_FIELDS`` or in a stored table
(``stored_layouts``). Joining documents to that table *is* both the dispatch (no matching
layout -> no rows) and the flattening (one joined row per field). The field value and
sample time are bit slices of the hex payload, computed with built-in expressions.

The constant layouts are broadcast, stored ones where they are counted and few; the join is
then a BroadcastHashJoin on the dispatch columns and never shuffles the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import epoch_seconds_to_ntz
from tessera.operators.technology import resolved_technology

# The firmware-126 EVENTS layout. Six bytes, big-endian; bits are
# counted from the most significant bit of byte 0. Bits 0-31 hold the sample time
# in epoch seconds.
# (technology, firmware, type, payload_bytes, field, bit_offset, bit_width)
PAYLOAD_FIELDS = [
    ("ImberaLink", "126", "EVENTS", 6, "door_state", 36, 1),
    ("ImberaLink", "126", "EVENTS", 6, "compressor_state", 40, 1),
    ("ImberaLink", "126", "EVENTS", 6, "fan_state", 42, 1),
    ("ImberaLink", "126", "EVENTS", 6, "buzzer_state", 44, 1),
]
TIME_BIT_OFFSET, TIME_BIT_WIDTH = 0, 32

#: A stored layout table: ``id_type`` null means any.
LAYOUT = T.StructType([
    T.StructField("technology", T.StringType()),
    T.StructField("firmware", T.StringType()),
    T.StructField("id_type", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("payload_bytes", T.IntegerType()),
    T.StructField("field", T.StringType()),
    T.StructField("bit_offset", T.IntegerType()),
    T.StructField("bit_width", T.IntegerType()),
])
DISPATCH = ["technology", "firmware", "id_type", "type"]
#: Widest slice that a long holds exactly as read, and the most layout rows that are broadcast.
MAX_BITS, BROADCAST_ROWS = 60, 100_000

AUDIT_REASONS = ["no_id", "no_type", "no_payload", "no_layout", "bad_payload", "ok"]


@dataclass
class Layouts:
    """One row per field, and one per layout with its payload size and field count; columns ``l_*``."""

    fields: DataFrame
    heads: DataFrame


def _inline_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A constant table as a JVM-side inline relation (no Python RDD, no Python worker)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f"l_{f.name}") for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def constant_layouts(spark: SparkSession, rows=None) -> Layouts:
    """Layouts given as tuples like those of ``PAYLOAD_FIELDS``."""
    rows = [(*r[:2], None, *r[2:]) for r in rows or PAYLOAD_FIELDS]
    heads = list(dict.fromkeys(r[:5] for r in rows))
    schema = T.StructType([*LAYOUT.fields[:5], T.StructField("fields", T.IntegerType())])
    return Layouts(F.broadcast(_inline_table(spark, rows, LAYOUT)),
                   F.broadcast(_inline_table(spark, [(*h, sum(r[:5] == h for r in rows)) for h in heads], schema)))


def layout_faults(table: DataFrame) -> DataFrame:
    """``fault`` of each row of a layout table that has one: what is missing, bits outside the payload, bits
    that the sample time or another field holds, and a layout beside one for any id type."""
    end = F.col("bit_offset") + F.col("bit_width")
    layout = Window.partitionBy(*DISPATCH)
    before = layout.orderBy("bit_offset", "bit_width", "field").rowsBetween(Window.unboundedPreceding, -1)
    anyone = Window.partitionBy("technology", "firmware", "type")
    needed = [c for c in LAYOUT.fieldNames() if c != "id_type"]
    return (table.withColumn("_end", end)
            .withColumn("_before", F.max("_end").over(before))
            .withColumn("_sizes", F.size(F.collect_set("payload_bytes").over(layout)))
            .withColumn("_any", F.max(F.col("id_type").isNull().cast("int")).over(anyone) + F.max(F.col("id_type").isNotNull().cast("int")).over(anyone))
            .withColumn("_same", F.count("*").over(Window.partitionBy(*DISPATCH, "field")))
            .withColumn("fault", F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in needed]) == 1, "a column is null")
                        .when(~F.col("bit_width").between(1, MAX_BITS), f"the width is not 1 to {MAX_BITS} bits")
                        .when((F.col("bit_offset") < 0) | (F.col("_end") > F.col("payload_bytes") * 8), "bits outside the payload")
                        .when(F.col("bit_offset") < TIME_BIT_OFFSET + TIME_BIT_WIDTH, "bits of the sample time")
                        .when(F.col("_before") > F.col("bit_offset"), "bits of another field")
                        .when(F.col("_sizes") > 1, "payload sizes differ")
                        .when(F.col("_same") > 1, "the field occurs twice")
                        .when(F.col("_any") > 1, "layouts for any and for one id type"))
            .where("fault IS NOT NULL").select(*LAYOUT.fieldNames(), "fault"))


def stored_layouts(table: DataFrame) -> Layouts:
    """Layouts from a table with the columns of ``LAYOUT``; one with faults is refused (``ValueError``).

    Broadcast where it has at most ``BROADCAST_ROWS`` rows; a larger one is joined as Spark sees fit.
    """
    table = table.select(*[F.col(f.name).cast(f.dataType) for f in LAYOUT])
    faults = layout_faults(table).limit(5).collect()
    if faults:
        raise ValueError("; ".join(f"{r['technology']}/{r['firmware']}/{r['id_type']}/{r['type']}.{r['field']}: {r['fault']}" for r in faults))
    hint = F.broadcast if table.count() <= BROADCAST_ROWS else (lambda df: df)
    named = table.select(*[F.col(c).alias(f"l_{c}") for c in LAYOUT.fieldNames()])
    heads = named.groupBy(*[f"l_{c}" for c in DISPATCH], "l_payload_bytes").agg(F.count("*").cast("int").alias("l_fields"))
    return Layouts(hint(named), hint(heads))


def layouts_of(spark: SparkSession, fields) -> Layouts:
    return fields if isinstance(fields, Layouts) else constant_layouts(spark, fields)


def _dispatch_condition(docs: DataFrame, layout: DataFrame, technology: Column | None = None) -> Column:
    return (((docs["technology"] if technology is None else technology) == layout["l_technology"])
            & (docs["ble_version"] == layout["l_firmware"])
            & (docs["type"] == layout["l_type"])
            & (layout["l_id_type"].isNull() | (docs["id_type"] == layout["l_id_type"])))


def _well_formed(payload: Column, payload_bytes: Column) -> Column:
    """Hex digits only and exactly the layout's length (``conv`` would read junk as 0)."""
    return payload.rlike("\\A[0-9a-fA-F]+\\z") & (F.length(payload) == payload_bytes * 2)


def bit_slice(payload: str, offset: str, width: str) -> Column:
    """Unsigned integer in bits [offset, offset+width) of a hex string (MSB first).

    Only the hex digits covering the slice are converted, so payloads of any
    length work; widths up to 60 bits fit a long.
    """
    first = f"(div({offset}, 4) + 1)"
    last = f"(div({offset} + {width} - 1, 4) + 1)"
    digits = f"substr({payload}, {first}, {last} - {first} + 1)"
    return F.expr(
        f"shiftright(cast(conv({digits}, 16, 10) as bigint), {last} * 4 - ({offset} + {width}))"
        f" & (shiftleft(1L, {width}) - 1)")


def decodable(documents: DataFrame) -> DataFrame:
    """Documents that can carry a sample at all (typed, with payload and ids)."""
    return documents.where(F.col("type").isNotNull() & F.col("payload_hex").isNotNull()
                           & F.col("extraction_id").isNotNull() & F.col("id_controller").isNotNull())


def decodable_chunks(chunks: DataFrame, fields=None) -> DataFrame:
    """Chunks of documents that some layout can decode, by their header columns.

    All columns that choose a layout are part of the document key, so the others can
    be left out before the reassembly shuffle wherever no audit of them is wanted.
    """
    heads = layouts_of(chunks.sparkSession, fields).heads
    typed = chunks.where(F.col("type").isNotNull() & F.col("extraction_id").isNotNull() & F.col("id_controller").isNotNull())
    technology = resolved_technology(F.col("id_controller"), F.col("technology"))
    return typed.join(heads, _dispatch_condition(typed, heads, technology), "left_semi")


def decode_records(documents: DataFrame, fields=None) -> DataFrame:
    """B7+B8+B9+B11: decoded documents as flat records.

    Input: documents with resolved ``technology``. Output: ``name``, ``value``
    (double), ``timestamp`` (zone-less) and the envelope ``technology``,
    ``device_id`` (raw controller id), ``extraction_id``, plus ``document_sequence``
    and any object columns (``object_key``, ``delivery_time``, ``delivery_seq``)
    for replacement and outcome reporting. Documents with no layout or a
    malformed payload yield no rows (see ``decode_audit``). Documents that have a
    ``decode_reason`` already are not tested again.
    """
    layouts = layouts_of(documents.sparkSession, fields)
    if "decode_reason" in documents.columns:
        well_formed = documents.where("decode_reason = 'ok'")
    else:
        # The header join tests each document once; the fields of its layout come after it.
        docs, heads = decodable(documents), layouts.heads
        well_formed = (docs.join(heads, _dispatch_condition(docs, heads), "inner")
                       .where(_well_formed(F.col("payload_hex"), F.col("l_payload_bytes"))).drop(*heads.columns))
    joined = well_formed.join(layouts.fields, _dispatch_condition(well_formed, layouts.fields), "inner")
    carried = [c for c in ("object_key", "delivery_time", "delivery_seq") if c in documents.columns]
    return joined.select(
        F.col("l_field").alias("name"),
        bit_slice("payload_hex", "l_bit_offset", "l_bit_width").cast("double").alias("value"),
        epoch_seconds_to_ntz(bit_slice("payload_hex", str(TIME_BIT_OFFSET), str(TIME_BIT_WIDTH)))
        .alias("timestamp"),
        "technology",
        F.col("id_controller").alias("device_id"),
        "extraction_id",
        "document_sequence",
        *carried,
    )


def telemetry(records: DataFrame) -> DataFrame:
    """The six columns of the Silver table."""
    return records.select("name", "value", "timestamp", "technology", "device_id", "extraction_id")


def audit_reason(documents: DataFrame, fields=None) -> DataFrame:
    """Why each document does or does not decode (``decode_reason``), and how
    many records it decodes to (``decoded_fields``: the layout's field count when
    ``ok``, else 0), without decoding it. Documents that were audited stay as they are."""
    if "decode_reason" in documents.columns:
        return documents
    heads = layouts_of(documents.sparkSession, fields).heads
    joined = documents.join(heads, _dispatch_condition(documents, heads), "left")
    reason = (F.when(F.col("extraction_id").isNull() | F.col("id_controller").isNull(), "no_id")
              .when(F.col("type").isNull(), "no_type")
              .when(F.col("payload_hex").isNull(), "no_payload")
              .when(F.col("l_technology").isNull(), "no_layout")
              .when(~_well_formed(F.col("payload_hex"), F.col("l_payload_bytes")), "bad_payload")
              .otherwise("ok"))
    return joined.select(*documents.columns, reason.alias("decode_reason"),
                         F.when(reason == "ok", F.col("l_fields")).otherwise(F.lit(0)).alias("decoded_fields"))


def decode_audit(documents: DataFrame, fields=None) -> DataFrame:
    """Count of documents per decode reason (map-side partial count, one tiny shuffle)."""
    return (audit_reason(documents, fields)
            .groupBy("decode_reason").agg(F.count(F.lit(1)).alias("documents")))


def observed_audit(documents: DataFrame, fields=None) -> tuple[DataFrame, Observation]:
    """Audited documents, and counters that fill while the first action on them runs: documents by reason
    (``AUDIT_REASONS``), and ``n_records``. No job of their own, and no shuffle."""
    counters = Observation()
    reason = F.col("decode_reason")
    audited = audit_reason(documents, fields)
    return audited.observe(counters, *[F.count_if(reason == r).alias(r) for r in AUDIT_REASONS],
                           F.coalesce(F.sum("decoded_fields"), F.lit(0)).alias("n_records")), counters
