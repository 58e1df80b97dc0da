"""Correct the reported device technology from the MAC prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import mac_prefix

# MAC prefix (OUI) to technology, the technologies the decoders
# know, and the default for everything else.
MAC_PREFIX_TECHNOLOGY = {
    "001BC5": "ImberaLink",
    "B4A2EB": "ImberaLink",
    "3CA551": "ELTEC",
    "00E44C": "ELTEC",
    "F412FA": "ELTEC",
    "7CDFA1": "ELTEC",
    "4827E2": "ELTEC",
}
KNOWN_TECHNOLOGIES = ["ImberaLink", "ELTEC", "Villa"]
DEFAULT_TECHNOLOGY = "ImberaLink"


def resolved_technology(device_id: Column, reported: Column,
                        prefixes: dict[str, str] | None = None) -> Column:
    """MAC prefix wins; else the reported value if it is a known technology; else the default.

    The prefix table is a literal map (a few entries), so the lookup is a plain
    projection inside whole-stage codegen: no join, no shuffle, no broadcast.
    """
    table = prefixes if prefixes is not None else MAC_PREFIX_TECHNOLOGY
    lookup = F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])
    by_mac = F.try_element_at(lookup, mac_prefix(device_id))
    return F.coalesce(by_mac, F.when(reported.isin(KNOWN_TECHNOLOGIES), reported),
                      F.lit(DEFAULT_TECHNOLOGY))


def resolve_technology(documents: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Replace ``technology`` by the resolved one; the raw value stays as ``reported_technology``."""
    return (documents
            .withColumn("reported_technology", F.col("technology"))
            .withColumn("technology", resolved_technology(F.col("id_controller"), F.col("technology"),
                                                          prefixes)))
