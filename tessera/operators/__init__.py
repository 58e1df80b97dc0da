"""DataFrame -> DataFrame operators of the Bronze-to-Silver refinement."""

from tessera.operators.decode import (audit_reason, decodable, decode_audit, decodable_chunks, decode_records,
                                      observed_audit, stored_layouts, telemetry)
from tessera.operators.delivery import last_delivery_wins
from tessera.operators.outcomes import object_outcomes
from tessera.operators.qualify import qualifying_objects
from tessera.operators.reassemble import reassemble
from tessera.operators.technology import resolve_technology, resolved_technology

__all__ = [
    "audit_reason", "decodable", "decodable_chunks", "decode_audit", "decode_records", "observed_audit", "stored_layouts", "telemetry",
    "last_delivery_wins", "object_outcomes", "qualifying_objects", "reassemble",
    "resolve_technology", "resolved_technology",
]
