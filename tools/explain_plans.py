"""Write the formatted physical plan of every read-only registered query to PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
Queries that write (sinks, stream) are skipped: explaining them would run the writes.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402

WRITERS = {"telemetry_upserted", "silver_roundtrip", "stream_availablenow", "upsert_after_interruption", "silver_redelivered", "object_integrity",
           "reprocess_outcomes", "catalog_roundtrip", "redelivered_objects", "decode_counters"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    parts = ["# Physical plans\n",
             f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf_dir)}` (initial adaptive plans; "
             "AQE may still switch a shuffle join to broadcast or coalesce partitions at runtime).\n"]
    for name, query in QUERIES.items():
        if name in WRITERS:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            query(spark, sf_dir).explain("formatted")
        parts.append(f"## {name}\n\n```\n{buf.getvalue().strip()}\n```\n")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
