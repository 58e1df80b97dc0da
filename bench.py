"""Benchmark: wall time of every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is produced,
nothing is collected to the driver). Queries with a sink (files, table, stream)
include their writes. Timed runs follow an untimed warm-up pass over every query
on the smallest tables. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", app_name="tessera-bench", shuffle_partitions=cpus)
    # Untimed warm-up: every query once on the smallest tables, so JIT and codegen
    # warm-up (a one-time cost per application) is not charged to whichever query
    # happens to run first. Set BENCH_WARMUP=0 to time cold runs.
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm = os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warmup_dir)
    if warm:
        for name, query in QUERIES.items():
            if not only or name in only:
                query(spark, warmup_dir).write.format("noop").mode("overwrite").save()

    timings, rows, errors = {}, {}, {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
        except Exception as exc:  # report and keep timing the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
            continue
        timings[name] = round(time.perf_counter() - t0, 3)
        if name == "telemetry_decoded":
            rows[name] = df.count()

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    total = round(sum(timings.values()), 3)
    out = {
        "metric": "total_query_wall_time",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "warmup": f"untimed pass on {warmup_dir}" if warm else "none",
    }
    if errors:
        out["errors"] = errors
    if "telemetry_decoded" in timings and timings["telemetry_decoded"] > 0:
        out["decoded_records"] = rows["telemetry_decoded"]
        out["decoded_records_per_sec"] = round(rows["telemetry_decoded"] / timings["telemetry_decoded"], 1)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
