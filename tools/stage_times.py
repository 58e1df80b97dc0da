"""Run one registered query with Spark's event log on and print its stage times.

Usage: python tools/stage_times.py QUERY [sf_dir]

The event log goes to a fresh scratch folder (no UI, no server); stages are
listed with task counts and wall time, followed by the time spent after the last
stage of each SQL execution (driver-side work such as a write's job commit).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def read_events(log_dir: str) -> list[dict]:
    events = []
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*local-*")):
        if os.path.isdir(path):
            continue
        with open(path, "rb") as fh:
            raw = fh.read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    return events


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="tessera-eventlog-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    t0 = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()

    events = read_events(log_dir)
    stages, sql_ends = [], []
    for e in events:
        if e["Event"] == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages.append((info["Submission Time"], info["Completion Time"], info["Stage ID"],
                           info["Number of Tasks"], info["Stage Name"][:60]))
        elif e["Event"].endswith("SQLExecutionEnd"):
            sql_ends.append(e["time"])
    print(f"{name} on {sf_dir}: {wall:.1f} s wall, event log in {log_dir}")
    for start, end, sid, tasks, label in sorted(stages):
        print(f"  stage {sid:4d}  tasks {tasks:6d}  {(end - start) / 1000:7.2f} s  {label}")
    if stages:
        last = max(end for _, end, *_ in stages)
        after = [t for t in sql_ends if t >= last]
        if after:
            print(f"  after last stage (driver side): {(min(after) - last) / 1000:.2f} s")


if __name__ == "__main__":
    main()
