"""Command line: the two ways the refinement is triggered.

  python -m tessera reprocess --bronze-root R --silver-root S [--table T] KEY [KEY ...]
  python -m tessera backfill --bronze-root R --silver-root S [--table T]
  python -m tessera stream --notifications N --bronze-root R --silver-root S [--table T] \
      --checkpoint C [--available-now]

``reprocess`` is the manual re-trigger of explicit objects (prints one outcome row
per key); ``backfill`` runs every object below the Bronze root as one batch (no key
list on the driver); ``stream`` is the automatic path over a folder of notification
files.
Both use the session configured by ``spark-submit`` / ``spark-defaults.conf``; its catalog has
to be one that lasts, since it says where the tables' buckets lie.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators import stored_layouts
from tessera.plans.pipeline import SilverTarget, bronze_to_silver
from tessera.session import Workspace, apply_pipeline_conf
from tessera.streaming.stream import MAX_FILES_PER_TRIGGER, PROCESSING_TIME, stream_silver


def _target(args) -> SilverTarget:
    return SilverTarget(silver_root=args.silver_root, table=args.table, rejects_table=args.rejects_table,
                        table_root=args.table_root, buckets=args.buckets)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("reprocess", "backfill", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--bronze-root", required=True)
        p.add_argument("--silver-root", required=True)
        p.add_argument("--table", default=SilverTarget.table, help="name in the catalog")
        p.add_argument("--rejects-table", default=None, help="name in the catalog; none: rejects are not kept")
        p.add_argument("--table-root", default=None, help="folder of tables that are made now (default: tables below the Silver root)")
        p.add_argument("--buckets", type=int, default=None, help="of a table that is made now; an existing one keeps its own")
        p.add_argument("--layouts", default=None, help="table of payload layouts (default: the built-in ones)")
        p.add_argument("--outcomes-path", default=None, help="append per-object outcomes here")
    rp = sub.choices["reprocess"]
    rp.add_argument("keys", nargs="+")
    st = sub.choices["stream"]
    st.add_argument("--notifications", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--available-now", action="store_true")
    st.add_argument("--processing-time", default=PROCESSING_TIME)
    st.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES_PER_TRIGGER)
    st.add_argument("--max-bytes-per-trigger", type=int, default=None, help="in place of the number of files")
    st.add_argument("--whole-files", action="store_true", help="a notification is a file, not a line")
    st.add_argument("--redelivery-path", default=None, help="keys that wait and dead letters (default: beside the checkpoint)")
    st.add_argument("--notification-rejects-path", default=None)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"tessera-{args.command}").getOrCreate()
    apply_pipeline_conf(spark)
    layouts = stored_layouts(spark.table(args.layouts)) if args.layouts else None
    if args.command in ("reprocess", "backfill"):
        keys, counts = args.keys if args.command == "reprocess" else None, {}
        with Workspace(spark, args.command) as work:
            outcomes = bronze_to_silver(spark, args.bronze_root, keys, _target(args), layouts, work, counts)
            if args.outcomes_path:
                # One run = one partition of the outcome table (B20), like one stream batch.
                (outcomes.withColumn("run_id", F.lit(f"{args.command}-{uuid.uuid4().hex[:12]}"))
                 .write.mode("append").partitionBy("run_id").parquet(args.outcomes_path))
            if keys is not None:
                outcomes.orderBy("object_key").show(len(keys), truncate=False)
            else:
                outcomes.groupBy("status").count().show(truncate=False)
        print("documents:", " ".join(f"{k}={v}" for k, v in counts.items()))
    else:
        query = stream_silver(spark, args.notifications, args.bronze_root, _target(args),
                              checkpoint=args.checkpoint, outcomes_path=args.outcomes_path,
                              available_now=args.available_now, processing_time=args.processing_time,
                              max_files_per_trigger=args.max_files_per_trigger, fields=layouts,
                              max_bytes_per_trigger=args.max_bytes_per_trigger, whole_files=args.whole_files,
                              redelivery_path=args.redelivery_path, notification_rejects_path=args.notification_rejects_path)
        query.awaitTermination()


if __name__ == "__main__":
    main()
