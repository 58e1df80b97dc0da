"""The automatic path as a Structured Streaming query.

Notifications arrive as JSON text files in a folder the bucket-event feed writes to, one
notification per line (or per file). Each micro-batch takes a bounded number of files or
bytes, qualifies the notifications and runs the batch pipeline on the objects they name
inside ``foreachBatch``. The checkpoint is the acknowledgement: a batch that fails is
replayed from the same offsets, and the sinks are idempotent (a delivery replaces its files,
replace-by-extraction), so a replay leaves the same result. An object is read whole inside
its batch, so no state store and no watermark are needed.

Redelivery. An object that is missing or unreadable comes back by itself: its key waits with
the number of its deliveries in a small table that every batch joins at its start and writes
anew at its end, under the batch's number. A replayed batch reads what the batch before it
left, so a delivery counts once. A new notification of the object starts over; after
``MAX_DELIVERIES`` the key goes to the dead letters. Keys come back with the next batch, so an
idle feed delays them.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import qualifying_objects
from tessera.plans.pipeline import SilverTarget, bronze_to_silver
from tessera.session import Workspace, delete_dir
from tessera.sources import parse_notifications, rejected_notifications
from tessera.sources.files import list_names, read_text

# Pull batch size, wait and delivery attempts of the queue consumer.
MAX_FILES_PER_TRIGGER = 10
PROCESSING_TIME = "5 seconds"
MAX_ATTEMPTS = MAX_DELIVERIES = 5
FAILED = ("missing", "unreadable")
WAITING = "object_key string, deliveries int"


def notification_stream(spark: SparkSession, notifications_dir: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                        max_bytes_per_trigger: int | None = None, whole_files: bool = False) -> DataFrame:
    """The feed's payloads. A batch takes at most so many files, or, if given, files of about so many bytes.
    ``whole_files``: a notification is a file, over as many lines as it likes."""
    reader = spark.readStream.format("text").option("wholetext", whole_files)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(notifications_dir).withColumnRenamed("value", "payload")


class Redelivery:
    """Keys that wait for another delivery, and dead letters, of one streaming query below ``path``."""

    def __init__(self, spark: SparkSession, path: str, query: str, limit: int = MAX_DELIVERIES):
        self.spark, self.limit = spark, limit
        self.waiting_dir, self.dead_dir, self.query = f"{path.rstrip('/')}/waiting/{query}", dead_letters_dir(path), query

    def _before(self, batch_id: int) -> list[int]:
        numbers = [int(x.partition("=")[2]) for x in list_names(self.spark, self.waiting_dir) if x.startswith("after=")]
        return sorted(n for n in numbers if n < batch_id)

    def asked(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """``object_key, deliveries``: the batch's keys, not delivered yet, and those that wait."""
        fresh = keys.select("object_key", F.lit(0).alias("deliveries"))
        before = self._before(batch_id)
        if not before:
            return fresh
        waiting = self.spark.read.schema(WAITING).parquet(f"{self.waiting_dir}/after={before[-1]}")
        return fresh.unionByName(waiting.join(fresh, "object_key", "left_anti"))

    def settle(self, outcomes: DataFrame, batch_id: int) -> None:
        """Write who waits after this batch, and its dead letters; states that no replay can need go."""
        failed = outcomes.where(F.col("status").isin(*FAILED))
        again = failed.where(F.col("deliveries") < self.limit).select("object_key", "deliveries")
        again.coalesce(1).write.mode("overwrite").parquet(f"{self.waiting_dir}/after={batch_id}")
        (failed.where(F.col("deliveries") >= self.limit).select("object_key", "deliveries", "status", "error")
         .withColumn("query_id", F.lit(self.query)).withColumn("batch_id", F.lit(batch_id)).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query_id", "batch_id").parquet(self.dead_dir))
        for n in self._before(batch_id)[:-1]:
            delete_dir(self.spark, f"{self.waiting_dir}/after={n}")


def dead_letters_dir(path: str) -> str:
    return f"{path.rstrip('/')}/dead"


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Objects that were delivered as often as they are, and failed each time."""
    schema = "object_key string, deliveries int, status string, error string, query_id string, batch_id long"
    names = [x for x in list_names(spark, dead_letters_dir(path)) if x.startswith("query_id=")]
    return spark.read.schema(schema).parquet(dead_letters_dir(path)) if names else spark.createDataFrame([], schema)


def batch_handler(bronze_root: str, target: SilverTarget, checkpoint: str, outcomes_path: str | None, fields=None,
                  max_attempts: int = MAX_ATTEMPTS, backoff_seconds: float = 1.0, redelivery_path: str | None = None,
                  notification_rejects_path: str | None = None, max_deliveries: int = MAX_DELIVERIES):
    def run(batch: DataFrame, batch_id: int) -> None:
        # A failed attempt is retried in place (the sinks are idempotent, so a
        # partial attempt is simply replaced); after the last attempt the error
        # stops the query and the batch is replayed from the checkpoint on restart.
        # Nothing is ever acknowledged without being processed.
        for attempt in range(1, max_attempts + 1):
            try:
                with Workspace(batch.sparkSession, "stream-batch") as work:
                    return run_once(batch, batch_id, work)
            except Exception:
                if attempt == max_attempts:
                    raise
                time.sleep(backoff_seconds * attempt)

    def run_once(batch: DataFrame, batch_id: int, work: Workspace) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        redelivery = Redelivery(spark, redelivery_path or f"{checkpoint.rstrip('/')}-redelivery", query, max_deliveries)

        def of_batch(df: DataFrame, path: str) -> None:
            (df.withColumn("query_id", F.lit(query)).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query_id", "batch_id").parquet(path))

        notes = parse_notifications(batch)
        if notification_rejects_path:
            of_batch(rejected_notifications(notes), notification_rejects_path)
        # Keys stay a table: however many a notification file names, they are never collected as a whole.
        keys = work.materialize(qualifying_objects(notes).select("object_key").distinct(), "keys")
        asked = work.materialize(redelivery.asked(keys, batch_id), "asked")
        if asked.isEmpty():
            return
        outcomes = bronze_to_silver(spark, bronze_root, asked, target, fields, work)
        outcomes = work.materialize(outcomes.join(asked, "object_key").withColumn("deliveries", F.col("deliveries") + 1), "delivered")
        if outcomes_path:
            of_batch(outcomes, outcomes_path)
        redelivery.settle(outcomes, batch_id)
    return run


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's identifier, which its checkpoint keeps over restarts: batch numbers of
    another query, or after a new checkpoint, never meet those of this one."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def stream_silver(spark: SparkSession, notifications_dir: str, bronze_root: str, target: SilverTarget,
                  checkpoint: str, outcomes_path: str | None = None, available_now: bool = False,
                  processing_time: str = PROCESSING_TIME,
                  max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, fields=None,
                  max_attempts: int = MAX_ATTEMPTS, max_bytes_per_trigger: int | None = None, whole_files: bool = False,
                  redelivery_path: str | None = None, notification_rejects_path: str | None = None,
                  max_deliveries: int = MAX_DELIVERIES) -> StreamingQuery:
    handler = batch_handler(bronze_root, target, checkpoint, outcomes_path, fields, max_attempts, redelivery_path=redelivery_path,
                            notification_rejects_path=notification_rejects_path, max_deliveries=max_deliveries)
    writer = (notification_stream(spark, notifications_dir, max_files_per_trigger, max_bytes_per_trigger, whole_files)
              .writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
