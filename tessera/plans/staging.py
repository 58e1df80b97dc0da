"""Stage Bronze objects and a notification feed from derived chunks.

This plays the upstream ingestion side for end-to-end runs: one object per
extraction below ``<root>/telemetry/extraction=<id>/``, and one created-object
notification per object (URL-encoded key, as the bucket sends it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import BRONZE_CHUNKS
from tessera.sinks.directories import replace_directories
from tessera.sources import list_objects


def stage_bronze_objects(chunks: DataFrame, bronze_root: str) -> str:
    """Write one Parquet object per extraction (the upstream invariant: an object
    is one delivery of one extraction, so an extraction is never split).

    Objects of the same extractions that are there already are replaced.

    Range partitioning on the extraction packs small extractions into shared
    tasks by row count instead of hashing them unevenly.
    """
    spark = chunks.sparkSession
    target = f"{bronze_root.rstrip('/')}/telemetry"
    # Explicit task count: AQE would coalesce a small input into one or two tasks
    # that create every object serially.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    replace_directories(chunks.withColumn("extraction", F.col("extraction_id")).repartitionByRange(n, "extraction"), target, ["extraction"])
    return target


def stage_notifications(spark: SparkSession, bronze_root: str, feed_dir: str, files: int = 20) -> str:
    """Write created-object notifications for every object below ``bronze_root``, spread
    over ``files`` JSON-lines files."""
    return notify(list_objects(spark, bronze_root), feed_dir, files)


def notify(objects: DataFrame, feed_dir: str, files: int = 1) -> str:
    """Add created-object notifications of the objects (object_key) to the feed."""
    record = F.struct(
        F.lit("s3:ObjectCreated:Put").alias("eventName"),
        F.struct(F.struct(F.lit("bronze").alias("name")).alias("bucket"),
                 F.struct(F.url_encode(F.col("object_key")).alias("key")).alias("object")).alias("s3"))
    payload = F.to_json(F.struct(F.array(record).alias("Records")))
    objects.select(payload.alias("value")).repartition(files).write.mode("append").text(feed_dir)
    return feed_dir
