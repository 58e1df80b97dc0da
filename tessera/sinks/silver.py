"""Silver files, and the namespaces of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import date_parts, path_safe
from tessera.schemas import SILVER_FILE, SILVER_PARTITIONS
from tessera.sinks.directories import read_directories, replace_directories


def silver_file_rows(records: DataFrame) -> DataFrame:
    """Records in the Silver file layout: raw envelope values as ``source_*`` data
    columns, sanitized ones (and year/month/day) as partition columns."""
    return records.select(
        "name", "value", "timestamp",
        F.col("technology").alias("source_technology"),
        F.col("device_id").alias("source_device_id"),
        F.col("extraction_id").alias("source_extraction_id"),
        path_safe(F.col("technology")).alias("technology"),
        path_safe(F.col("device_id")).alias("device_id"),
        *date_parts(F.col("timestamp")),
        path_safe(F.col("extraction_id")).alias("extraction_id"),
    )


def write_silver_files(records: DataFrame, silver_root: str, partitions: int | None = None) -> str:
    """Write ``<root>/telemetry/technology=/device_id=/year=/month=/day=/extraction_id=``.

    The rows are written to a staging folder of this job, and its commit puts their
    directories in the place of the old ones. So a re-delivered extraction replaces its own
    directories and leaves every other extraction (also of the same day) alone; of two
    writers of one extraction, the one that commits last leaves its files alone; a write that
    fails before its commit changes nothing, and one repeated after a failure ends in the
    same state (``replace_directories``).

    Rows are range-partitioned on the partition columns plus time, so small extractions
    share a task (few files) while a hot extraction is split over several tasks.

    The input is read several times (directory count, range sample, write): pass
    materialized rows (staged files or a checkpoint), as the pipeline does.
    """
    spark = records.sparkSession
    target = f"{silver_root.rstrip('/')}/telemetry"
    rows = silver_file_rows(records)
    # An explicit task count (sized by the deployment through shuffle partitions), so
    # AQE does not coalesce small inputs into one task that opens every file serially;
    # never more tasks than directories, so a small directory is not cut into several files.
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dirs = rows.select(*SILVER_PARTITIONS).distinct().limit(n).count()
    if dirs:
        replace_directories(rows.repartitionByRange(dirs, *SILVER_PARTITIONS, "timestamp", "name"), target, SILVER_PARTITIONS)
    return target


def read_silver_files(spark: SparkSession, silver_root: str) -> DataFrame:
    """Read Silver files back with explicit types (no partition-type guessing:
    a device id like ``4827E2000010`` must stay a string); by tasks where the root is
    mounted, so that the driver holds no list of files (``read_directories``). Filters on
    partition columns apply to what was read there."""
    return read_directories(spark, f"{silver_root.rstrip('/')}/telemetry", SILVER_FILE, SILVER_PARTITIONS)


def ensure_schemas(spark: SparkSession, root: str, names=("bronze", "silver", "gold")) -> None:
    """Namespaces of the catalog, below ``root``."""
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{root.rstrip('/')}/{name}.db'")
