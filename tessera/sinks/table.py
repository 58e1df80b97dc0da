"""Catalog tables in which new rows of a key replace its earlier ones.

A table is an external Parquet table of the catalog, partitioned by ``bucket``, a hash of its
key; the catalog says where each bucket lies, so it has to be one that lasts. A replace reads the
buckets of its keys, leaves out the rows of these keys, adds the new ones, writes the result to a
folder of its own (``merge_buckets``), and then points the catalog's partitions of these buckets
at it, in one call (``publish``). Nothing that a reader may have planned on is changed or removed,
and a crash before that call leaves the table as it was; folders that no partition points at are
removed by ``remove_unused``, when old enough.

The bucket count is a property of the table, and another one is refused (``rebucket`` changes
it). What reaches the driver is a number for each touched bucket. A table that others replace
meanwhile is noticed by a count of its replaces, and merged again; between that look and the
call, only replaces of one driver wait for each other. For many writers of one table, use a
table format where one is installed.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import TELEMETRY
from tessera.session import delete_dir
from tessera.sources.files import hadoop_path, list_names

TABLE_KEY = ["technology", "device_id", "extraction_id"]
# A replace rewrites every bucket it touches, so a bucket should stay small
# (a few hundred MB): size the count as table bytes / ~256 MB (``buckets_for``).
DEFAULT_BUCKETS = 256
WRITE_ATTEMPTS = 5
#: Hours for which readers may go on with files that a replace has put others in the place of.
KEPT_HOURS = 7 * 24
_publishing = threading.Lock()


class TableConflict(RuntimeError):
    """Other writers replaced rows first, as often as this one tried."""


def buckets_for(table_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Bucket count that keeps one bucket near ``bucket_bytes`` (a power of two)."""
    want = max(1, -(-table_bytes // bucket_bytes))
    return 1 << (want - 1).bit_length()


def ensure_table(spark: SparkSession, table: str, location: str, schema: T.StructType, buckets: int | None = None) -> int:
    """Make the table unless it is there; its bucket count."""
    if not spark.catalog.tableExists(table):
        if any(x.startswith("replace=") for x in list_names(spark, location)):
            raise ValueError(f"{location} holds rows of a table that this catalog does not know")
        if "." in table:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) LOCATION '{location.rstrip('/')}' "
                  f"TBLPROPERTIES ('tessera.buckets' = '{buckets or DEFAULT_BUCKETS}', 'tessera.replaces' = '0')")
    found = int(_property(spark, table, "buckets"))
    if buckets and buckets != found:
        raise ValueError(f"{table} has {found} buckets, not {buckets}; rebucket() changes that")
    return found


def _property(spark: SparkSession, table: str, name: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {table} ('tessera.{name}')").first()["value"]


def _set_properties(spark: SparkSession, table: str, **values: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(f"'tessera.{k}' = '{v}'" for k, v in values.items())})")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def with_bucket(rows: DataFrame, key: Iterable[str], buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def _write_folder(rows: DataFrame, location: str) -> tuple[str, list[int]]:
    """Write rows (with ``bucket``) to a new folder of the table: the folder, and the buckets it holds.

    A bucket is one file: rows are dealt by bucket first. Where a partition is large, AQE
    splits it (the hint allows that), so a hot bucket becomes some files by several tasks.
    """
    folder = f"{location}/replace={uuid.uuid4().hex}"
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    names = list_names(rows.sparkSession, folder)
    return folder, sorted(int(x[len("bucket="):]) for x in names if x.startswith("bucket="))


def publish(spark: SparkSession, table: str, folder: str, written: list[int], emptied: list[int]) -> None:
    """Point the catalog's partitions of the written buckets at the folder; emptied ones are dropped.

    One call of the catalog for all that it knows already (Spark's SQL has a statement for one
    partition only), and a statement each for new ones and emptied ones, however many there are.
    A bucket is always whole; a replace that broke off in between and is repeated ends the same.
    """
    jvm, catalog = spark._jvm, spark._jsparkSession.sessionState().catalog()
    name = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(table)
    known = {int(r[0][len("bucket="):]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    fresh, moved = [b for b in written if b not in known], [b for b in written if b in known]
    if moved:
        utils = jvm.org.apache.spark.api.python.PythonUtils
        old = catalog.getPartition(name, utils.toScalaMap({"bucket": str(moved[0])}))
        place, parts = old.storage(), []
        for b in moved:
            uri = jvm.org.apache.hadoop.fs.Path(f"{folder}/bucket={b}").toUri()
            at = place.copy(jvm.scala.Option.apply(uri), place.inputFormat(), place.outputFormat(), place.serde(), place.compressed(), place.properties())
            parts.append(old.copy(utils.toScalaMap({"bucket": str(b)}), at, old.parameters(), old.createTime(), old.lastAccessTime(), old.stats()))
        catalog.alterPartitions(name, utils.toSeq(parts))
    if fresh:
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"PARTITION (bucket={b}) LOCATION '{folder}/bucket={b}'" for b in fresh))
    gone = [b for b in emptied if b in known]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP " + ", ".join(f"PARTITION (bucket={b})" for b in gone))
    spark.sql(f"REFRESH TABLE {table}")


def merge_buckets(rows: DataFrame, keys: DataFrame, table: str, location: str, schema: T.StructType, key: list[str],
                  buckets: int) -> tuple[str, list[int], list[int]] | None:
    """Write what the buckets of ``keys`` hold, with ``rows`` in the place of the rows of these keys, to a new
    folder: the folder, its buckets, and those that are empty now. The table stays as it is. None without keys."""
    spark, names = rows.sparkSession, [*schema.fieldNames(), "bucket"]
    touched = sorted(r[0] for r in with_bucket(keys, key, buckets).select("bucket").distinct().collect())  # a number for each bucket at most
    if not touched:
        return None
    new = with_bucket(rows, key, buckets).select(*names)
    kept = spark.table(table).where(F.col("bucket").isin(touched)).select(*names).join(keys, key, "left_anti").select(*names)
    folder, written = _write_folder(kept.unionByName(new), location)
    return folder, written, sorted(set(touched) - set(written))


def replace_rows(rows: DataFrame, table: str, location: str, schema: T.StructType, key: list[str],
                 replaced: DataFrame | None = None, buckets: int | None = None) -> None:
    """Replace the rows of every key in ``rows`` (of every key in ``replaced``, if given) by ``rows``.

    Equivalent to ``DELETE WHERE key IN replaced; INSERT rows BY NAME``. Old and new rows of a
    key share a bucket, so only the buckets of replaced keys are read and rewritten, each row
    once. Key columns are never null. Both inputs are read several times: pass staged ones.
    """
    spark, location = rows.sparkSession, location.rstrip("/")
    count = ensure_table(spark, table, location, schema, buckets)
    keys = (rows if replaced is None else replaced).select(*key).distinct()
    for _ in range(WRITE_ATTEMPTS):
        before = int(_property(spark, table, "replaces"))
        merged = merge_buckets(rows, keys, table, location, schema, key, count)
        if merged is None:
            return
        with _publishing:
            if int(_property(spark, table, "replaces")) == before:
                _set_properties(spark, table, replaces=before + 1)
                return publish(spark, table, *merged)
        delete_dir(spark, merged[0])  # someone else was first: merge with theirs
    raise TableConflict(f"{table} was changed by others {WRITE_ATTEMPTS} times in a row")


def upsert_telemetry(records: DataFrame, table: str, location: str, buckets: int | None = None) -> None:
    """Replace the rows of every (technology, device_id, extraction_id) in ``records`` (staged ones)."""
    replace_rows(records, table, location, TELEMETRY, TABLE_KEY, buckets=buckets)


def rebucket(spark: SparkSession, table: str, key: list[str], buckets: int) -> None:
    """Rewrite the table with another bucket count. For a time without writers: between the
    published folder and the new count stands one statement."""
    before = [int(r[0][len("bucket="):]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    folder, written = _write_folder(with_bucket(spark.table(table).drop("bucket"), key, buckets), table_location(spark, table))
    with _publishing:
        publish(spark, table, folder, written, [b for b in before if b not in set(written)])
        _set_properties(spark, table, buckets=buckets, replaces=int(_property(spark, table, "replaces")) + 1)


def remove_unused(spark: SparkSession, table: str, hours: float = KEPT_HOURS) -> int:
    """Remove bucket folders that no partition points at and that were written more than ``hours`` ago:
    neither a reader nor a replace that is under way needs them. How many."""
    location, removed = table_location(spark, table), 0
    files = spark.table(table).inputFiles() if spark.sql(f"SHOW PARTITIONS {table}").take(1) else []
    used = {"/".join(x.split("/")[-3:-1]) for x in files}

    def old(path: str) -> bool:
        fs, jpath = hadoop_path(spark, path)
        return time.time() - fs.getFileStatus(jpath).getModificationTime() / 1000 >= hours * 3600

    for folder in list_names(spark, location):
        inside = {x for x in list_names(spark, f"{location}/{folder}") if x.startswith("bucket=")}
        unused = {b for b in inside if f"{folder}/{b}" not in used and old(f"{location}/{folder}/{b}")}
        for b in unused:
            delete_dir(spark, f"{location}/{folder}/{b}")
        if unused == inside and old(f"{location}/{folder}"):
            delete_dir(spark, f"{location}/{folder}")
        removed += len(unused)
    return removed
