"""B1: read Bronze chunk objects, each whole or not at all.

Chunk rows come from Spark's own Parquet reader (vectorized, nine columns, page checksums
verified). It skips what it cannot decode, so a footer scan proves each object: tasks read
only the footers of the asked objects, which say how many rows each must give, and an object
whose rows do not come to that number is ``unreadable`` and left out whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import BRONZE_CHUNKS
from tessera.session import Workspace, prepare_workers
from tessera.sources.files import exists, file_system, qualified

#: What the footers say: ``n_rows`` where the object is sound so far, else its status and the error.
FOOTERS = T.StructType([T.StructField("object_key", T.StringType()), T.StructField("n_rows", T.LongType()),
                        T.StructField("object_status", T.StringType()), T.StructField("error", T.StringType())])
#: Keys whose paths one scan names; of more, several scans are staged one after the other.
PATHS_AT_ONCE = 50_000
#: Chunk columns as read: whole numbers of any width, which then have to fit.
AS_READ = T.StructType([T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType) for f in BRONZE_CHUNKS])
NUMBERS = [f.name for f in BRONZE_CHUNKS if isinstance(f.dataType, T.IntegerType)]


def _root_marker(root: str) -> str:
    """The root as it appears inside file paths (``file:`` URIs drop the scheme)."""
    base = root.rstrip("/")
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    return base + "/"


def object_key_of(file_path: Column, root: str) -> Column:
    """Key of an object relative to the Bronze root."""
    marker = _root_marker(root)
    start = F.instr(file_path, F.lit(marker)) + F.lit(len(marker))
    return F.substr(file_path, start)


def scanned_key(root: str) -> Column:
    """Key of the object a row was read from; its path is a URI, in which ``+`` stands for itself."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return object_key_of(path, root)


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_key) of every Parquet object below the root, from Spark's file listing."""
    root = qualified(spark, root)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root))
    return files.select(object_key_of(F.col("path"), root).alias("object_key"))


def read_footers(keys: DataFrame, root: str) -> DataFrame:
    """One row per asked key (``FOOTERS``), read by tasks; no chunk leaves its file.

    An object that is not there is ``missing``; one whose footer cannot be read or that has
    no rows is ``unreadable``. Errors of the store are raised: the task is repeated, and in
    the end the batch fails, so that nothing is taken as done. Keys are data here, never path
    patterns, so no key can fail its neighbours.
    """
    spark = keys.sparkSession
    prepare_workers(spark)
    names = FOOTERS.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root.rstrip("/"))
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                n, status, error = None, None, None
                info = fs.get_file_info(f"{base}/{key.lstrip('/')}")
                if info.type != pyarrow.fs.FileType.File:
                    status, error = "missing", "object not found"
                else:
                    with fs.open_input_file(info.path) as f:
                        try:
                            n = pq.read_metadata(f).num_rows
                            if not n:
                                n, status, error = None, "unreadable", "no chunk rows"
                        except (pa.ArrowInvalid, ValueError) as e:
                            status, error = "unreadable", f"{type(e).__name__}: {str(e)[:300]}"
                rows.append((key, n, status, error))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i == 1 else pa.string()) for i in range(4)], names)

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return keys.select("object_key").where("object_key IS NOT NULL").distinct().repartition(n).mapInArrow(run, FOOTERS)


def scan_chunks(spark: SparkSession, root: str, keys: list[str] | None) -> DataFrame:
    """Chunk rows of the objects with these keys, or of all below ``root``, as Spark can read them.

    A file that is damaged, or gone by now, gives fewer rows or none. ``fits`` is false in a
    row with a number that a chunk column cannot hold.
    """
    reader = (spark.read.schema(AS_READ).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
              .option("parquet.page.verify-checksum.enabled", "true"))
    if keys is None:
        rows = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)
    else:
        # paths are patterns to Spark: what means something in one is taken literally
        plain = str.maketrans({c: f"\\{c}" for c in "\\*?[]{},"})
        rows = reader.parquet(*[f"{root.rstrip('/')}/{k.lstrip('/').translate(plain)}" for k in keys])
    number = {c: F.col(c).try_cast("int") for c in NUMBERS}
    fits = [number[c].isNotNull() | F.col(c).isNull() for c in NUMBERS]
    return rows.select(*[number.get(c, F.col(c)).alias(c) for c in BRONZE_CHUNKS.fieldNames()], scanned_key(root).alias("object_key"),
                       F.col("_metadata.file_modification_time").alias("delivery_time"), (fits[0] & fits[1]).alias("fits"))


def keys_table(spark: SparkSession, root: str, keys: Iterable[str] | DataFrame | None) -> DataFrame:
    """Keys as a table (object_key): given ones, or those of every object below ``root``."""
    if keys is None:
        return list_objects(spark, root)
    if isinstance(keys, DataFrame):
        return keys
    return spark.createDataFrame([(k,) for k in sorted(set(keys))], "object_key string")


def read_objects(spark: SparkSession, root: str, keys: Iterable[str] | DataFrame | None, work: Workspace,
                 paths_at_once: int = PATHS_AT_ONCE) -> tuple[DataFrame, DataFrame]:
    """Chunk rows (with ``object_key`` and ``delivery_time``) of the sound objects, and one row per
    asked key: ``object_key, object_status`` (``read``, ``unreadable``, ``missing``), ``error``.

    The scan of every object below the root is one; named objects are scanned ``paths_at_once``
    at a time, so that is what the driver holds of a long list. Both results are staged in ``work``.
    """
    root = qualified(spark, root)
    footers = work.materialize(read_footers(keys_table(spark, root, keys), root), "footers")
    staged = work.fresh("chunks")
    if keys is None:
        scan_chunks(spark, root, None).write.parquet(staged)
    else:
        found = footers.where("n_rows IS NOT NULL").select("object_key")
        parts = max(1, -(-found.count() // paths_at_once))
        for i in range(parts):
            part = [r[0] for r in found.where(F.pmod(F.xxhash64("object_key"), F.lit(parts)) == i).collect()]
            scan_chunks(spark, root, part).write.mode("append").parquet(staged) if part else None
    schema = T.StructType([*BRONZE_CHUNKS.fields, T.StructField("object_key", T.StringType()), T.StructField("delivery_time", T.TimestampType()),
                           T.StructField("fits", T.BooleanType())])
    chunks = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(staged) if exists(spark, staged) else spark.createDataFrame([], schema)

    # Objects are few beside their chunks: what is wrong is a small table, mostly an empty one.
    counted = chunks.groupBy("object_key").agg(F.count("*").alias("n_read"), F.bool_and("fits").alias("fits"))
    missed = F.coalesce(F.col("n_read"), F.lit(0))
    judged = work.materialize(footers.join(counted, "object_key", "full").select(
        "object_key",
        F.when(F.col("object_status").isNotNull(), F.col("object_status")).when(F.col("n_rows").isNull(), "unasked")
        .when((missed != F.col("n_rows")) | ~F.col("fits"), "unreadable").otherwise("read").alias("object_status"),
        F.when(F.col("object_status").isNotNull(), F.col("error"))
        .when(missed != F.col("n_rows"), F.concat(missed.cast("string"), F.lit(" of "), F.col("n_rows").cast("string"), F.lit(" chunk rows can be read")))
        .when(~F.col("fits"), f"a number does not fit {' or '.join(NUMBERS)}").alias("error")), "objects")
    wrong = judged.where("object_status != 'read'").select("object_key")
    return chunks.drop("fits").join(wrong, "object_key", "left_anti"), judged.where("object_status != 'unasked'")


def read_bronze(spark: SparkSession, root: str, keys: Iterable[str] | DataFrame | None, work: Workspace) -> DataFrame:
    """Chunk rows of the given objects (or of every object below ``root``) that are sound."""
    return read_objects(spark, root, keys, work)[0]
