"""Hive-style partition directories, each replaced as a whole."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import Workspace, delete_dir, prepare_workers
from tessera.sources.files import exists, file_system, qualified

#: What a Hive-style directory name has as ``%XX``, the name of one for null, and the rows of a batch that tasks read.
ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
BATCH_ROWS = 10_000


def replace_directories(dealt: DataFrame, target: str, partitions: list[str]) -> None:
    """Write rows, dealt over tasks, as Parquet to the directories of their partition columns below
    ``target``; these replace those that are there, all others stay.

    Spark's dynamic partition overwrite does that, except on a file system that driver and
    executors have mounted (``file:``). There Spark's committer runs a process for every directory
    that it makes, and makes most of them one after the other in the driver; so tasks write and
    move the directories (``write_mounted``).
    """
    place = qualified(dealt.sparkSession, target)
    if place.startswith("file:"):
        write_mounted(dealt, place, partitions)
    else:
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(target)


def directory_of(partitions: list[str], values: tuple) -> str:
    """Directory of partition values, named as Spark names it."""
    texts = ["" if v is None else ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(v)) for v in values]
    return "/".join(f"{name}={text or NO_VALUE}" for name, text in zip(partitions, texts, strict=True))


def task_count(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def write_mounted(dealt: DataFrame, target: str, partitions: list[str]) -> None:
    """Replace the directories that the rows belong to, on a file system that driver and executors have mounted.

    1. Tasks write a file per directory of their rows to a staging folder, batch by batch, each
       attempt to a folder of its own. What they wrote is staged as a table, which holds the
       files of the attempts that Spark took, and no others.
    2. Tasks move the files, those of a directory in one task: the old directory goes, the staged
       one takes its place. A repeated task finds moved ones gone and leaves them.
    """
    spark = dealt.sparkSession
    prepare_workers(spark)
    staging = f"{target.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    tasks = task_count(spark)
    data = [c for c in dealt.columns if c not in partitions]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(staging)
        attempt, n, now, writer, directories, files = uuid.uuid4().hex, 0, None, None, [], []
        for b in batches:
            if not b.num_rows:
                continue
            change = np.zeros(b.num_rows, bool)
            for c in partitions:
                codes = b.column(c).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                change[1:] |= codes[1:] != codes[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
            rows = b.select(data)
            for start, stop in zip(starts, starts[1:], strict=False):
                values = tuple(b.column(c)[start].as_py() for c in partitions)
                if values != now:
                    if writer:
                        writer.close()
                    now, n = values, n + 1
                    directories.append(directory_of(partitions, values))
                    files.append(f"{attempt}/{n}/part-{attempt}.parquet")
                    fs.create_dir(f"{base}/{attempt}/{n}", recursive=True)
                    writer = pq.ParquetWriter(f"{base}/{files[-1]}", rows.schema, filesystem=fs, write_page_checksum=True)
                writer.write_batch(rows.slice(start, stop - start))
        if writer:
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array(directories, pa.string()), pa.array(files, pa.string())], ["directory", "file"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(target)
        staged, moved = file_system(staging)[1], 0
        for b in batches:
            for directory, files in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                first, *more = sorted(f"{staged}/{f}" for f in files)
                folder = first.rpartition("/")[0]
                for f in more:
                    if is_there(fs, f):
                        fs.move(f, f"{folder}/{f.rpartition('/')[2]}")
                moved += put_in_place(fs, folder, f"{base}/{directory}")
        yield pa.RecordBatch.from_arrays([pa.array([moved], pa.int64())], ["moved"])

    try:
        with Workspace(spark, "silver-files") as work:
            written = work.materialize(dealt.sortWithinPartitions(*partitions).mapInArrow(write, "directory string, file string"), "written")
            (written.repartition(tasks, "directory").groupBy("directory").agg(F.collect_list("file").alias("files"))
             .mapInArrow(move, "moved long").write.format("noop").mode("overwrite").save())
    finally:
        delete_dir(spark, staging)


def is_there(fs: pyarrow.fs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pyarrow.fs.FileType.NotFound


def put_in_place(fs: pyarrow.fs.FileSystem, folder: str, place: str, attempts: int = 20) -> bool:
    """Move the folder to the place of the one that is there, if any; false where it was moved before.
    A writer that puts its own there in between is replaced in turn."""
    for attempt in range(attempts):
        if not is_there(fs, folder):
            return False
        if is_there(fs, place):
            try:
                fs.delete_dir(place)
            except OSError:
                if attempt == attempts - 1:
                    raise
        else:
            fs.create_dir(place.rpartition("/")[0], recursive=True)
        try:
            fs.move(folder, place)
            return True
        except OSError:
            if attempt == attempts - 1:
                raise
    return False


def read_directories(spark: SparkSession, target: str, schema: T.StructType, partitions: list[str]) -> DataFrame:
    """Rows of the Parquet files in the directories of ``partitions`` below ``target``; the last columns
    of ``schema`` are these partitions.

    Spark's reader gives them, but lists every file in the driver, which holds their names, states,
    values and scan tasks: one file a directory is more than a driver can hold of a large table. So
    on a file system that driver and executors have mounted, tasks list the directories and
    read the files (``read_mounted``).
    """
    place = qualified(spark, target)
    if place.startswith("file:") and exists(spark, target):
        return read_mounted(spark, place, schema, partitions)
    return spark.read.schema(schema).parquet(target)


def read_mounted(spark: SparkSession, target: str, schema: T.StructType, partitions: list[str]) -> DataFrame:
    """Rows of the files in partition directories, on a file system that driver and executors have mounted.

    1. Tasks list the directories level by level; what a level has is dealt to the tasks of the
       next one, so neither a directory of many others nor the driver has all of them.
    2. Tasks read the files; of a large one each reads the row groups that begin in its piece
       (``spark.sql.files.maxPartitionBytes``).

    What Spark's reader passes over (hidden and empty files, directories gone meanwhile) is passed
    over, and a file or directory where none belongs is an error, as it is there.
    """
    prepare_workers(spark)
    tasks = task_count(spark)
    piece = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    arrow = to_arrow_schema(schema, timestamp_utc=False)
    data = pa.schema([f for f in arrow if f.name not in partitions])
    kinds = [arrow.field(c).type for c in partitions]

    def listed(directories: Iterator[pa.RecordBatch]) -> Iterator[pyarrow.fs.FileInfo]:
        fs, base = file_system(target)
        for b in directories:
            for directory in b.column(0).to_pylist():
                for found in fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/{directory}".rstrip("/"), allow_not_found=True)):
                    if not is_hidden(found.base_name):
                        yield directory, found

    def directories_of(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def names() -> Iterator[tuple]:
                for directory, found in listed(batches):
                    if found.type != pyarrow.fs.FileType.Directory or not found.base_name.startswith(f"{partitions[level]}="):
                        raise ValueError(f"not a directory of {partitions[level]}: {found.path}")
                    yield (f"{directory}/{found.base_name}".lstrip("/"),)

            return in_batches(names(), pa.schema([("directory", pa.string())]))
        return run

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[tuple]:
            for directory, found in listed(batches):
                if found.type != pyarrow.fs.FileType.File:
                    raise ValueError(f"not a file: {found.path}")
                for start in range(0, found.size, piece):
                    yield directory, found.base_name, start

        return in_batches(cut(), pa.schema([("directory", pa.string()), ("file", pa.string()), ("start", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(target)
        held, values, n = [], [], 0
        for b in batches:
            for directory, file, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                of = values_of(directory, kinds)
                with pq.ParquetFile(f"{base}/{directory}/{file}", filesystem=fs) as f:
                    groups = [i for i in range(f.metadata.num_row_groups) if start <= begin_of(f.metadata.row_group(i)) < start + piece]
                    there = [c for c in data.names if c in f.schema_arrow.names]
                    for rows in f.iter_batches(BATCH_ROWS, groups, there, use_threads=False) if groups else ():
                        held.append(rows if rows.schema.equals(data) else shaped(rows, data))
                        values.append(of)
                        n += rows.num_rows
                        if n >= BATCH_ROWS:
                            yield together(held, values, data, arrow, kinds)
                            held, values, n = [], [], 0
        if n:
            yield together(held, values, data, arrow, kinds)

    found = spark.range(0, 1, 1, 1).select(F.lit("").alias("directory"))
    for level in range(len(partitions)):
        found = found.mapInArrow(directories_of(level), "directory string").repartition(tasks)
    return found.mapInArrow(pieces, "directory string, file string, start long").repartition(tasks).mapInArrow(read, schema)


def is_hidden(name: str) -> bool:
    """Whether Spark's reader passes over files and directories of this name."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*some, strict=True), schema.types, strict=True)], schema=schema)


def values_of(directory: str, kinds: list[pa.DataType]) -> tuple:
    """Partition values that a directory is named after."""
    texts = [name.partition("=")[2] for name in directory.split("/")]
    plain = [None if t == NO_VALUE else re.sub("%([0-9a-fA-F]{2})", lambda m: chr(int(m[1], 16)), t) for t in texts]
    return tuple(int(t) if t is not None and pa.types.is_integer(kind) else t for t, kind in zip(plain, kinds, strict=True))


def begin_of(group: pq.RowGroupMetaData) -> int:
    """Place of a row group in its file."""
    c = group.column(0)
    return min(c.data_page_offset, c.dictionary_page_offset or c.data_page_offset)


def shaped(rows: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The rows with the columns of the schema, null where they have none."""
    return pa.RecordBatch.from_arrays([rows.column(f.name).cast(f.type) if f.name in rows.schema.names else pa.nulls(rows.num_rows, f.type) for f in schema], schema=schema)


def together(held: list[pa.RecordBatch], values: list[tuple], data: pa.Schema, schema: pa.Schema, kinds: list[pa.DataType]) -> pa.RecordBatch:
    """Rows of several directories as one batch, the partition values beside them."""
    at = pa.array(np.repeat(np.arange(len(held)), [b.num_rows for b in held]))
    columns = [c.combine_chunks() for c in pa.Table.from_batches(held, data).columns]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(c, kind).take(at) for c, kind in zip(zip(*values, strict=True), kinds, strict=True))], schema=schema)
