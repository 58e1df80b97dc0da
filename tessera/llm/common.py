"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import fresh_dir
from tessera.session import materialize as written

__all__ = ["RecentlyUsed", "buckets_for", "complete_groups", "connected_components", "crc_fold", "files_for", "fresh_dir", "levels", "materialize", "prepare_workers",
           "numbered", "prefix_sums", "read", "read_binary_rows"]

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    Enough wherever workers see the driver's files (local mode, a shared mount).
    Elsewhere ship the package with ``--py-files``; the extra entry then does
    nothing.
    """
    env = spark.sparkContext.environment
    entries = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if PACKAGE_ROOT not in entries:
        env["PYTHONPATH"] = os.pathsep.join([*entries, PACKAGE_ROOT])


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written once with a unique long per row, and that column's name.

    Written, because the identifiers Spark deals out hold only for one reading.
    """
    name = "_row"
    while name in {c.lower() for c in df.columns}:
        name += "_"
    path = fresh_dir(df.sparkSession, "numbered")
    df.withColumn(name, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), name


def files_for(rows: int) -> int:
    """Files for a table of narrow rows: a million rows a file, more files while it is small."""
    return max(-(-rows // 1_000_000), min(64, -(-rows // 50_000)), 1)


def materialize(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` in the shared folder and read it again, which cuts its lineage.

    ``rows``: about how many narrow rows it has at most, where known; they are written
    to as many files as that needs, not to one for each shuffle partition.
    """
    return written(df if rows is None else df.coalesce(files_for(rows)), purpose)


def buckets_for(rows: int) -> int:
    """Buckets of ``prefix_sums`` for so many rows: about 250,000 rows each, 1,024 at least."""
    return max(1024, -(-rows // 250_000))


def prefix_sums(df: DataFrame, key: str, value: str | Column, out: str, group: str | None = None,
                buckets: int = 1024) -> DataFrame:
    """``out``: the sum of ``value`` over all rows before this one (of its ``group``) in (bucket, key) order.

    Rows are dealt over ``buckets`` by a hash of the unique ``key``, so no task
    holds more than its even share, also of a group that has most rows; only the
    totals (``buckets`` rows a group) are added up in one place. ``df`` must give
    the same rows each time it is read.
    """
    by = [group] if group else []
    value = F.col(value) if isinstance(value, str) else value
    bucketed = df.withColumn("_value", value.cast("long")).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    totals = bucketed.groupBy(*by, "_bucket").agg(F.sum("_value").alias("_total"))
    along = (Window.partitionBy(*by) if by else Window).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*by, "_bucket", F.coalesce(F.sum("_total").over(along), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (bucketed.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
            .join(before, [*by, "_bucket"])
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_bucket", "_before", "_inside", "_value"))


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (long ids); root: the smallest id of its component.

    ``edges`` are written first, as they are.

    Alternates large-star and small-star rounds until the edges no longer change
    (O(log^2 n) rounds, 2 or 3 for the stars that the callers send). Every round
    is written to the shared folder, so a lost executor costs one round at most,
    and both inputs of its joins come from files, so that Spark can split a hub.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    given = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v"), "cc-edges")
    rows = given.count()
    current, seen = materialize(given.distinct(), "cc", rows), None

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "cc-least", 2 * rows)
        joined = both.join(least, "u")
        if large:  # larger neighbours go to the least of the neighbourhood
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # so do the node itself and its smaller neighbours
            out = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(least.select("u", F.col("m").alias("v"))))
        return out.where("u != v").distinct()

    while True:
        for large in (True, False):
            current = materialize(star(current, large), "cc", 2 * rows)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    roots = current.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def complete_groups(batches: Iterable[pa.RecordBatch], keys: list[str], at_least: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of whole groups from batches whose rows are sorted by ``keys``.

    Each table has ``at_least`` rows or more (the last may have fewer), so that
    small groups are handled together; a group is never cut.
    """
    waiting: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        if n < at_least:
            continue
        table = pa.Table.from_batches(waiting)
        change = np.zeros(n, bool)
        for k in keys:
            x = table.column(k).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        cut = np.flatnonzero(change)
        if not len(cut):
            continue
        yield table.slice(0, cut[-1])
        waiting = table.slice(cut[-1]).to_batches()
        n -= int(cut[-1])
    if n:
        yield pa.Table.from_batches(waiting)


def read_binary_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the batches as dicts, one after the other."""
    for b in batches:
        columns = list(zip(b.schema.names, b.columns, strict=True))
        for i in range(b.num_rows):
            yield {name: c[i].as_py() for name, c in columns}


class RecentlyUsed(dict):
    """A cache for one worker: values that ``make`` gives, at most about twice ``size`` of them.

    When it is full, what it holds becomes the older half, and the half before that goes;
    what is used again moves back. Memory depends on it, results never do.
    """

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def levels(n: int, fan_in: int) -> int:
    """Rounds in which ``n`` runs become one when ``fan_in`` meet at a time."""
    return max(1, math.ceil(math.log(max(2, n)) / math.log(fan_in) - 1e-9))


def crc_fold(column: Column, folds: int = 5) -> Column:
    """crc32 of the id as decimal text, modulo ``folds``."""
    return F.pmod(F.crc32(F.encode(column.cast("string"), "UTF-8")), F.lit(folds))
