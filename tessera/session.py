"""Session settings the pipeline relies on, and the shared work folder.

Library functions never build a session themselves; they take the one they are
given. ``build_session`` is for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for sessions this package builds itself (tests, bench, command line).
# Results do not depend on them: timestamps are computed without the session zone
# and every replacing write sets its overwrite mode explicitly. AQE re-planning
# and skew splitting are Spark defaults, stated here so a deployment that turned
# them off gets them back.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "4g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for key, value in {**PIPELINE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_pipeline_conf(spark)
    return spark


def apply_pipeline_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session someone else built."""
    for key, value in PIPELINE_CONF.items():
        spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every executor;
    a session on a cluster without it is refused, since a folder made here would be
    another one on every machine. Only a local session (tests, the bench) gets a
    fresh folder, registered as the checkpoint dir, so that ``checkpoint()`` uses it
    too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder below the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as Parquet in a fresh folder below the shared root and
    return the re-read table.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    plan) in a single pass; ``DataFrame.checkpoint()`` would compute an
    uncached plan twice.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


class Workspace:
    """One folder for all that a batch stages, removed when the ``with`` block ends, also by an error.

    What is to outlive the batch is written elsewhere before that.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path = spark, fresh_dir(spark, purpose)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        delete_dir(self.spark, self.path)

    def fresh(self, purpose: str) -> str:
        return f"{self.path}/{purpose}-{uuid.uuid4().hex[:12]}"

    def materialize(self, df: DataFrame, purpose: str) -> DataFrame:
        """As the function of that name, in this folder."""
        path = self.fresh(purpose)
        df.write.parquet(path)
        return self.spark.read.parquet(path)


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it (local
    mode, a shared mount). Elsewhere ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    entries = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in entries:
        env["PYTHONPATH"] = os.pathsep.join([*entries, root])
