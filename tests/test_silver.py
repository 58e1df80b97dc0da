"""Silver files and the replace-by-extraction table (FIXTURES 3a-3d; H7-H9)."""

import datetime as dt
import glob
import os

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.functions import path_safe, silver_prefix
from tessera.plans.queries import QUERIES
from tessera.schemas import SILVER_FILE, TELEMETRY
from tessera.sinks.directories import put_in_place, read_directories, replace_directories
from tessera.sinks.silver import ensure_schemas, read_silver_files, write_silver_files
from tessera.sinks.table import TABLE_KEY, TableConflict, buckets_for, merge_buckets, rebucket, remove_unused, replace_rows, upsert_telemetry

TS = dt.datetime(2026, 5, 28, 20, 26, 40)  # 1780000000000 ms
DAY_DIR = "telemetry/technology=ImberaLink/device_id=B4A2EB428B04/year=2026/month=5/day=28"


@pytest.fixture()
def place(workdir):
    """Name and location of a new table."""
    return f"silver.t_{os.urandom(6).hex()}", f"{workdir}/table"


@pytest.fixture()
def records(spark):
    def make(extraction, rows):
        return spark.createDataFrame(
            [(n, v, TS, "ImberaLink", "B4A2EB428B04", extraction) for n, v in rows],
            "name string, value double, timestamp timestamp_ntz, technology string, device_id string, "
            "extraction_id string")
    return make


def _files(root, extraction):
    return glob.glob(f"{root}/{DAY_DIR}/extraction_id={extraction}/*.parquet")


def _write(records_df, root, place):
    write_silver_files(records_df, root)
    upsert_telemetry(records_df, *place, buckets=4)


def test_layout_and_table(spark, records, workdir, place):
    root = f"{workdir}/silver"
    _write(records("ext-1", [("compressor_state", 1.0), ("door_state", 0.0)]), root, place)
    assert os.path.isdir(f"{root}/{DAY_DIR}")
    assert _files(root, "ext-1")
    assert spark.table(place[0]).count() == 2
    back = read_silver_files(spark, root).collect()
    assert {(r["source_device_id"], r["year"], r["month"], r["day"]) for r in back} == {
        ("B4A2EB428B04", 2026, 5, 28)}


def test_empty_records_write_nothing(spark, records, workdir, place):
    root = f"{workdir}/silver"
    _write(records("ext-1", []), root, place)
    assert not glob.glob(f"{root}/**/*.parquet", recursive=True)
    assert not glob.glob(f"{place[1]}/**/*.parquet", recursive=True) and spark.table(place[0]).count() == 0


def test_redelivery_replaces_rows_and_file(spark, records, workdir, place):
    root = f"{workdir}/silver"
    _write(records("ext-redelivered", [("compressor_state", 1.0), ("door_state", 0.0)]), root, place)
    _write(records("ext-redelivered", [("compressor_state", 1.0), ("door_state", 0.0),
                                       ("internal_temperature", 4.5)]), root, place)
    assert len(_files(root, "ext-redelivered")) == 1
    rows = spark.table(place[0]).where(F.col("extraction_id") == "ext-redelivered")
    assert rows.count() == 3
    assert read_silver_files(spark, root).count() == 3


def test_two_extractions_accumulate(spark, records, workdir, place):
    root = f"{workdir}/silver"
    _write(records("ext-a", [("compressor_state", 1.0)]), root, place)
    _write(records("ext-b", [("door_state", 0.0)]), root, place)
    assert len(_files(root, "ext-a")) == 1 and len(_files(root, "ext-b")) == 1
    assert spark.table(place[0]).count() == 2


def test_upsert_touches_only_its_buckets(spark, place):
    upsert_telemetry(_keyed(spark, 20, 1.0), *place, buckets=4)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{place[1]}/*/bucket=*/*.parquet")}
    upsert_telemetry(_keyed(spark, 1, 9.0, 3), *place)
    rows = spark.table(place[0]).collect()
    assert len(rows) == 20
    assert [r["value"] for r in rows if r["extraction_id"] == "ext-3"] == [9.0]
    touched = spark.table(place[0]).where("extraction_id = 'ext-3'").select("bucket").first()[0]
    now = {x.removeprefix("file://") for x in spark.table(place[0]).inputFiles()}
    assert {p for p in before if f"bucket={touched}/" not in p} <= now
    assert all(os.path.getmtime(p) == before[p] for p in before)  # what readers may hold is still there


def test_path_safe_rules(spark):
    df = spark.createDataFrame([(" a/b\\c d:e ",), ("   ",), ("",), (":",), (None,)], "v string")
    out = [r[0] for r in df.select(path_safe(F.col("v"))).collect()]
    assert out == ["a_b_c_de", "unknown", "unknown", "", "unknown"]


def test_silver_prefix(spark):
    df = spark.createDataFrame([("ImberaLink", "AA:BB")], "t string, d string")
    out = df.select(silver_prefix("s3://silver/", F.col("t"), F.col("d"))).first()[0]
    assert out == "s3://silver/telemetry/technology=ImberaLink/device_id=AABB/"


def test_ensure_schemas(spark, workdir):
    ensure_schemas(spark, workdir)
    ensure_schemas(spark, workdir)  # idempotent
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"bronze", "silver", "gold"} <= names


def test_new_extraction_next_to_existing_ones_keeps_them(spark, records, workdir):
    root = f"{workdir}/silver"
    write_silver_files(records("ext-a", [("compressor_state", 1.0)]), root)
    write_silver_files(records("ext-b", [("door_state", 0.0)]), root)          # append path
    write_silver_files(records("ext-a", [("fan_state", 1.0), ("door_state", 1.0)]), root)  # replace path
    back = sorted((r["source_extraction_id"], r["name"]) for r in read_silver_files(spark, root).collect())
    assert back == [("ext-a", "door_state"), ("ext-a", "fan_state"), ("ext-b", "door_state")]


def test_escaped_partition_values_take_the_replace_path(spark, workdir):
    root = f"{workdir}/silver"
    rows = [("s", 1.0, TS, "ImberaLink", "dev#1", "ext=1")]
    schema = ("name string, value double, timestamp timestamp_ntz, technology string, device_id string, "
              "extraction_id string")
    write_silver_files(spark.createDataFrame(rows, schema), root)
    write_silver_files(spark.createDataFrame([("t", 2.0) + rows[0][2:]], schema), root)
    assert [r["name"] for r in read_silver_files(spark, root).collect()] == ["t"]


def test_schemas_of_the_catalog(spark, records, workdir):
    ensure_schemas(spark, workdir)
    name = f"gold.telemetry_{os.urandom(3).hex()}"
    upsert_telemetry(records("ext-1", [("compressor_state", 1.0), ("door_state", 0.0)]), name, f"{workdir}/table", buckets=4)
    upsert_telemetry(records("ext-1", [("compressor_state", 0.0)]), name, f"{workdir}/table", buckets=4)
    assert [(r["name"], r["value"]) for r in spark.sql(f"SELECT * FROM {name}").collect()] == [("compressor_state", 0.0)]
    assert [f.name for f in spark.table(name).schema] == [*TELEMETRY.fieldNames(), "bucket"]


def test_bucket_count_follows_table_size():
    assert buckets_for(0) == 1
    assert buckets_for(256 << 20) == 1
    assert buckets_for((256 << 20) + 1) == 2
    assert buckets_for(32 << 40) == 131072  # 32 TB at ~256 MB per bucket


def _keyed(spark, n, value, first=0):
    return spark.createDataFrame(
        [("s", value, TS, "ImberaLink", f"D{i}", f"ext-{i}") for i in range(first, first + n)],
        "name string, value double, timestamp timestamp_ntz, technology string, device_id string, extraction_id string")


def _values(spark, place):
    return sorted(r["value"] for r in spark.table(place[0]).collect())


def test_a_crash_before_the_catalog_knows_loses_nothing(spark, place):
    upsert_telemetry(_keyed(spark, 20, 1.0), *place, buckets=4)
    again = _keyed(spark, 5, 2.0)
    merge_buckets(again, again.select(*TABLE_KEY), *place, TELEMETRY, TABLE_KEY, 4)
    assert _values(spark, place) == [1.0] * 20
    upsert_telemetry(again, *place)
    assert _values(spark, place) == [1.0] * 15 + [2.0] * 5


def test_repeated_upserts_end_the_same(spark, place):
    for _ in range(3):
        upsert_telemetry(_keyed(spark, 20, 1.0), *place, buckets=4)
        upsert_telemetry(_keyed(spark, 5, 2.0, 3), *place)
        assert _values(spark, place) == [1.0] * 15 + [2.0] * 5


def test_one_catalog_call_for_all_known_buckets(spark, place, monkeypatch):
    """No statement a bucket: their number does not depend on how many buckets a replace touches."""
    from pyspark.sql import SparkSession

    said, real = [], SparkSession.sql
    monkeypatch.setattr(SparkSession, "sql", lambda self, q, *a, **k: said.append(q) or real(self, q, *a, **k))
    sizes = []
    for n in (2, 300):
        upsert_telemetry(_keyed(spark, n, 1.0), *place, buckets=64)
        said.clear()
        upsert_telemetry(_keyed(spark, n, 2.0), *place)
        sizes.append(len(said))
    assert sizes[0] == sizes[1] < 10
    assert _values(spark, place) == [2.0] * 300


def test_concurrent_writers_lose_no_rows(spark, place):
    from concurrent.futures import ThreadPoolExecutor

    upsert_telemetry(_keyed(spark, 1, 0.0, 99), *place, buckets=1)

    def write(i):
        try:
            upsert_telemetry(_keyed(spark, 1, float(i), i), *place)
            return True
        except TableConflict:
            return False

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(write, range(4)))
    rows = {r["extraction_id"] for r in spark.table(place[0]).collect()}
    assert rows == {"ext-99", *(f"ext-{i}" for i in range(4) if done[i])}  # a writer that gave up said so
    assert sum(done) >= 1


def test_rows_replaced_by_none(spark, place):
    upsert_telemetry(_keyed(spark, 20, 1.0), *place, buckets=4)
    gone = _keyed(spark, 18, 1.0)
    replace_rows(gone.where("false"), *place, TELEMETRY, TABLE_KEY, replaced=gone)
    assert sorted(r["extraction_id"] for r in spark.table(place[0]).collect()) == ["ext-18", "ext-19"]


def test_another_bucket_count_is_refused(spark, place):
    upsert_telemetry(_keyed(spark, 20, 1.0), *place, buckets=16)
    with pytest.raises(ValueError, match="16 buckets"):
        upsert_telemetry(_keyed(spark, 20, 2.0), *place, buckets=4)
    upsert_telemetry(_keyed(spark, 20, 2.0), *place)  # without a count: the table's own
    assert _values(spark, place) == [2.0] * 20
    rebucket(spark, place[0], TABLE_KEY, 4)
    assert {r["bucket"] for r in spark.table(place[0]).collect()} <= {0, 1, 2, 3} and _values(spark, place) == [2.0] * 20
    upsert_telemetry(_keyed(spark, 20, 3.0), *place, buckets=4)
    assert _values(spark, place) == [3.0] * 20


def test_rows_of_a_table_that_the_catalog_lost_are_not_hidden(spark, place):
    upsert_telemetry(_keyed(spark, 2, 1.0), *place, buckets=4)
    with pytest.raises(ValueError, match="does not know"):
        upsert_telemetry(_keyed(spark, 2, 2.0), f"{place[0]}_other", place[1])


def test_files_follow_buckets_not_tasks(spark, place):
    upsert_telemetry(_keyed(spark, 400, 1.0).repartition(32), *place, buckets=16)
    upsert_telemetry(_keyed(spark, 400, 2.0).repartition(32), *place)
    for folder in glob.glob(f"{place[1]}/replace=*"):
        assert len(glob.glob(f"{folder}/bucket=*/*.parquet")) <= 2 * 16


def test_unused_folders_are_removed_when_old(spark, place):
    for i in range(4):
        upsert_telemetry(_keyed(spark, 8, float(i)), *place, buckets=2)
    upsert_telemetry(_keyed(spark, 1, 9.0), *place)  # one bucket of the last folder stays in use
    assert remove_unused(spark, place[0]) == 0  # too young
    assert remove_unused(spark, place[0], hours=0) == 7
    assert len(glob.glob(f"{place[1]}/replace=*/bucket=*")) == 2 and len(glob.glob(f"{place[1]}/replace=*")) == 2
    assert _values(spark, place) == [3.0] * 7 + [9.0]


def test_two_writers_of_an_extraction_leave_one_copy(spark, records, workdir):
    """Both list what is there, and write, before either commits; whoever commits last stays."""
    from concurrent.futures import ThreadPoolExecutor

    root = f"{workdir}/silver"
    write_silver_files(records("ext-z", [("door_state", 1.0)]), root)
    many = [records("ext-a", [(f"s{i}", float(w)) for i in range(50)]) for w in range(2)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda df: write_silver_files(df, root), many))
    rows = read_silver_files(spark, root).where("extraction_id = 'ext-a'").collect()
    assert len(rows) == 50 and len({r["value"] for r in rows}) == 1
    assert read_silver_files(spark, root).count() == 51


def test_a_silver_write_that_breaks_off_changes_nothing(spark, records, workdir):
    root = f"{workdir}/silver"
    write_silver_files(records("ext-a", [("compressor_state", 1.0)]), root)
    broken = records("ext-a", [("fan_state", 1.0)] * 100).withColumn("value", F.when(F.rand(1) < 0.5, F.raise_error(F.lit("lost"))).otherwise(F.col("value")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_silver_files(broken, root)
    assert [r["name"] for r in read_silver_files(spark, root).collect()] == ["compressor_state"]
    write_silver_files(records("ext-a", [("fan_state", 1.0)]), root)
    assert [r["name"] for r in read_silver_files(spark, root).collect()] == ["fan_state"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from tessera.session import shared_root

    nowhere = SimpleNamespace(isDefined=lambda: False)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(
        master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: nowhere))))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(cluster)


def _children_faults(spark):
    """Page faults of the processes that the driver's JVM has run and seen end."""
    with open(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/stat") as f:
        return int(f.read().rpartition(")")[2].split()[8])


def test_a_mounted_silver_root_takes_no_process_for_each_directory(spark, workdir):
    rows = _keyed(spark, 100, 1.0)
    write_silver_files(rows.limit(1), f"{workdir}/warm")
    before = _children_faults(spark)
    write_silver_files(rows, f"{workdir}/silver")
    assert _children_faults(spark) - before < 100 * 100  # a chmod alone has some hundred
    assert read_silver_files(spark, f"{workdir}/silver").count() == 100


def test_directories_are_named_as_by_spark_and_hold_the_same_rows(spark, workdir):
    odd = ["a b", "x=y", "c:d", "100%", "", None, "q?*", "[z]{^}", "it's \"#\"", "back\\slash", "tab\t", "plain-1_2.3", "é"]
    rows = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(odd)] * 2, "n int, word string, year int")
    rows.write.partitionBy("word", "year").parquet(f"{workdir}/spark")
    replace_directories(rows.repartition(3), f"{workdir}/tasks", ["word", "year"])

    def found(root):
        return {os.path.relpath(p, root) for p, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files)}

    def read(root):
        return sorted(map(str, spark.read.schema("n int, word string, year int").parquet(root).collect()))

    assert found(f"{workdir}/tasks") == found(f"{workdir}/spark")
    assert read(f"{workdir}/tasks") == read(f"{workdir}/spark")
    assert all(not x.startswith(".staging") for x in os.listdir(f"{workdir}/tasks"))


def test_a_directory_of_several_tasks_is_replaced_once(spark, workdir):
    for n in (1000, 400):
        replace_directories(spark.range(n).select("id", F.lit("a").alias("d")).repartition(4), f"{workdir}/t", ["d"])
    assert spark.read.parquet(f"{workdir}/t").agg(F.count("*"), F.countDistinct("id")).first()[:] == (400, 400)
    assert len(os.listdir(f"{workdir}/t/d=a")) == 4


def test_a_repeated_move_leaves_what_is_in_place(workdir):
    fs = pyarrow.fs.LocalFileSystem()
    for name in ("staged", "place"):
        os.makedirs(f"{workdir}/{name}")
        open(f"{workdir}/{name}/of-{name}", "w").close()
    assert put_in_place(fs, f"{workdir}/staged", f"{workdir}/place")
    assert not put_in_place(fs, f"{workdir}/staged", f"{workdir}/place")
    assert os.listdir(f"{workdir}/place") == ["of-staged"]


def test_the_driver_holds_no_list_of_a_mounted_roots_files(spark, workdir):
    write_silver_files(_keyed(spark, 100, 1.0), f"{workdir}/silver")
    back = read_silver_files(spark, f"{workdir}/silver")
    assert back.inputFiles() == []  # of Spark's reader: one a directory
    assert back.schema == SILVER_FILE and sorted(r["extraction_id"] for r in back.collect()) == sorted(f"ext-{i}" for i in range(100))


def test_directories_read_by_tasks_give_what_spark_reads(spark, workdir):
    odd = ["a b", "x=y", "c:d", "100%", "", None, "q?*", "[z]{^}", "it's \"#\"", "back\\slash", "tab\t", "plain-1_2.3", "é", "%zz", "%41"]
    rows = spark.createDataFrame([(i, v, None if i == 3 else i % 2) for i, v in enumerate(odd)] * 3, "n int, word string, year int")
    rows.repartition(4).write.partitionBy("word", "year").parquet(f"{workdir}/t")
    day = f"{workdir}/t/word=a b/year=0"
    pq.write_table(pa.table({"more": ["x"], "m": [1.5]}), f"{day}/other-columns.parquet")
    pq.write_table(pa.table({"n": pa.array([], pa.int32())}), f"{day}/no-rows.parquet")
    for name in ("_hidden", ".hidden", "copied._COPYING_", "empty.parquet"):
        open(f"{day}/{name}", "w").close()
    os.makedirs(f"{workdir}/t/.staging-1/word=a/year=1")
    os.makedirs(f"{workdir}/t/word=nothing/year=1")
    schema = spark.createDataFrame([], "n int, m double, word string, year int").schema
    by_spark, by_tasks = spark.read.schema(schema).parquet(f"{workdir}/t"), read_directories(spark, f"{workdir}/t", schema, ["word", "year"])
    assert by_tasks.schema == by_spark.schema
    assert sorted(map(str, by_tasks.collect())) == sorted(map(str, by_spark.collect()))
    assert by_tasks.count() == 3 * len(odd) + 1


def test_a_large_file_is_read_by_several_tasks_each_row_once(spark, workdir):
    os.makedirs(f"{workdir}/t/d=a")
    pq.write_table(pa.table({"n": pa.array(range(50_000), pa.int64())}), f"{workdir}/t/d=a/x.parquet", row_group_size=1_000)
    schema = spark.createDataFrame([], "n long, d string").schema
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        back = read_directories(spark, f"{workdir}/t", schema, ["d"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert back.agg(F.count("*"), F.countDistinct("n"), F.min("d"), F.max("d")).first()[:] == (50_000, 50_000, "a", "a")
    assert back.select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize("stray", ["x.parquet", "d=a/x.parquet", "d=a/e=b/f=c/x.parquet", "other=a/e=b/x.parquet"])
def test_files_where_none_belong_are_not_passed_over(spark, workdir, stray):
    for path in ("d=b/e=c/x.parquet", stray):
        os.makedirs(os.path.dirname(f"{workdir}/t/{path}"), exist_ok=True)
        pq.write_table(pa.table({"n": [1]}), f"{workdir}/t/{path}")
    schema = spark.createDataFrame([], "n long, d string, e string").schema
    with pytest.raises(Exception, match="not a "):
        read_directories(spark, f"{workdir}/t", schema, ["d", "e"]).collect()


def test_a_root_that_is_not_there_is_said_and_an_empty_one_has_no_rows(spark, workdir):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_silver_files(spark, f"{workdir}/silver")
    os.makedirs(f"{workdir}/silver/telemetry")
    assert read_silver_files(spark, f"{workdir}/silver").count() == 0


def test_the_round_trip_reads_back_all_rows_without_a_list_of_files(spark, workdir):
    rows = [(i, TS + dt.timedelta(hours=i), i % 7) for i in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").write.parquet(f"{workdir}/events.parquet")
    back = QUERIES["silver_roundtrip"](spark, workdir)
    assert back.inputFiles() == []  # of Spark's reader: one a directory
    columns = ["name", "value", "timestamp", "technology", "device_id", "extraction_id"]
    decoded = QUERIES["telemetry_decoded"](spark, workdir).collect()
    assert decoded and sorted(map(str, back.select(columns).collect())) == sorted(map(str, decoded))
    assert {(r["year"], r["month"], r["day"]) for r in back.collect()} == {(t.year, t.month, t.day) for t in (r["timestamp"] for r in decoded)}
