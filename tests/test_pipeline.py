"""End to end over Bronze files (FIXTURES 1c, 5.2; H1, H4, H14)."""

import glob
import os

import pytest
from builders import DEVICE, ELTEC_DEVICE, OTHER_DEVICE, event, new_target, payload
from pyspark.sql import functions as F

from tessera.operators import decode_audit
from tessera.plans.pipeline import bronze_to_silver, documents_of, reprocess
from tessera.schemas import BRONZE_CHUNKS
from tessera.session import Workspace, shared_root
from tessera.sources import read_bronze
from tessera.sources.bronze import read_objects, scan_chunks

DAY_DIR = f"telemetry/technology=ImberaLink/device_id={DEVICE}/year=2025/month=11/day=3"
ONE_OBJECT = [event("run-7", n) for n in (1, 2, 3)]


def put_object(spark, root, prefix, rows, mtime=None):
    """Write rows as one Parquet object below ``root/prefix``; return its key."""
    spark.createDataFrame(rows, BRONZE_CHUNKS).coalesce(1).write.mode("overwrite").parquet(f"{root}/{prefix}")
    path = glob.glob(f"{root}/{prefix}/*.parquet")[0]
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return os.path.relpath(path, root)


def table_rows(spark, target):
    return sorted(tuple(r) for r in spark.table(target.table).drop("bucket").collect())


def test_reads_object_columns_and_key(spark, workdir):
    key = put_object(spark, f"{workdir}/bronze", "telemetry/extraction_id=run-7", ONE_OBJECT)
    with Workspace(spark, "test") as work:
        rows = read_bronze(spark, f"{workdir}/bronze", [key], work).collect()
    assert len(rows) == 3
    assert {r["object_key"] for r in rows} == {key}
    assert {r["extraction_id"] for r in rows} == {"run-7"}  # file column, not the path segment


def test_decodes_one_object_and_writes_silver(spark, workdir):
    bronze = f"{workdir}/bronze"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    target = new_target(workdir)
    outcome = bronze_to_silver(spark, bronze, [key], target).collect()
    assert [(o["status"], o["n_documents"], o["n_records"]) for o in outcome] == [("processed", 3, 12)]
    assert outcome[0]["silver_prefix"].endswith(f"/telemetry/technology=ImberaLink/device_id={DEVICE}/")
    assert glob.glob(f"{target.silver_root}/{DAY_DIR}/extraction_id=run-7/*.parquet")
    assert len(table_rows(spark, target)) == 12


def test_rerun_is_idempotent(spark, workdir):
    bronze = f"{workdir}/bronze"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    target = new_target(workdir)
    bronze_to_silver(spark, bronze, [key], target).collect()
    first = table_rows(spark, target)
    reprocess(spark, bronze, [key], target).collect()
    assert table_rows(spark, target) == first
    assert len(glob.glob(f"{target.silver_root}/telemetry/**/*.parquet", recursive=True)) == 1


def _deliveries(spark, bronze):
    # run-7: a smaller second delivery replaces the first one.
    k1 = put_object(spark, bronze, "telemetry/extraction_id=run-7/d1", ONE_OBJECT, mtime=1_000)
    k2 = put_object(spark, bronze, "telemetry/extraction_id=run-7/d2", ONE_OBJECT[:1], mtime=2_000)
    # run-9: the second delivery has no payload, so it replaces nothing.
    k3 = put_object(spark, bronze, "telemetry/extraction_id=run-9/d1",
                    [event("run-9", 7, device=OTHER_DEVICE, technology=None)], mtime=1_000)
    k4 = put_object(spark, bronze, "telemetry/extraction_id=run-9/d2",
                    [event("run-9", 0, device=OTHER_DEVICE, technology=None, kind=None)], mtime=2_000)
    return [k1, k2, k3, k4]


def test_one_batch_equals_one_by_one(spark, workdir):
    bronze = f"{workdir}/bronze"
    keys = _deliveries(spark, bronze)
    together, apart = new_target(workdir, "together"), new_target(workdir, "apart")
    outcomes = {o["object_key"]: o for o in bronze_to_silver(spark, bronze, keys, together).collect()}
    for key in keys:
        bronze_to_silver(spark, bronze, [key], apart).collect()
    assert table_rows(spark, together) == table_rows(spark, apart)
    rows = table_rows(spark, together)
    assert sum(1 for r in rows if r[5] == "run-7") == 4   # only the second delivery's one document
    assert sum(1 for r in rows if r[5] == "run-9") == 4   # first delivery kept
    assert outcomes[keys[3]]["status"] == "empty" and outcomes[keys[3]]["silver_prefix"] is None


def test_missing_object_is_reported_not_fatal(spark, workdir):
    bronze = f"{workdir}/bronze"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    target = new_target(workdir)
    outcomes = {o["object_key"]: (o["status"], o["error"]) for o in
                bronze_to_silver(spark, bronze, [key, "telemetry/gone.parquet"], target).collect()}
    assert outcomes == {key: ("processed", None), "telemetry/gone.parquet": ("missing", "object not found")}


def test_object_mixing_devices_is_flagged(spark, workdir):
    bronze = f"{workdir}/bronze"
    mixed = ONE_OBJECT[:1] + [event("run-8", 5, device=OTHER_DEVICE, technology=None)]
    key = put_object(spark, bronze, "telemetry/mixed", mixed)
    target = new_target(workdir)
    out = bronze_to_silver(spark, bronze, [key], target).collect()
    assert out[0]["single_device"] is False
    # Each record still carries its own document's envelope.
    rows = spark.table(target.table).select("device_id", "extraction_id").distinct()
    assert rows.where(F.col("extraction_id") == "run-8").first()["device_id"] == OTHER_DEVICE


def test_corrupt_and_empty_objects_are_reported_not_fatal(spark, workdir):
    bronze = f"{workdir}/bronze"
    good = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    os.makedirs(f"{bronze}/telemetry/bad", exist_ok=True)
    with open(f"{bronze}/telemetry/bad/x.parquet", "wb") as fh:
        fh.write(b"this is not parquet")
    empty = put_object(spark, bronze, "telemetry/empty", [])
    out = {o["object_key"]: o["status"] for o in
           bronze_to_silver(spark, bronze, [good, "telemetry/bad/x.parquet", empty], new_target(workdir)).collect()}
    assert out == {good: "processed", "telemetry/bad/x.parquet": "unreadable", empty: "unreadable"}


def test_rejected_documents_go_to_the_side_table(spark, workdir):
    bronze = f"{workdir}/bronze"
    rows = [*ONE_OBJECT[:1], event("run-7", 4, firmware="136"), event("run-7", 5, kind=None), event("run-7", 6, data=payload(1)[:10])]
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", rows)
    other = put_object(spark, bronze, "telemetry/extraction_id=run-9", [event("run-9", 2, device=ELTEC_DEVICE)])
    target = new_target(workdir)
    target.rejects_table = f"{target.table}_rejects"

    def rejects():
        return {(r["extraction_id"], r["document_sequence"], r["decode_reason"]) for r in spark.table(target.rejects_table).collect()}

    for _ in range(2):  # replaced by a re-run
        bronze_to_silver(spark, bronze, [key, other], target)
        assert rejects() == {("run-7", 4, "no_layout"), ("run-7", 5, "no_type"), ("run-7", 6, "bad_payload"), ("run-9", 2, "no_layout")}
        assert spark.table(target.rejects_table).count() == 4
    spark.createDataFrame(ONE_OBJECT, BRONZE_CHUNKS).coalesce(1).write.parquet(f"{workdir}/mended")
    os.replace(glob.glob(f"{workdir}/mended/*.parquet")[0], f"{bronze}/{key}")
    bronze_to_silver(spark, bronze, [key], target)  # also by none
    assert rejects() == {("run-9", 2, "no_layout")}


def test_command_line_reprocess(spark, workdir, capsys):
    from tessera.__main__ import main

    bronze = f"{workdir}/bronze"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    name = f"cli_ns_{os.urandom(3).hex()}.telemetry_decoded"
    main(["reprocess", "--bronze-root", bronze, "--silver-root", f"{workdir}/silver",
          "--table", name, "--buckets", "4", "--outcomes-path", f"{workdir}/outcomes", key])
    printed = capsys.readouterr().out
    assert "processed" in printed and "ok=3" in printed and "n_records=12" in printed
    assert [r["status"] for r in spark.read.parquet(f"{workdir}/outcomes").collect()] == ["processed"]
    assert spark.table(name).count() == 12


def test_command_line_backfill_reads_every_object(spark, workdir, capsys):
    from tessera.__main__ import main

    bronze, name = f"{workdir}/bronze", f"silver.cli_{os.urandom(3).hex()}"
    put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    put_object(spark, bronze, "telemetry/extraction_id=run-9", [event("run-9", 7, device=OTHER_DEVICE, firmware="136")])
    layouts = f"silver.layouts_{os.urandom(3).hex()}"
    spark.sql("CREATE SCHEMA IF NOT EXISTS silver")
    spark.createDataFrame([("ImberaLink", "136", None, "EVENTS", 6, "whole", 32, 16)], "technology string, firmware string, id_type string, type string, "
                          "payload_bytes int, field string, bit_offset int, bit_width int").write.option("path", f"{workdir}/layouts").saveAsTable(layouts)
    main(["backfill", "--bronze-root", bronze, "--silver-root", f"{workdir}/silver", "--table", name, "--buckets", "4", "--layouts", layouts])
    assert "processed" in capsys.readouterr().out
    assert [r["name"] for r in spark.table(name).collect()] == ["whole"]


def _damage(path):
    with open(path, "r+b") as fh:
        fh.seek(8)
        fh.write(b"\xff" * 64)


def test_a_damaged_redelivery_leaves_the_old_rows(spark, workdir):
    bronze, target = f"{workdir}/bronze", new_target(workdir)
    many = [event("run-7", i) for i in range(2000)]
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", many)
    bronze_to_silver(spark, bronze, [key], target)
    _damage(f"{bronze}/{key}")
    out = bronze_to_silver(spark, bronze, None, target).collect()
    assert [(o["object_key"], o["status"], o["n_documents"]) for o in out] == [(key, "unreadable", 0)] and out[0]["error"]
    assert len(table_rows(spark, target)) == 8000


def test_odd_keys_fail_nobody(spark, workdir):
    bronze, target = f"{workdir}/bronze", new_target(workdir)
    names = ["telemetry/device=X Y", "telemetry/a%b", "telemetry/a+b", "telemetry/\u00e9", "telemetry/dev[1]", "telemetry/dev{1,2}", "telemetry/st*r?"]
    keys = []
    for i, name in enumerate(names):
        plain = put_object(spark, bronze, f"plain/{i}", [event(f"run-{i}", 1)])
        os.makedirs(f"{bronze}/{name}")
        os.rename(f"{bronze}/{plain}", f"{bronze}/{name}/x.parquet")
        keys.append(f"{name}/x.parquet")
    want = {k: ("processed", 4) for k in keys}
    assert {o["object_key"]: (o["status"], o["n_records"]) for o in bronze_to_silver(spark, bronze, keys, target).collect()} == want
    assert {o["object_key"]: (o["status"], o["n_records"]) for o in bronze_to_silver(spark, bronze, None, new_target(workdir, "all")).collect()} == want


def test_other_integer_widths_and_bad_types(spark, workdir):
    bronze, target = f"{workdir}/bronze", new_target(workdir)
    wide = spark.createDataFrame(ONE_OBJECT, BRONZE_CHUNKS).withColumn("document_sequence", F.col("document_sequence").cast("long"))
    too_wide = wide.withColumn("document_sequence", F.lit(1 << 40))
    keys = []
    for name, df in (("wide", wide), ("too-wide", too_wide)):
        df.coalesce(1).write.parquet(f"{bronze}/telemetry/{name}")
        keys.append(os.path.relpath(glob.glob(f"{bronze}/telemetry/{name}/*.parquet")[0], bronze))
    out = {o["object_key"]: o for o in bronze_to_silver(spark, bronze, keys, target).collect()}
    assert (out[keys[0]]["status"], out[keys[0]]["n_records"]) == ("processed", 12)
    assert out[keys[1]]["status"] == "unreadable" and "does not fit document_sequence" in out[keys[1]]["error"]


def test_bytes_that_cannot_be_read_are_not_taken_as_processed(spark, workdir):
    bronze, target = f"{workdir}/bronze", new_target(workdir)
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    os.remove(f"{bronze}/{key}")
    os.symlink("/proc/self/mem", f"{bronze}/{key}")  # opens, but reading fails
    try:
        out = bronze_to_silver(spark, bronze, [key], target).collect()
    except Exception:
        out = None
    assert out is None or out[0]["status"] == "unreadable"
    assert not spark.catalog.tableExists(target.table)


def test_chunk_bytes_stay_in_the_jvm(spark, workdir):
    """Only keys and footers meet Python; the scan reads the nine chunk columns."""
    bronze = f"{workdir}/bronze"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    plan = scan_chunks(spark, bronze, [key])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan and "Batched: true" in plan
    read = plan.partition("ReadSchema: struct<")[2]
    assert read.startswith("extraction_id:string,id_controller:string,technology:string,id_type:string,ble_version:str")
    with Workspace(spark, "test") as work:
        chunks, objects = read_objects(spark, bronze, [key], work)
        for df in (chunks, objects):
            assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()


def test_roots_may_be_written_in_other_ways(spark, workdir):
    """A relative root, a URI, a trailing slash, a space in the name."""
    bronze = f"{workdir}/bro nze"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    for root in (os.path.relpath(bronze), f"file://{bronze}", f"file:{bronze}/", f"{bronze}/"):
        for keys in ([key], None):
            with Workspace(spark, "test") as work:
                chunks, objects = read_objects(spark, root, keys, work)
                assert [(r["object_key"], r["object_status"]) for r in objects.collect()] == [(key, "read")], root
                assert chunks.where(F.col("object_key") == key).count() == 3


def test_many_keys_are_scanned_some_at_a_time(spark, workdir):
    bronze = f"{workdir}/bronze"
    keys = [put_object(spark, bronze, f"telemetry/extraction_id=run-{i}", [event(f"run-{i}", 1)]) for i in range(7)]
    with Workspace(spark, "test") as work:
        chunks, objects = read_objects(spark, bronze, keys, work, paths_at_once=2)
        assert {(r["object_key"], r["object_status"]) for r in objects.collect()} == {(k, "read") for k in keys}
        assert sorted(r["extraction_id"] for r in chunks.collect()) == [f"run-{i}" for i in range(7)]


def test_counters_equal_the_audit(spark, workdir):
    bronze, counts = f"{workdir}/bronze", {}
    rows = [*ONE_OBJECT, event("run-7", 4, firmware="136"), event("run-7", 5, kind=None), event("run-7", 6, data="zz" + payload()[2:])]
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", rows)
    bronze_to_silver(spark, bronze, [key], new_target(workdir), counts=counts)
    audit = {r["decode_reason"]: r["documents"] for r in decode_audit(documents_of(spark.createDataFrame(rows, BRONZE_CHUNKS).withColumn("object_key", F.lit(key)))).collect()}
    assert {k: n for k, n in counts.items() if n} == {**audit, "n_records": 12}
    counts.clear()
    bronze_to_silver(spark, bronze, ["telemetry/gone.parquet"], new_target(workdir), counts=counts)  # no document at all
    assert set(counts.values()) == {0}


def _shared(spark):
    return set(os.listdir(shared_root(spark).removeprefix("file://").removeprefix("file:")))


def test_staging_is_removed(spark, workdir, monkeypatch):
    import tessera.plans.pipeline as pipeline

    bronze, target = f"{workdir}/bronze", new_target(workdir)
    target.rejects_table = f"{target.table}_rejects"
    key = put_object(spark, bronze, "telemetry/extraction_id=run-7", ONE_OBJECT)
    before = _shared(spark)
    with Workspace(spark, "test") as work:
        assert bronze_to_silver(spark, bronze, [key], target, work=work).count() == 1
    assert _shared(spark) == before

    def fail(*_, **__):
        raise RuntimeError("the table is away")

    monkeypatch.setattr(pipeline, "upsert_telemetry", fail)
    with pytest.raises(RuntimeError, match="away"):
        bronze_to_silver(spark, bronze, [key], target)
    assert _shared(spark) == before
