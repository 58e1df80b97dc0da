"""Notification feed -> Structured Streaming (available-now) -> Silver, equal to batch."""

import glob
import os
import time

from builders import DEVICE, ELTEC_DEVICE, OTHER_DEVICE, event, new_target, payload, split
from pyspark.sql import functions as F

from tessera.operators import telemetry
from tessera.plans.pipeline import records_of
from tessera.plans.staging import notify, stage_bronze_objects, stage_notifications
from tessera.schemas import BRONZE_CHUNKS
from tessera.session import shared_root
from tessera.streaming.stream import dead_letters, stream_silver

ROWS = [
    event("run-1", 1),
    *split(event("run-1", 2), 8),
    event("run-2", 1, device=OTHER_DEVICE, technology="Softel"),
    event("run-3", 1, device=ELTEC_DEVICE, technology="Softel"),
]


def run_to_end(*args, **more):
    query = stream_silver(*args, available_now=True, **more)
    query.awaitTermination()
    assert query.exception() is None


def test_available_now_stream_matches_batch(spark, workdir):
    chunks = spark.createDataFrame(ROWS, BRONZE_CHUNKS)
    bronze, feed = f"{workdir}/bronze", f"{workdir}/feed"
    stage_bronze_objects(chunks, bronze)
    stage_notifications(spark, bronze, feed, files=3)
    # Noise the consumer must skip without failing: garbage, a removal, a foreign key.
    with open(f"{feed}/noise.txt", "w") as fh:
        fh.write("not json\n{}\n")
        fh.write('{"Records":[{"eventName":"s3:ObjectRemoved:Delete","s3":{"object":{"key":"telemetry%2Fx.parquet"}}}]}\n')
    target = new_target(workdir)
    query = stream_silver(spark, feed, bronze, target, checkpoint=f"{workdir}/ckpt",
                          outcomes_path=f"{workdir}/outcomes", available_now=True, max_files_per_trigger=2)
    query.awaitTermination()
    assert query.exception() is None
    got = sorted(tuple(r) for r in telemetry(spark.table(target.table)).collect())
    want = sorted(tuple(r) for r in telemetry(records_of(chunks)).collect())
    assert got == want and len(got) == 12
    outcomes = spark.read.parquet(f"{workdir}/outcomes").collect()
    assert {o["status"] for o in outcomes} == {"processed", "empty"}
    assert glob.glob(f"{target.silver_root}/telemetry/technology=ImberaLink/**/*.parquet", recursive=True)


def test_restart_from_checkpoint_processes_nothing_twice(spark, workdir):
    chunks = spark.createDataFrame(ROWS[:1], BRONZE_CHUNKS)
    bronze, feed = f"{workdir}/bronze", f"{workdir}/feed"
    stage_bronze_objects(chunks, bronze)
    stage_notifications(spark, bronze, feed, files=1)
    target = new_target(workdir)
    for _ in range(2):
        q = stream_silver(spark, feed, bronze, target, checkpoint=f"{workdir}/ckpt", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    assert spark.table(target.table).count() == 4


def test_failed_batch_is_replayed_to_the_same_result(spark, workdir, monkeypatch):
    import tessera.plans.pipeline as pipeline

    chunks = spark.createDataFrame(ROWS, BRONZE_CHUNKS)
    bronze, feed = f"{workdir}/bronze", f"{workdir}/feed"
    stage_bronze_objects(chunks, bronze)
    stage_notifications(spark, bronze, feed, files=1)
    target = new_target(workdir)

    real_upsert = pipeline.upsert_telemetry

    def crash_after_files(*args, **kwargs):
        raise RuntimeError("lost the batch after the Silver files were written")

    monkeypatch.setattr(pipeline, "upsert_telemetry", crash_after_files)
    q = stream_silver(spark, feed, bronze, target, checkpoint=f"{workdir}/ckpt", available_now=True,
                      max_attempts=1)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    files_before = sorted(glob.glob(f"{target.silver_root}/telemetry/**/*.parquet", recursive=True))
    assert files_before

    monkeypatch.setattr(pipeline, "upsert_telemetry", real_upsert)
    q = stream_silver(spark, feed, bronze, target, checkpoint=f"{workdir}/ckpt", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    got = sorted(tuple(r) for r in telemetry(spark.table(target.table)).collect())
    want = sorted(tuple(r) for r in telemetry(records_of(chunks)).collect())
    assert got == want
    # The replay replaced the directories instead of adding a second file to each.
    files_after = glob.glob(f"{target.silver_root}/telemetry/**/*.parquet", recursive=True)
    assert len(files_after) == len(files_before)


def test_transient_failure_is_retried_within_the_batch(spark, workdir, monkeypatch):
    import tessera.plans.pipeline as pipeline

    chunks = spark.createDataFrame(ROWS, BRONZE_CHUNKS)
    bronze, feed = f"{workdir}/bronze", f"{workdir}/feed"
    stage_bronze_objects(chunks, bronze)
    stage_notifications(spark, bronze, feed, files=1)
    target = new_target(workdir)
    real_upsert, calls = pipeline.upsert_telemetry, []

    def conflict_once(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("write conflict")
        return real_upsert(*args, **kwargs)

    monkeypatch.setattr(pipeline, "upsert_telemetry", conflict_once)
    q = stream_silver(spark, feed, bronze, target, checkpoint=f"{workdir}/ckpt", available_now=True)
    q.awaitTermination()
    assert q.exception() is None and len(calls) == 2
    got = sorted(tuple(r) for r in telemetry(spark.table(target.table)).collect())
    assert got == sorted(tuple(r) for r in telemetry(records_of(chunks)).collect())


def test_running_stream_picks_up_new_notifications(spark, workdir):
    bronze, feed = f"{workdir}/bronze", f"{workdir}/feed"
    os.makedirs(feed)
    target = new_target(workdir)
    q = stream_silver(spark, feed, bronze, target, checkpoint=f"{workdir}/ckpt", processing_time="1 second")
    try:
        def deliver(rows, name):
            stage_bronze_objects(spark.createDataFrame(rows, BRONZE_CHUNKS), f"{bronze}/{name}")
            key = glob.glob(f"{bronze}/{name}/telemetry/**/*.parquet", recursive=True)[0]
            rel = key[len(bronze) + 1:].replace("/", "%2F").replace("=", "%3D")
            with open(f"{feed}/{name}.json", "w") as fh:
                fh.write('{"Records":[{"eventName":"s3:ObjectCreated:Put","s3":{"object":{"key":"%s"}}}]}\n' % rel)

        def table_rows():
            if not spark.catalog.tableExists(target.table):
                return []
            return spark.table(target.table).where(F.col("extraction_id") == "run-1").collect()

        def wait_for(pred, seconds=120):
            deadline = time.time() + seconds
            while time.time() < deadline:
                if pred():
                    return True
                time.sleep(1)
            return False

        deliver(ROWS[:1], "d1")
        assert wait_for(lambda: len(table_rows()) == 4)
        time.sleep(1.1)  # a later modification time for the re-delivery
        deliver([event("run-1", 1, data=payload(0, 1, 1, 1, 1))], "d2")  # same extraction, all fields ON
        assert wait_for(lambda: sorted(r["value"] for r in table_rows()) == [1.0, 1.0, 1.0, 1.0])
    finally:
        q.stop()
    assert q.exception() is None


def test_a_waiting_object_comes_back_until_it_is_there_or_dead(spark, workdir):
    """One object appears before its second delivery, one never; a fresh notification starts over."""
    bronze, feed, state, outcomes = (f"{workdir}/{x}" for x in ("bronze", "feed", "redelivery", "outcomes"))
    stage_bronze_objects(spark.createDataFrame(ROWS[:1], BRONZE_CHUNKS), f"{workdir}/later")
    key = os.path.relpath(glob.glob(f"{workdir}/later/**/*.parquet", recursive=True)[0], f"{workdir}/later")
    target, never = new_target(workdir), "telemetry/never.parquet"

    def deliver(*keys):
        if keys:
            notify(spark.createDataFrame([(k,) for k in keys], "object_key string"), feed)
        else:
            spark.range(1).select(F.lit("{}").alias("value")).write.mode("append").text(feed)
        run_to_end(spark, feed, bronze, target, f"{workdir}/ckpt", outcomes, redelivery_path=state, max_deliveries=3)
        return {(r["object_key"], r["deliveries"], r["status"]) for r in spark.read.parquet(outcomes).collect()}

    assert deliver(key, never) == {(key, 1, "missing"), (never, 1, "missing")}
    os.makedirs(os.path.dirname(f"{bronze}/{key}"))
    os.rename(f"{workdir}/later/{key}", f"{bronze}/{key}")
    assert deliver() >= {(key, 2, "processed"), (never, 2, "missing")}
    assert spark.table(target.table).count() == 4
    assert dead_letters(spark, state).count() == 0
    assert (never, 3, "missing") in deliver()
    assert [(r["object_key"], r["deliveries"], r["status"]) for r in dead_letters(spark, state).collect()] == [(never, 3, "missing")]
    assert max(n for _, n, _ in deliver()) == 3 and len(deliver()) == 5  # it does not come back any more
    deliver(never)
    before = spark.read.parquet(outcomes).count()
    deliver(never)  # again notified: counts from one
    assert spark.read.parquet(outcomes).where("deliveries = 1").count() == 4 and spark.read.parquet(outcomes).count() == before + 1
    assert len(glob.glob(f"{state}/waiting/*/after=*")) <= 2


def test_a_replayed_batch_counts_a_delivery_once(spark, workdir, monkeypatch):
    import tessera.streaming.stream as stream

    feed, state = f"{workdir}/feed", f"{workdir}/redelivery"
    notify(spark.createDataFrame([("telemetry/never.parquet",)], "object_key string"), feed)
    real, calls = stream.Redelivery.settle, []

    def settle_then_fail(self, *args):
        real(self, *args)
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("lost after the state was written")

    monkeypatch.setattr(stream.Redelivery, "settle", settle_then_fail)
    run_to_end(spark, feed, f"{workdir}/bronze", new_target(workdir), f"{workdir}/ckpt", f"{workdir}/outcomes", redelivery_path=state)
    assert len(calls) == 3
    assert [r["deliveries"] for r in spark.read.parquet(f"{workdir}/outcomes").collect()] == [1]


def test_admission_by_bytes_takes_every_key(spark, workdir):
    chunks = spark.createDataFrame([event(f"run-{i}", 1) for i in range(12)], BRONZE_CHUNKS)
    bronze, feed, target = f"{workdir}/bronze", f"{workdir}/feed", new_target(workdir)
    stage_bronze_objects(chunks, bronze)
    stage_notifications(spark, bronze, feed, files=6)
    size = max(os.path.getsize(p) for p in glob.glob(f"{feed}/*.txt"))
    run_to_end(spark, feed, bronze, target, f"{workdir}/ckpt", f"{workdir}/outcomes", max_bytes_per_trigger=size + 1)
    outcomes = spark.read.parquet(f"{workdir}/outcomes")
    assert outcomes.select("batch_id").distinct().count() >= 3
    assert outcomes.count() == 12 and spark.table(target.table).count() == 48


def test_whole_file_payloads_and_rejected_notifications(spark, workdir):
    bronze, feed, target, rejects = f"{workdir}/bronze", f"{workdir}/feed", new_target(workdir), f"{workdir}/rejects"
    stage_bronze_objects(spark.createDataFrame(ROWS[:1], BRONZE_CHUNKS), bronze)
    key = os.path.relpath(glob.glob(f"{bronze}/**/*.parquet", recursive=True)[0], bronze)
    os.makedirs(feed)
    for name, text in (("a", '{"Records": [\n  {"eventName": "s3:ObjectCreated:Put",\n   "s3": {"object": {"key": "%s"}}}\n]}\n' % key), ("b", '{"Records": [\n'), ("c", "{}")):
        with open(f"{feed}/{name}.json", "w") as fh:
            fh.write(text)
    run_to_end(spark, feed, bronze, target, f"{workdir}/ckpt", whole_files=True, notification_rejects_path=rejects)
    assert spark.table(target.table).count() == 4
    assert [r["payload"] for r in spark.read.parquet(rejects).collect()] == ['{"Records": [\n']


def test_a_stream_of_three_batches_leaves_no_staging(spark, workdir):
    bronze, feed = f"{workdir}/bronze", f"{workdir}/feed"
    stage_bronze_objects(spark.createDataFrame(ROWS, BRONZE_CHUNKS), bronze)
    stage_notifications(spark, bronze, feed, files=3)
    shared = shared_root(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(shared))
    run_to_end(spark, feed, bronze, new_target(workdir), f"{workdir}/ckpt", f"{workdir}/outcomes", max_files_per_trigger=1)
    assert set(os.listdir(shared)) == before
