"""Notification parsing and qualification."""

import json
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tessera.functions import correlation_id, decoded_key
from tessera.operators import qualifying_objects
from tessera.sources import parse_notifications

CREATED, REMOVED = "s3:ObjectCreated:CompleteMultipartUpload", "s3:ObjectRemoved:DeleteMarkerCreated"


def record(key, event=CREATED, bucket="landing"):
    place = {"object": {"key": key}}
    if bucket is not None:
        place["bucket"] = {"name": bucket}
    return {"s3": place, "eventName": event}


def payload(*records, **around):
    return json.dumps({**around, "Records": list(records)})


@pytest.fixture()
def qualify(spark):
    def run(payloads, **kw):
        df = spark.createDataFrame(list(enumerate(payloads)), "notification_id long, payload string")
        return {r["notification_id"]: r for r in qualifying_objects(parse_notifications(df), **kw).collect()}
    return run


@pytest.mark.parametrize("key", ["telemetry/notes.txt", "telemetry/a.parquet.tmp", "billing/a.parquet", "", "parquet"])
def test_other_objects_do_not_qualify(qualify, key):
    assert qualify([payload(record(key))]) == {}


def test_plain_key_gives_bucket_and_correlation_id(qualify):
    key = "telemetry/site=north/extraction_id=run-77/part-3.parquet"
    row = qualify([payload(record(key))])[0]
    assert (row["bucket"], row["object_key"], row["correlation_id"]) == ("landing", key, "run-77")


def test_encoded_key_is_decoded_and_is_its_own_correlation_id(qualify):
    key = "telemetry/site=north west/\u00fc+1.parquet"
    row = qualify([payload(record(quote(key, safe="")), extra={"size": 9})])[0]
    assert row["object_key"] == row["correlation_id"] == key


def test_missing_bucket_is_null(qualify):
    assert qualify([payload(record("telemetry/x.parquet", bucket=None))])[0]["bucket"] is None


def test_malformed_and_empty_payloads_give_no_row(qualify):
    assert qualify(["{", "[]", "{}", payload(), '{"Records": null}', '{"Records": 3}']) == {}


def test_first_qualifying_record_or_all(qualify, spark):
    mixed = payload(record("telemetry/old.parquet", REMOVED), record("telemetry/b.parquet"), record("telemetry/c.parquet"))
    assert [r["object_key"] for r in qualify([mixed]).values()] == ["telemetry/b.parquet"]
    df = spark.createDataFrame([(1, mixed)], "notification_id long, payload string")
    every = qualifying_objects(parse_notifications(df), all_records=True).collect()
    assert sorted(r["object_key"] for r in every) == ["telemetry/b.parquet", "telemetry/c.parquet"]


def test_key_functions(spark):
    df = spark.createDataFrame([("a%2Fextraction_id%3Dx1%2Ff+g.parquet",), ("%zz",), (None,)], "k string")
    out = df.select(decoded_key(F.col("k")).alias("d")).select("d", correlation_id(F.col("d")).alias("c")).collect()
    assert out[0]["d"] == "a/extraction_id=x1/f g.parquet" and out[0]["c"] == "x1"
    assert out[1]["d"] is None  # broken escape does not fail the batch
    assert out[2]["d"] == "" and out[2]["c"] == ""


@pytest.mark.parametrize("text, status", [
    ('{"Records":[{"eventName":"x"}]}', "valid"), ('{"Records":[{}],"more":1}', "valid"), ("{}", "empty"), ('{"Records":[]}', "empty"), ('{"Records":null}', "empty"),
    ("", "empty"), ("  ", "empty"), (None, "empty"), ("not json", "malformed"), ('{"Records":[', "malformed"), ('{"Records":"text"}', "malformed"), ("[1, 2]", "malformed"), ("7", "malformed"),
])
def test_malformed_is_told_from_empty(spark, text, status):
    from tessera.sources import rejected_notifications

    notes = parse_notifications(spark.createDataFrame([(text,)], "payload string"))
    assert notes.first()["notification_status"] == status
    assert [r["payload"] for r in rejected_notifications(notes).collect()] == ([text] if status == "malformed" else [])
    assert qualifying_objects(notes).count() == 0
