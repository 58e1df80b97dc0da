"""Zone-less time functions."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import date_parts, epoch_millis_to_ntz, epoch_seconds_to_ntz
from tessera.functions.time import epoch_seconds_of


def test_epoch_to_zone_less_timestamp_and_date_parts(spark):
    df = spark.createDataFrame([(1780000000000,)], "ms long")
    row = df.select(epoch_millis_to_ntz(F.col("ms")).alias("ts")).select("ts", *date_parts(F.col("ts"))).first()
    assert row["ts"] == dt.datetime(2026, 5, 28, 20, 26, 40)
    assert (row["year"], row["month"], row["day"]) == (2026, 5, 28)  # unpadded integers


def test_seconds_round_trip(spark):
    df = spark.createDataFrame([(0,), (1_000_000,), (1_704_067_207,)], "s long")
    back = df.select(epoch_seconds_of(epoch_seconds_to_ntz(F.col("s"))).alias("b")).collect()
    assert [r["b"] for r in back] == [0, 1_000_000, 1_704_067_207]
