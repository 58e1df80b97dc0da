"""Time expressions. Timestamps are zone-less (TIMESTAMP_NTZ) and built without the
session time zone, so results do not depend on where the job runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def epoch_seconds_to_ntz(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("long"), _epoch_ntz())


def epoch_millis_to_ntz(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis.cast("long"), _epoch_ntz())


def epoch_seconds_of(ts: Column) -> Column:
    """Whole epoch seconds of a zone-less timestamp, from its fields (days since
    1970 and time of day), so no session time zone takes part."""
    ntz = ts.cast("timestamp_ntz")
    return (F.unix_date(ntz.cast("date")).cast("long") * 86400
            + F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz))


def date_parts(ts: Column) -> list[Column]:
    """Year, month and day as integers, named for the Silver partition levels."""
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day")]
