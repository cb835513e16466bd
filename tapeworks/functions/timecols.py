"""Time columns: epoch arithmetic, bucket floors and zone rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
# Fixed value: the zone every label and folder key is rendered in.
EASTERN = "America/New_York"


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def floor_to(us: Column, width: int) -> Column:
    """Start of the bucket of ``width`` microseconds that holds ``us``."""
    return us - F.pmod(us, F.lit(width))


def millis(us: Column) -> Column:
    return F.unix_millis(F.timestamp_micros(us))


def local_time(ts: Column, zone: str = EASTERN) -> Column:
    return F.from_utc_timestamp(ts, zone)


def zone_text(ts: Column, zone: str = EASTERN) -> Column:
    return F.date_format(local_time(ts, zone), "yyyy-MM-dd HH:mm:ss")


def iso_text(ts: Column, zone: str = EASTERN) -> Column:
    """ISO-8601 with the offset that holds in ``zone`` at that instant."""
    local = local_time(ts, zone)
    minutes = F.timestamp_diff("MINUTE", ts, local)
    size = F.abs(minutes)
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def folder_keys(ts: Column, zone: str = EASTERN) -> dict[str, Column]:
    """Zero-padded partition keys of the hour folder an instant belongs to."""
    local = local_time(ts, zone)
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(local, pattern) for name, pattern in patterns.items()}
