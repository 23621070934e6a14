"""Time expressions that do not depend on the session time zone.

Instants are `timestamp_ntz` columns in UTC.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# level -> width of its buckets; None is the local day of the configured zone
BUCKET_WIDTHS = {
    "agg_line_15m": timedelta(minutes=15),
    "agg_stop_15m": timedelta(minutes=15),
    "agg_line_1h": timedelta(hours=1),
    "agg_line_1d": None,
}


def ntz(value: datetime) -> Column:
    """Literal for an instant; an aware datetime is brought to UTC first."""
    return F.lit(to_utc(value).isoformat(sep=" ")).cast("timestamp_ntz")


def to_utc(value: datetime) -> datetime:
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds (number or digits as text) -> UTC instant."""
    return F.timestamp_add("SECOND", seconds.cast("bigint"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def to_instant(ts: Column) -> Column:
    """UTC wall time -> `timestamp`, the type that event time has in a stream; in any session zone."""
    return F.make_timestamp(
        F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.extract(F.lit("SECOND"), ts), F.lit("UTC")
    )


def from_instant(instant: Column) -> Column:
    """`timestamp` of whole seconds -> UTC wall time."""
    return from_epoch(F.unix_seconds(instant))


def local_date(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts).cast("date")


def service_date(day: Column, day_offset: Column) -> Column:
    """Operating day of a trip seen on `day`: trips past 24:00 belong to the day before."""
    return F.date_sub(day, day_offset)


def utc_bucket(ts: Column, width: str) -> Column:
    """Start of the bucket; valid for widths that divide the hour offset of the zone."""
    return F.window(ts, width)["start"]


def local_day_bucket(ts: Column, zone: str) -> Column:
    """UTC instant of the local midnight before `ts` (days of 23 and 25 hours included)."""
    midnight = local_date(ts, zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight)


def bucket_start(value: datetime, width: timedelta | None, zone: str) -> datetime:
    """Start of the bucket that holds a UTC instant (scalar form, for job parameters)."""
    value = to_utc(value)
    if width is not None:
        return value - (value - datetime(1970, 1, 1)) % width
    local = value.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone))
    return to_utc(datetime(local.year, local.month, local.day, tzinfo=ZoneInfo(zone)))


def bucket_ceiling(value: datetime, width: timedelta | None, zone: str) -> datetime:
    """First bucket start at or after a UTC instant."""
    value = to_utc(value)
    start = bucket_start(value, width, zone)
    if start == value:
        return start
    if width is not None:
        return start + width
    # 26 hours past local midnight always lie in the next local day
    return bucket_start(start + timedelta(hours=26), None, zone)


def level_bucket(time: Column, level: str, zone: str) -> Column:
    """Start of the bucket of an aggregate level that holds an instant."""
    width = BUCKET_WIDTHS[level]
    if width is None:
        return local_day_bucket(time, zone)
    return utc_bucket(time, f"{int(width.total_seconds())} seconds")


def buckets_of(lo: datetime, hi: datetime, level: str, zone: str) -> list[datetime]:
    """Starts of the whole buckets in [lo, hi), whose ends are edges of buckets."""
    found, width = [], BUCKET_WIDTHS[level]
    while lo < hi:
        found.append(lo)
        lo = bucket_start(lo + (width or timedelta(hours=26)), width, zone)
    return found
