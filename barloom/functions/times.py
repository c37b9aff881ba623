"""Conversions between epoch milliseconds, instants and zone-less UTC times.

None of them depends on the session time zone: zone-less values are reached by
adding to or subtracting from a zone-less epoch, never by casting an instant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Years 0001 to 9999: the range Spark timestamps print and parse.
MIN_MS = -62_135_596_800_000
MAX_MS = 253_402_300_799_999


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def floor_div(value: Column, by: int) -> Column:
    """BIGINT division rounded down; ``/`` would pass through a double."""
    n = F.lit(by).cast("bigint")
    return F.call_function("div", value - F.pmod(value, n), n)


def micros_of_day_time(interval: Column) -> Column:
    """A day-time interval, such as the difference of two zone-less times, in
    microseconds. ``timestampdiff`` would read both times in the session zone."""

    def part(name: str) -> Column:
        return F.extract(F.lit(name), interval)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def ms_to_utc(ms: Column) -> Column:
    """Epoch milliseconds to a zone-less UTC time."""
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def ms_to_instant(ms: Column) -> Column:
    """Epoch milliseconds to a TIMESTAMP, the type watermarks need."""
    return F.timestamp_millis(ms)


def utc_wall(instant: Column) -> Column:
    """TIMESTAMP to the zone-less UTC wall time of the same instant."""
    return micros_to_utc(F.unix_micros(instant))


def as_utc(df: DataFrame, name: str) -> Column:
    """Column ``name`` as zone-less UTC time, whichever timestamp type it has."""
    if df.schema[name].dataType.typeName() == "timestamp":
        return utc_wall(F.col(name))
    return F.col(name)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Timestamp column ``name`` as microseconds since the epoch, in UTC."""
    if df.schema[name].dataType.typeName() == "timestamp":
        return F.unix_micros(F.col(name))
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
        return F.unix_micros(F.col(name).cast("timestamp"))  # same result, much cheaper
    return micros_of_day_time(F.col(name) - _epoch())


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Timestamp column ``name`` as milliseconds since the epoch, fractions cut."""
    return floor_div(epoch_micros(df, name), 1000)


def micros_to_utc(micros: Column) -> Column:
    """Microseconds since the epoch to a zone-less UTC time."""
    return F.timestamp_add("MICROSECOND", micros, _epoch())


# Microseconds per unit of a window width.
_WIDTH_UNITS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def width_micros(width: str) -> int:
    """A window width such as ``1 minute`` in microseconds."""
    count, unit = width.split()
    return int(count) * _WIDTH_UNITS[unit.lower().rstrip("s")]


def date_parts(ms: Column) -> dict[str, Column]:
    """Zero-padded year, month and day text of epoch milliseconds, in UTC."""
    day = ms_to_utc(ms).cast("date")
    return {
        "year": F.lpad(F.year(day).cast("string"), 4, "0"),
        "month": F.lpad(F.month(day).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    }
