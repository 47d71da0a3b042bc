"""Time conversions between epoch values, timestamps and the text forms of the warehouse.

All functions expect a session running in UTC and shift to ``tz`` explicitly,
so a result never depends on the zone of the machine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text patterns of the warehouse tables.
DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
COMPACT_DATE = "yyyyMMdd"


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds to an event-time column."""
    return F.timestamp_millis(ms.cast("bigint"))


def from_seconds(seconds: Column) -> Column:
    """Epoch seconds to an event-time column."""
    return F.timestamp_seconds(seconds.cast("bigint"))


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def local(ts: Column, tz: str = "UTC") -> Column:
    """Wall-clock time of an instant in ``tz``."""
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def local_date(ts: Column, tz: str = "UTC") -> Column:
    """Calendar day as DATE.  Use it for keys; format text only after aggregating."""
    return F.to_date(local(ts, tz))


def date_text(ts: Column, tz: str = "UTC") -> Column:
    return F.date_format(local(ts, tz), DATE)


def datetime_text(ts: Column, tz: str = "UTC") -> Column:
    """24-hour form; a 12-hour pattern would make 01:00 and 13:00 equal."""
    return F.date_format(local(ts, tz), DATETIME)


def compact_date_text(ts: Column, tz: str = "UTC") -> Column:
    return F.date_format(local(ts, tz), COMPACT_DATE)


def parse_millis(text: Column, tz: str = "UTC", pattern: str = DATETIME) -> Column:
    """Date or datetime text, read as wall-clock time of ``tz``, to epoch milliseconds.

    Text that does not match the pattern gives null.
    """
    wall = F.try_to_timestamp(text, F.lit(pattern))
    return F.unix_millis(wall if tz == "UTC" else F.to_utc_timestamp(wall, tz))


def window_bounds(window: str = "window", tz: str = "UTC") -> list[Column]:
    """``stt``, ``edt`` and ``cur_date`` text columns of a window column."""
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    return [
        datetime_text(start, tz).alias("stt"),
        datetime_text(end, tz).alias("edt"),
        date_text(start, tz).alias("cur_date"),
    ]
