"""Time expressions.  Every clock reading is a parameter, so results can be repeated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"

# Local hours [from, to) that count as peak.
PEAK_HOURS = ((8, 10), (18, 21))
# dayofweek() numbers: Sunday is 1, Saturday is 7.
WEEKEND_DAYS = (1, 7)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def parsed_time(df: DataFrame, column: str = "event_time") -> Column:
    """The column as a timestamp.  Text that is no timestamp becomes null instead of
    failing the job (ANSI ``to_timestamp`` would stop a stream on one bad line)."""
    if type_of(df, column) == "string":
        return F.try_to_timestamp(column)
    return F.col(column)


def clock(as_of: datetime | str | None, kind: str = "timestamp") -> Column:
    """``as_of`` as a literal of type ``kind``; the wall clock only when it is None."""
    if as_of is None:
        return F.localtimestamp() if kind == NTZ else F.current_timestamp()
    return F.lit(str(as_of)).cast(kind)


def window_start(kind: str, as_of: datetime | str | None, minutes: int) -> Column:
    """``minutes`` before the clock, as a ``kind`` of timestamp."""
    return clock(as_of, kind) - F.make_dt_interval(mins=F.lit(minutes))


def trailing_window(
    df: DataFrame, as_of: datetime | str | None, minutes: int, column: str = "event_time"
) -> Column:
    """``column >= as_of - minutes``, with no upper bound.

    The date condition follows from the time condition; it is stated so that whole
    ``event_date`` partitions are skipped without opening a file.
    """
    start = window_start(type_of(df, column), as_of, minutes)
    bound = F.col(column) >= start
    if "event_date" in df.columns:
        bound = bound & (F.col("event_date") >= F.to_date(start))
    return bound


def whole_minutes(df: DataFrame, as_of: datetime | str | None, minutes: int, column: str) -> Column:
    """Of stored minutes, those that lie in the trailing window as a whole: all behind its first one."""
    kind = type_of(df, column)
    start = window_start(kind, as_of, minutes)
    first = F.date_trunc("minute", start).cast(kind)
    return (F.col(column) > first) & (F.col("event_date") >= F.to_date(start))


def first_minute(
    df: DataFrame, as_of: datetime | str | None, minutes: int, column: str = "event_time"
) -> Column:
    """The part of the trailing window's first minute that lies in it: no stored minute tells it."""
    kind = type_of(df, column)
    start = window_start(kind, as_of, minutes)
    end = (F.date_trunc("minute", start) + F.make_dt_interval(mins=F.lit(1))).cast(kind)
    inside = (F.col(column) >= start) & (F.col(column) < end)
    return inside & (F.col("event_date") == F.to_date(start)) if "event_date" in df.columns else inside


def minute_of(df: DataFrame, column: str = "event_time") -> Column:
    """Start of the minute, of the same type as the column."""
    return F.date_trunc("minute", column).cast(df.schema[column].dataType)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(*WEEKEND_DAYS)


def is_peak(time: Column, zone: str | None = None, source_zone: str | None = None) -> Column:
    """Whether the wall-clock hour falls in a peak window.

    Without ``zone`` the hour is read as shown.  With it, the time is moved from
    ``source_zone`` (default: the session zone) to ``zone`` first.
    """
    if zone is not None:
        source = F.lit(source_zone) if source_zone else F.current_timezone()
        time = F.convert_timezone(source, F.lit(zone), time.cast(NTZ))
    hour = F.hour(time)
    windows = [(hour >= start) & (hour < end) for start, end in PEAK_HOURS]
    return windows[0] | windows[1]
