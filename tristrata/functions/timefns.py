"""Time functions on wall-clock timestamps (TIMESTAMP_NTZ), which no time zone shifts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted text formats.
DEFAULT_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS]"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_ts(value: Column | str, fmt: str = DEFAULT_FORMAT, strict: bool = True) -> Column:
    """Text to wall-clock timestamp. ``strict`` raises on bad text, else it gives null."""
    parsed = F.to_timestamp_ntz(_column(value), F.lit(fmt))
    if strict:
        return parsed
    return F.when(F.try_to_timestamp(_column(value), F.lit(fmt)).isNotNull(), parsed)


def format_ts(value: Column | str, fmt: str = DEFAULT_FORMAT) -> Column:
    """Timestamp to text; an instant is shown in the session time zone.

    ``date_format`` would shift a wall-clock time that the session time zone does not have, so
    this goes through the JSON writer, which formats either kind as it is.
    """
    formats = {"timestampFormat": fmt, "timestampNTZFormat": fmt, "dateFormat": fmt}
    text = F.to_json(F.struct(_column(value).alias("t")), formats)
    return F.get_json_object(text, "$.t")


def truncate_ntz(value: Column | str, unit: str) -> Column:
    """Wall-clock timestamp cut to its ``hour``, ``day`` or ``month``.

    ``date_trunc`` goes through the session time zone, which has hours that do not exist.
    """
    day = _column(value).cast("date")
    if unit == "month":
        return F.trunc(day, "month").cast("timestamp_ntz")
    midnight = day.cast("timestamp_ntz")
    if unit == "day":
        return midnight
    if unit == "hour":
        return midnight + F.make_dt_interval(hours=F.hour(_column(value)))
    raise ValueError(f"unknown unit: {unit}")


def add_days(value: Column | str, days: Column | int) -> Column:
    """``days`` may be negative, and may be a column."""
    n = days if isinstance(days, Column) else F.lit(days)
    return _column(value) + F.make_dt_interval(days=n.cast("int"))


def add_hours(value: Column | str, hours: Column | int) -> Column:
    n = hours if isinstance(hours, Column) else F.lit(hours)
    return _column(value) + F.make_dt_interval(hours=n.cast("int"))


def now() -> Column:
    return F.localtimestamp()


def to_event_time(text: Column | str, strict: bool = False) -> Column:
    """ISO-8601 text to an instant. With ANSI on, ``strict`` stops the job on bad text."""
    return F.to_timestamp(_column(text)) if strict else F.try_to_timestamp(_column(text))
