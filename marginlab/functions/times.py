"""Date and time expressions. The session time zone must be UTC."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text form of hour and day keys.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: str | datetime | date) -> Column:
    """A timestamp literal; stands for "now" so that results are repeatable."""
    return F.lit(str(value)).cast("timestamp")


def day_of(value: str | datetime | date) -> Column:
    """The day of a moment, as its first instant; stands for "today"."""
    return F.date_trunc("day", moment(value))


def iso_timestamp(c: str | Column) -> Column:
    """Parse ISO-8601 text (day, hour or full form)."""
    return col(c).cast("timestamp")


def timestamp_of_ms(c: str | Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(col(c))


def iso_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), ISO_FORMAT)


def hour_of_ms(c: str | Column) -> Column:
    """Hour that holds an epoch-millisecond instant, as a timestamp."""
    return F.date_trunc("hour", timestamp_of_ms(c))


def iso_hour_of_ms(c: str | Column) -> Column:
    return iso_text(hour_of_ms(c))


def day_of_iso(c: str | Column) -> Column:
    return F.date_trunc("day", iso_timestamp(c))


def full_days(start: str | Column, end: str | Column) -> Column:
    """Complete days from start to end (not midnights crossed)."""
    return F.timestamp_diff("DAY", col(start), col(end))


def within_days(later: str | Column, earlier: str | Column, days: int) -> Column:
    """later - earlier < days. There is no lower bound: a negative age counts."""
    return (col(later) - col(earlier)) < F.expr(f"INTERVAL '{days}' DAY")


def within_days_ms(later: str | Column, earlier: str | Column, days: int) -> Column:
    return (col(later) - col(earlier)) < F.lit(days * 24 * 60 * 60 * 1000)


def clamp_early(ts: str | Column, before: str, replacement: str) -> Column:
    """Times on days before a date are moved to one replacement time."""
    return F.when(F.to_date(col(ts)) < F.lit(before).cast("date"), moment(replacement)).otherwise(
        col(ts)
    )
