"""Scans by date partition. Keys are compared as text, so partitions prune."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.times import iso_timestamp, moment
from marginlab.settings import Period


def in_period(column: str, period: Period) -> Column:
    return F.col(column).between(period.start, period.end)


def in_either(column: str, one: Period, other: Period) -> Column:
    """Whether the key is in one of two periods; of periods that meet, the ends alone are compared."""
    if max(one.start, other.start) <= min(one.end, other.end):
        return in_period(column, Period(min(one.start, other.start), max(one.end, other.end)))
    return in_period(column, one) | in_period(column, other)


def period_scan(df: DataFrame, period: Period, *columns: str) -> DataFrame:
    """Rows whose key columns all lie in the period (both ends included)."""
    for c in columns or ("dt",):
        df = df.filter(in_period(c, period))
    return df


def hour_scan(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of start <= dt < end."""
    return df.filter((F.col("dt") >= start) & (F.col("dt") < end))


def exact_hour_scan(df: DataFrame, hour: str) -> DataFrame:
    return df.filter(F.col("dt") == hour)


def latest_snapshot(
    df: DataFrame, as_of: str | datetime | date, max_age_days: int = 2, part_col: str = "dt"
) -> DataFrame:
    """Rows of the newest snapshot up to ``as_of`` and not older than ``max_age_days``; none if there is none.

    The newest key is a scalar subquery over the key column only, so the outer
    scan reads one partition.
    """
    oldest = moment(as_of) - F.expr(f"INTERVAL '{max_age_days}' DAY")
    newest = (
        df.filter(iso_timestamp(part_col).between(oldest, moment(as_of)))
        .agg(F.max(part_col).alias("newest"))
        .scalar()
    )
    return df.filter(F.col(part_col) == newest)
