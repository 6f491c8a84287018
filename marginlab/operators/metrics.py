"""Metrics over aggregated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginlab.functions.money import safe_ratio


def previous_period(
    df: DataFrame, keys: Sequence[str], ts: str, cols: Mapping[str, str]
) -> DataFrame:
    """Add ``{name: column}`` of the previous *row* by key (not calendar day).

    For tables with one row per key and period: a group is as long as the
    history has periods.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(ts).asc_nulls_last())
    return df.withColumns({n: F.lag(c, 1).over(w) for n, c in cols.items()})


def ratio_metrics(df: DataFrame, keys: Sequence[str], event_goal: Column) -> DataFrame:
    """Ratios of sums. Campaigns with an event goal get revenue per event, others return."""
    total = {
        c: F.sum(c)
        for c in ("revenue", "installs", "events_d7", "customer_revenue_d7", "long_net", "net")
    }
    sums = df.groupBy(*keys).agg(*[e.alias(f"__{c}") for c, e in total.items()])
    s = {c: F.col(f"__{c}") for c in total}
    return sums.select(
        *keys,
        safe_ratio(s["revenue"], s["installs"]).alias("rpi"),
        F.when(event_goal, safe_ratio(s["revenue"], s["events_d7"])).alias("rpa_7d"),
        F.when(
            F.coalesce(event_goal, F.lit(False)), F.lit(None).cast("double")
        ).otherwise(safe_ratio(s["customer_revenue_d7"], s["revenue"])).alias("roas_7d"),
        safe_ratio(s["long_net"], s["revenue"]).alias("long_net_margin"),
        safe_ratio(s["net"], s["revenue"]).alias("net_margin"),
    )
