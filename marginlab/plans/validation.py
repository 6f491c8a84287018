"""The published dataset against the trusted daily table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.money import micros
from marginlab.functions.times import day_of_iso
from marginlab.operators.quality import reconcile
from marginlab.settings import Period, Settings
from marginlab.sources.scans import in_period, period_scan
from marginlab.sources.warehouse import Warehouse


def _daily(df: DataFrame, value: str, on_network: Column) -> DataFrame:
    return df.groupBy(day_of_iso("dt").alias("dt"), "campaign_id").agg(
        F.sum(micros(value)).alias("revenue"),
        F.sum(micros(F.when(on_network, F.col(value)))).alias("network_revenue"),
    )


def published_check(
    wh: Warehouse,
    cfg: Settings,
    days: Period,
    impressions: Period,
    campaigns: Sequence[int] | None = None,
) -> DataFrame:
    """Days and campaigns whose published revenue is off; none means the check passed."""
    trusted = period_scan(wh.daily_fact, days)
    published = period_scan(wh.published_dataset, days).filter(
        in_period("impression_at", impressions)
    )
    if campaigns is not None:
        trusted, published = (
            df.filter(F.col("campaign_id").isin(*campaigns)) for df in (trusted, published)
        )
    return reconcile(
        _daily(trusted, "revenue_micros", F.col("exchange") == cfg.network_exchange),
        _daily(published, "test_revenue_micros", F.col("exchange_group") == cfg.network_label),
        ["dt", "campaign_id"],
        ["revenue", "network_revenue"],
        cfg.tolerance,
    ).orderBy("dt", "campaign_id")
