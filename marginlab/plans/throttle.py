"""Holdout against non-holdout: ratio metrics by campaign."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.buckets import holdout_split
from marginlab.functions.money import net_revenue_by_rate
from marginlab.functions.nested import ab_group
from marginlab.functions.times import iso_timestamp, within_days
from marginlab.operators.metrics import ratio_metrics
from marginlab.settings import Period, Settings
from marginlab.sources.scans import in_period
from marginlab.sources.warehouse import Warehouse


def throttle_sums(
    wh: Warehouse,
    cfg: Settings,
    dt_after: str,
    impressions: Period,
    installs: Period,
    campaigns: Sequence[int] | None = None,
) -> DataFrame:
    """Sums by campaign and split.

    The later events are a part of the rows of the earlier funnel and have the
    same keys, so one pass with conditional sums replaces a union of two scans.
    """
    group = ab_group("ab_test_assignments", cfg.test_id)
    rows = wh.supply_hourly.filter((F.col("dt") > dt_after) & in_period("impression_at", impressions))
    if campaigns is not None:
        rows = rows.filter(F.col("campaign_id").isin(*campaigns))
    rows = rows.withColumn("__group", group).filter(F.col("__group").isNotNull())
    rows = rows.withColumn("test_group_name", holdout_split("__group", cfg))

    later = in_period("install_at", installs)
    young = within_days(iso_timestamp("event_at"), iso_timestamp("install_at"), cfg.cohort_days)
    has_later = F.max(later)

    def cohort(c: str) -> Column:
        value = F.when(young, F.col(c)).otherwise(F.lit(0))
        return F.coalesce(F.sum(F.when(later, value)), F.lit(0))

    def early(value: Column) -> Column:
        total = F.sum(value)
        return F.coalesce(total, F.when(has_later, F.lit(0).cast("bigint")))

    on_network = F.col("exchange") == cfg.network_exchange
    by_rate = net_revenue_by_rate(
        "spend_micros", "pptype", on_network, cfg.network_rates, None,
        cfg.throttle_rate_scale, otherwise=None,
    )
    return rows.groupBy("campaign_id", "test_group_name").agg(
        early(F.col("spend_micros")).alias("spend_micros"),
        early(F.col("revenue_micros")).alias("revenue_micros"),
        F.coalesce(
            F.sum("revenue_micros") - F.sum("spend_micros"),
            F.when(has_later, F.lit(0).cast("bigint")),
        ).alias("net_micros"),
        F.coalesce(
            F.sum(by_rate).cast("double"), F.when(has_later, F.lit(0.0))
        ).alias("network_net_micros"),
        early(F.col("installs")).alias("installs"),
        cohort("customer_revenue_micros").alias("customer_revenue_micros_d7"),
        cohort("target_events").alias("events_d7"),
    )


def throttle_ratios(
    wh: Warehouse,
    cfg: Settings,
    dt_after: str,
    impressions: Period,
    installs: Period,
    event_goal: Sequence[int] | Column,
    campaigns: Sequence[int] | None = None,
) -> DataFrame:
    """Revenue per install, return or revenue per event, and net margins.

    ``event_goal`` lists the campaigns that are measured by events, or is a
    condition on the campaign.
    """
    sums = throttle_sums(wh, cfg, dt_after, impressions, installs, campaigns)
    units = {
        n: F.col(c).cast("double") / F.lit(1e6)
        for n, c in {
            "customer_revenue_d7": "customer_revenue_micros_d7",
            "spend": "spend_micros",
            "revenue": "revenue_micros",
            "net": "net_micros",
            "network_net": "network_net_micros",
        }.items()
    }
    metrics = sums.withColumns(units).withColumn("long_net", F.col("network_net") + F.col("net"))
    goal = event_goal if isinstance(event_goal, Column) else F.col("campaign_id").isin(*event_goal)
    return ratio_metrics(metrics, ["campaign_id", "test_group_name"], goal)
