"""Health checks: what the test covers, and which campaigns it reaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.nested import ab_group, json_scalar
from marginlab.functions.times import moment
from marginlab.operators.dims import in_list, keep_keys, last_update_filter
from marginlab.operators.history import change_events, changed_only
from marginlab.plans.common import (
    MARGINS,
    NEW,
    OLD,
    PAIRS,
    margin_base,
    margin_events,
    with_old_and_new,
)
from marginlab.settings import Period, Settings
from marginlab.sources.scans import period_scan
from marginlab.sources.warehouse import Warehouse


def _supply(wh: Warehouse, period: Period) -> DataFrame:
    return period_scan(wh.supply_hourly, period, "dt", "impression_at")


def _in_test(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    group = ab_group("ab_test_assignments", cfg.test_id)
    return (
        _supply(wh, period)
        .select("campaign_id", "spend_micros", "revenue_micros", group.alias("test_group_name"))
        .filter(F.col("test_group_name").isNotNull())
    )


def _totals() -> list[Column]:
    return [
        F.countDistinct("campaign_id").alias("campaign_count"),
        F.sum("spend_micros").alias("test_spend_micros"),
        F.sum("revenue_micros").alias("test_revenue_micros"),
    ]


def tested_campaigns(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    """Campaigns with traffic in the test."""
    return (
        _in_test(wh, cfg, period).select("campaign_id").distinct()
        .orderBy(F.col("campaign_id").asc_nulls_last())
    )


def group_totals(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    """Campaign count, spend and revenue by test group."""
    return _in_test(wh, cfg, period).groupBy("test_group_name").agg(*_totals())


def business_totals(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    """The same totals over all traffic."""
    return _supply(wh, period).agg(*_totals())


def enabled_count(wh: Warehouse, cfg: Settings, after: str) -> DataFrame:
    """Campaigns with margin changes after a time, by target."""
    events = margin_events(wh, cfg, where=F.col("logged_at") > moment(after))
    return events.groupBy("target").agg(F.countDistinct("campaign_id").alias("campaign_count"))


def enabled_list(wh: Warehouse, cfg: Settings) -> DataFrame:
    """Campaign of every margin change; duplicates stay."""
    return margin_events(wh, cfg).select("campaign_id")


def enabled_totals(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    """Totals of the campaigns with margin changes."""
    return keep_keys(_supply(wh, period), "campaign_id", enabled_list(wh, cfg)).agg(*_totals())


def _by_last_update(wh: Warehouse, cfg: Settings, op: str, day: str) -> DataFrame:
    return last_update_filter(
        margin_events(wh, cfg), ["campaign_id", "target"], "updated_at", op, day
    )


def last_update_count(wh: Warehouse, cfg: Settings, day: str, op: str = "<") -> DataFrame:
    """Campaigns by target whose last update is before ("<") or since (">=") a day."""
    return (
        _by_last_update(wh, cfg, op, day).groupBy("target")
        .agg(F.countDistinct("campaign_id").alias("campaign_count"))
    )


def last_update_list(wh: Warehouse, cfg: Settings, day: str, op: str = "<") -> DataFrame:
    return _by_last_update(wh, cfg, op, day).select("campaign_id").distinct()


def _stale_events(wh: Warehouse, cfg: Settings, last_day: str) -> DataFrame:
    logged = [json_scalar("new_values", m).isNotNull() for m in MARGINS]
    events = change_events(
        wh.change_log,
        margin_base(wh, with_limit=True),
        cfg.log_margins,
        where=logged[0] & logged[1],
    )
    return events.filter(
        F.col("base_margin_type").isNotNull()
        & (F.to_date("updated_at") <= F.lit(last_day).cast("date"))
    )


def stale_campaigns(wh: Warehouse, cfg: Settings, last_day: str) -> DataFrame:
    """Margin rows that were last updated on or before a day."""
    return (
        _stale_events(wh, cfg, last_day)
        .select(
            "campaign_id", "updated_at", F.col("base_margin_type").alias("margin_type"),
            *[F.col(m).alias(n) for m, n in zip(MARGINS, NEW)],
            "target", "threshold", "daily_revenue_limit",
        )
        # Further columns let the range sort cut a campaign with very many rows.
        .orderBy(F.col("campaign_id").asc_nulls_last(), "margin_type", "updated_at", *NEW)
    )


def stale_campaign_revenue(
    wh: Warehouse, cfg: Settings, period: Period, last_day: str
) -> DataFrame:
    """Test revenue of those campaigns by group."""
    return (
        keep_keys(
            _in_test(wh, cfg, period), "campaign_id",
            _stale_events(wh, cfg, last_day).select("campaign_id"),
        )
        .groupBy("campaign_id", "test_group_name")
        .agg(F.sum("revenue_micros").alias("test_revenue_micros"))
        .orderBy(F.col("campaign_id").asc_nulls_last(), "test_group_name")
    )


def unique_updates(
    wh: Warehouse, cfg: Settings, campaigns: list[int] | None = None, values: str = "base"
) -> DataFrame:
    """Changes that changed a margin. ``campaigns`` narrows the report to a list."""
    events = margin_events(wh, cfg, with_limit=True)
    if campaigns is not None:
        events = events.filter(in_list("campaign_id", campaigns))
    paired = with_old_and_new(events, cfg.no_previous_margin, values)
    return (
        changed_only(paired, PAIRS)
        .select(
            "campaign_id", "logged_at", "margin_type", *OLD, *NEW,
            "target", "threshold", "daily_revenue_limit",
        )
        .orderBy(F.col("logged_at").asc_nulls_last())
    )


def target_reasons(wh: Warehouse, cfg: Settings) -> DataFrame:
    """Reasons with their target and one example campaign."""
    return (
        wh.campaign_configs.groupBy("target_reasons", "target")
        .agg(F.max("campaign_id").alias("example_campaign_id"))
        .orderBy(F.col("target").asc_nulls_last())
    )
