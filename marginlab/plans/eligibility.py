"""Which campaigns may join the test, with their recent performance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.functions.money import micros
from marginlab.functions.times import day_of, full_days, iso_text, iso_timestamp
from marginlab.operators.dims import eligible_campaigns
from marginlab.settings import Settings
from marginlab.sources.scans import latest_snapshot
from marginlab.sources.warehouse import Warehouse


def _report(wh: Warehouse, cfg: Settings, as_of, eligible: DataFrame, snapshots: str) -> DataFrame:
    """Recent sums per eligible campaign and sales region.

    A campaign counts once for each CRM snapshot it is in (``snapshots="all"``)
    or once (``"latest"``). The number of snapshots is a factor of the sums, so
    the daily rows are not repeated; they are summed before the join.
    """
    crm = wh.crm_campaign_daily
    if snapshots == "latest":
        crm = latest_snapshot(crm, as_of, cfg.snapshot_days)
    regions = crm.groupBy("crm_campaign_id", F.col("sales_region").alias("region")).agg(
        F.count(F.lit(1)).alias("times")
    )
    state = (
        eligible.select(
            F.col("id").alias("campaign_id"), "crm_campaign_id", "daily_revenue_limit", "state"
        )
        .join(regions, "crm_campaign_id", "left")
        .groupBy("campaign_id", "region", "daily_revenue_limit", "state")
        .agg(F.sum(F.coalesce("times", F.lit(1))).alias("times"))
    )
    today = day_of(as_of)
    # The text bound, a day wider, prunes partitions; a cast of the key would not.
    oldest = F.substring(iso_text(F.date_sub(today, cfg.report_days + 1).cast("timestamp")), 1, 10)
    recent = wh.daily_attr_d7.filter(
        (F.col("dt") >= oldest) & (full_days(iso_timestamp("dt"), today) <= cfg.report_days)
    ).join(eligible.select(F.col("id").alias("__eligible")), F.col("campaign_id") == F.col("__eligible"), "left_semi")
    who = ["customer_id", "customer_name", "campaign_id", "campaign_name", "ae_email", "csm_email"]
    sums = recent.groupBy(*who).agg(
        F.sum(micros("revenue_micros_d1")).alias("revenue"),
        F.sum("installs_d1").alias("installs"),
        F.sum("target_events_d7").alias("events_d7"),
        F.sum(micros("customer_revenue_micros_d7")).alias("customer_revenue_d7"),
    )
    measures = ("revenue", "installs", "events_d7", "customer_revenue_d7")
    return sums.join(state, "campaign_id").select(
        "customer_id", "customer_name", "campaign_id", "campaign_name", "region", "state",
        "ae_email", "csm_email", "daily_revenue_limit",
        *[(F.col(m) * F.col("times")).alias(m) for m in measures],
    )


def margin_goal_report(
    wh: Warehouse,
    cfg: Settings,
    as_of: str | datetime | date,
    only: Sequence[int] | None = None,
    snapshots: str = "all",
) -> DataFrame:
    """Eligible campaigns for the net-revenue-margin goal."""
    eligible = eligible_campaigns(wh.campaigns, as_of, cfg, only=only)
    return _report(wh, cfg, as_of, eligible, snapshots)


def install_goal_report(
    wh: Warehouse,
    cfg: Settings,
    as_of: str | datetime | date,
    exclude: DataFrame | Sequence[int] | None = None,
    snapshots: str = "all",
) -> DataFrame:
    """Eligible campaigns for the revenue-per-install goal."""
    eligible = eligible_campaigns(
        wh.campaigns, as_of, cfg, opt_states=cfg.install_opt_states, exclude=exclude
    )
    return _report(wh, cfg, as_of, eligible, snapshots)
