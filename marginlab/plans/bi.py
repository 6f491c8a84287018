"""The dashboard dataset: daily measures with the margin changes of the day."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marginlab.functions.money import micros
from marginlab.functions.times import day_of_iso
from marginlab.operators.dims import keep_keys
from marginlab.operators.metrics import previous_period
from marginlab.plans.track import (
    CONTROL_NEW,
    CONTROL_OLD,
    TEST_NEW,
    TEST_OLD,
    margin_changes,
    margin_pairs,
)
from marginlab.settings import Period, Settings
from marginlab.sources.scans import latest_snapshot, period_scan
from marginlab.sources.stored import stored
from marginlab.sources.warehouse import Warehouse

_WHO = (
    "campaign_id", "campaign_name", "customer_id", "customer_name", "dest_app_id",
    "dest_app_name", "campaign_type", "sales_region", "sales_sub_region", "platform",
    "service_level",
)
_MONEY = ("revenue", "spend", "network_revenue", "network_spend")
_LATE = ("installs", "target_events_d7", "customer_revenue_d7")


def paired_days(changes: DataFrame, cfg: Settings) -> DataFrame:
    """Campaigns and days with a control and an experiment change.

    The keys of ``margin_pairs`` without its pairs.
    """
    kind = F.col("margin_type")
    days = changes.groupBy("campaign_id", F.to_date("logged_at").alias("day")).agg(
        F.max(kind == cfg.control).alias("c"), F.max(kind == cfg.experiment).alias("e")
    )
    return days.filter(F.col("c") & F.col("e") & F.col("campaign_id").isNotNull()).select("campaign_id", "day")


def campaign_fields(
    wh: Warehouse, cfg: Settings, period: Period, as_of, campaigns: DataFrame
) -> DataFrame:
    """Descriptive fields of each campaign that had traffic."""
    from_fact = [c for c in _WHO if c in wh.daily_fact.columns]
    seen = period_scan(wh.daily_fact, period).groupBy(*from_fact).agg(
        F.max("ae_email").alias("ae_email"), F.max("csm_email").alias("csm_email")
    )
    # Rows are combined before they are moved to their campaigns.
    who = keep_keys(seen, "campaign_id", campaigns)
    # The fact is reduced to its fields first; sales fields and limits follow.
    limits = wh.campaigns.select(
        F.col("id").alias("__id"), "crm_campaign_id", "daily_revenue_limit"
    )
    crm = latest_snapshot(wh.crm_campaign_daily, as_of, cfg.snapshot_days).select(
        "crm_campaign_id", "sales_region", "sales_sub_region", "service_level"
    )
    full = who.join(limits, F.col("campaign_id") == F.col("__id")).join(
        crm, "crm_campaign_id", "left"
    )
    return full.groupBy(*_WHO).agg(
        *[F.max(c).alias(c) for c in ("ae_email", "csm_email", "daily_revenue_limit")]
    )


def daily_measures(
    wh: Warehouse, cfg: Settings, period: Period, campaigns: DataFrame, days: DataFrame
) -> DataFrame:
    """Credited daily measures and those of the previous row of the campaign.

    ``__paired`` tells the rows whose campaign and day are among ``days``. Facts move once, to their campaign and day,
    and their sums once more, to the campaign, where the wanted ones are kept.
    """
    credited = F.col("is_uncredited") != "true"

    def scan(df: DataFrame) -> DataFrame:
        return period_scan(df, period).filter(credited)

    on_network = F.col("exchange") == cfg.network_exchange
    by = ["campaign_id", day_of_iso("dt").alias("dt")]
    early = scan(wh.daily_fact).groupBy(*by).agg(
        F.sum("installs").alias("installs"),
        F.sum(micros("revenue_micros")).alias("revenue"),
        F.sum(micros("spend_micros")).alias("spend"),
        F.sum(micros(F.when(on_network, F.coalesce("revenue_micros", F.lit(0))).otherwise(0)))
        .alias("network_revenue"),
        F.sum(micros(F.when(on_network, F.coalesce("spend_micros", F.lit(0))).otherwise(0)))
        .alias("network_spend"),
    )
    late = scan(wh.daily_credited_d7).groupBy(*by).agg(
        F.sum("target_events_d7").alias("target_events_d7"),
        F.sum(micros("customer_revenue_micros_d7")).alias("customer_revenue_d7"),
        F.lit(True).alias("__late"),
    )
    on = ["campaign_id", "dt"]
    paired = days.select("campaign_id", F.col("day").cast("timestamp").alias("dt"), F.lit(True).alias("__paired"))
    both = early.join(late, on, "left").join(paired, on, "left")
    both = both.withColumn("__paired", F.coalesce("__paired", F.lit(False)))
    both = previous_period(
        both, ["campaign_id"], "dt", {f"previous_day_{m}": m for m in _MONEY}
    )
    full = previous_matched(
        both, "campaign_id", "dt", "__late", {f"previous_day_{m}": m for m in _LATE}
    ).drop("__late")
    return keep_keys(full, "campaign_id", campaigns)


def previous_matched(
    df: DataFrame, key: str, ts: str, matched: str, cols: dict[str, str]
) -> DataFrame:
    """Values of the previous row that a left join matched; NULL on unmatched rows.

    A window over the right side's key would put all unmatched rows, of every
    campaign, into one group without an order. They get NULL instead.
    """
    hit = F.coalesce(F.col(matched), F.lit(False))
    w = Window.partitionBy(key, hit).orderBy(F.col(ts).asc_nulls_last())
    return df.withColumns({n: F.when(hit, F.lag(c, 1).over(w)) for n, c in cols.items()})


def dashboard_dataset(
    wh: Warehouse,
    cfg: Settings,
    period: Period,
    after: str,
    before: str,
    as_of: str | datetime | date,
) -> DataFrame:
    """Daily measures and fields of the tested campaigns with the day's margin changes.

    The rows are written once, by campaign: those of a day with changes alone move on to meet them.
    """
    log = margin_changes(wh, cfg, after, before)
    days = stored(paired_days(log, cfg), "paired-days")
    campaigns = days.select("campaign_id").distinct()
    changes = margin_pairs(wh, cfg, after, before, "inner", "experiment", changes=log).withColumnsRenamed(
        {"campaign_id": "__cid"}
    )
    merged = daily_measures(wh, cfg, period, campaigns, days).join(
        campaign_fields(wh, cfg, period, as_of, campaigns), "campaign_id"
    ).withColumn("dt", F.to_date("dt"))
    merged = stored(merged, "daily-rows")
    changed = merged.filter("__paired").join(
        changes,
        (F.col("campaign_id") == F.col("__cid")) & (F.col("dt") == F.col("updated_date")),
        "left",
    )
    out = changed.unionByName(merged.filter(~F.col("__paired")), allowMissingColumns=True)
    return out.select(
        "campaign_id", "dt", "updated_date", *[c for c in _WHO if c != "campaign_id"],
        "ae_email", "csm_email", "daily_revenue_limit", "target",
        *CONTROL_OLD, *TEST_OLD, *CONTROL_NEW, *TEST_NEW,
        *_MONEY, *[f"previous_day_{m}" for m in _MONEY],
        *_LATE, *[f"previous_day_{m}" for m in _LATE],
    )
