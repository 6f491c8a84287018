"""Event listings that several plans start from."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.nested import json_has, json_scalar
from marginlab.operators.history import change_events, validity_intervals, with_previous
from marginlab.settings import Settings
from marginlab.sources.warehouse import Warehouse

MARGINS = ("network_gross_margin", "other_gross_margin")
OLD = tuple(f"old_{m}" for m in MARGINS)
NEW = tuple(f"new_{m}" for m in MARGINS)
PAIRS = tuple(zip(OLD, NEW))


def margin_base(wh: Warehouse, with_config: bool = True, with_limit: bool = False) -> DataFrame:
    """Margin rows with the campaign's current config, and its revenue limit."""
    out = wh.margins.select(
        "id", "campaign_id", F.col("margin_type").alias("base_margin_type"), *MARGINS, "updated_at"
    )
    if not with_config:
        return out
    configs = wh.campaign_configs.select("campaign_id", "target", "threshold")
    if with_limit:
        limits = wh.campaigns.select(F.col("id").alias("__cid"), "daily_revenue_limit")
        configs = configs.join(limits, F.col("campaign_id") == F.col("__cid"), "left").drop("__cid")
    return out.join(configs, "campaign_id", "left")


def margin_events(
    wh: Warehouse,
    cfg: Settings,
    margin_types: tuple[str, ...] | None = None,
    with_config: bool = True,
    with_limit: bool = False,
    where: Column | None = None,
) -> DataFrame:
    """Logged margin changes of the given types, with the current margins beside them."""
    kept = json_scalar("new_values", "margin_type").isin(*(margin_types or cfg.margin_types))
    return change_events(
        wh.change_log,
        margin_base(wh, with_config, with_limit),
        cfg.log_margins,
        fields={
            "margin_type": "margin_type",
            "previous_margin_type": ("old_values", "margin_type"),
            "logged_network": "network_gross_margin",
            "logged_other": "other_gross_margin",
        },
        where=kept if where is None else kept & where,
    )


def with_old_and_new(
    events: DataFrame, default: float | None, values: str = "base", slice_by: str | None = "week"
) -> DataFrame:
    """Old and new margins of each event by campaign and margin type.

    ``values="base"`` pairs the *current* margins of the logged rows, as the
    published datasets do; ``"log"`` pairs the values that were logged.
    """
    if values == "log":
        events = events.withColumns(
            {
                NEW[0]: F.col("logged_network").try_cast("double"),
                NEW[1]: F.col("logged_other").try_cast("double"),
            }
        )
    else:
        events = events.withColumns({n: F.col(m) for n, m in zip(NEW, MARGINS)})
    return with_previous(
        events,
        dict(PAIRS),
        ["campaign_id", "margin_type"],
        "logged_at",
        default,
        slice_by=slice_by,
    )


def margin_history(
    wh: Warehouse,
    cfg: Settings,
    as_of: str | datetime | date,
    trunc: str | None = "hour",
    with_config: bool = False,
    with_limit: bool = False,
    values: str = "base",
    open_end: Column | None = None,
) -> DataFrame:
    """Margin changes with old and new margins and the time they are in force.

    Control and experiment changes alternate under one *old* margin type, so
    the end of an interval is the second change that follows.
    """
    events = margin_events(wh, cfg, with_config=with_config, with_limit=with_limit)
    # Unmatched log rows have no campaign and can meet no fact.
    events = events.filter(F.col("campaign_id").isNotNull())
    paired = with_old_and_new(events, cfg.no_previous_margin, values, cfg.slice_by)
    return validity_intervals(
        paired, ["campaign_id", "previous_margin_type"], "logged_at", as_of, lead=2, trunc=trunc,
        slice_by=cfg.slice_by, open_end=open_end,
    )


def setting_events(
    wh: Warehouse,
    table: DataFrame,
    table_name: str,
    key: str,
    campaign: str,
    op: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Logged changes of one setting with their campaign."""
    present = json_has("new_values", key)
    base = table.select(F.col("id"), F.col(campaign).alias("campaign_id")) if campaign != "id" else (
        table.select("id", F.col("id").alias("campaign_id"))
    )
    return change_events(
        wh.change_log,
        base,
        table_name,
        fields={key: key},
        op=op,
        where=present if where is None else present & where,
    ).filter(F.col("campaign_id").isNotNull())


def setting_history(
    wh: Warehouse,
    table: DataFrame,
    table_name: str,
    key: str,
    campaign: str,
    as_of: str | datetime | date,
    op: str | None = None,
    where: Column | None = None,
    slice_by: str | None = "week",
) -> DataFrame:
    """History of one logged setting by campaign, cut to hours."""
    events = setting_events(wh, table, table_name, key, campaign, op, where)
    return validity_intervals(events, ["campaign_id"], "logged_at", as_of, lead=1, trunc="hour", slice_by=slice_by)


def target_history(wh: Warehouse, cfg: Settings, as_of) -> DataFrame:
    return setting_history(
        wh, wh.campaign_configs, cfg.log_configs, "target", "campaign_id", as_of, slice_by=cfg.slice_by
    )


def threshold_history(wh: Warehouse, cfg: Settings, as_of, numeric: bool = False) -> DataFrame:
    """Threshold history. The logged text is kept; ``numeric`` casts it."""
    out = setting_history(
        wh, wh.campaign_configs, cfg.log_configs, "threshold", "campaign_id", as_of, slice_by=cfg.slice_by
    )
    return out.withColumn("threshold", F.col("threshold").try_cast("double")) if numeric else out


def limit_history(wh: Warehouse, cfg: Settings, as_of, first_day: str, last_day: str) -> DataFrame:
    """Daily revenue limit history from logged updates of the given days."""
    days = F.to_date("logged_at").between(
        F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    )
    return setting_history(
        wh, wh.campaigns, cfg.log_campaigns, "daily_revenue_limit", "id", as_of, "update", days, cfg.slice_by
    )
