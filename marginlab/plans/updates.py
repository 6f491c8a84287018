"""Listings of margin updates from the model, by hand and by target switches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.functions.money import micros, net_margin
from marginlab.functions.nested import json_has, json_scalar
from marginlab.functions.times import iso_timestamp
from marginlab.operators.dims import exclude_keys, keep_keys, num_values_per_key
from marginlab.operators.history import change_events, change_flag, merge_update_sources
from marginlab.plans.common import MARGINS, NEW, margin_events
from marginlab.settings import Period, Settings
from marginlab.sources.stored import stored
from marginlab.sources.warehouse import Warehouse

_SIDES = ("control", "experiment")
_PLACES = ("network", "other")


def _gross(age: str, side: str, place: str) -> str:
    return f"{age}_{side}_gross_margin_{place}"


def model_updates(wh: Warehouse, cfg: Settings) -> DataFrame:
    """Every row of the model's output with change flags and net margins."""
    df = wh.daily_analysis.filter(
        F.col("control_gross_revenue").isNotNull() & F.col("experiment_gross_revenue").isNotNull()
    )
    changed = {
        side: change_flag(
            [(_gross("old", side, p), _gross("new", side, p)) for p in _PLACES]
        ).alias(f"{side}_update")
        for side in _SIDES
    }
    margins = [
        net_margin(_gross(age, side, p), 3).alias(f"{age}_{side}_margin_{p}")
        for side in _SIDES for age in ("old", "new") for p in _PLACES
    ]
    significant = [
        F.when(F.col(f"measured_{s}_rpi").isNotNull(), "Yes").otherwise("No")
        .alias(f"{s}_rpi_stat_sig")
        for s in _SIDES
    ]
    cumulative = []
    for s in _SIDES:
        cumulative += [
            micros(f"{s}_gross_revenue").alias(f"cumulative_{s}_gross_revenue"),
            F.col(f"{s}_installs").alias(f"cumulative_{s}_installs"),
        ]
    return df.select(
        "campaign_id", F.date_trunc("hour", "updated_at").alias("updated_at"), "target",
        "threshold", "margin_exploration_algorithm", "margin_reason", *changed.values(), *margins,
        F.col("measured_control_nrm").alias("control_nrm"),
        F.col("measured_experiment_nrm").alias("experiment_nrm"),
        "predicted_best_nrm", "predicted_best_rpi", "measured_control_rpi",
        "measured_experiment_rpi", *significant, *cumulative,
    )


def logged_updates(wh: Warehouse, cfg: Settings) -> DataFrame:
    """Margin changes as logged, newest first, to check the model's output against."""
    return (
        margin_events(wh, cfg, with_config=False)
        .select(
            "campaign_id", "logged_at", "source", "margin_type",
            *[F.col(m).alias(n) for m, n in zip(MARGINS, NEW)],
        )
        .orderBy(F.col("logged_at").desc_nulls_last())
    )


def paused_campaigns(wh: Warehouse, cfg: Settings, after: str) -> DataFrame:
    """Campaign ids logged as paused after a date (compared as text)."""
    return wh.change_log.filter(
        (F.col("table_name") == cfg.log_campaigns)
        & (F.col("operation") == "update")
        & (json_scalar("new_values", "state") == "paused")
        & (json_scalar("new_values", "state_last_changed_at") > after)
    ).select(F.col("row_id").alias("campaign_id"))


_NET = tuple(f"new_{s}_{p}_net_margin" for s in _SIDES for p in _PLACES)
_TIMELINE = {
    "campaign_id": "bigint",
    "model_target": "string",
    "target_reasons": "string",
    "update_source": "string",
    "margin_reason": "string",
    "margin_exploration_algorithm": "string",
    **{n: "double" for n in _NET},
    "min_update_at": "timestamp",
}


def _model_branch(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    """Model output of the campaigns whose config changed in the period.

    The model output is reduced to its groups before it meets the configs.
    """
    base = wh.campaign_configs.select("id", "campaign_id", "target_reasons")
    logged = change_events(
        wh.change_log, base.select("id", "campaign_id"), cfg.log_configs,
        where=_logged_in(period),
    )
    configs = keep_keys(base, "campaign_id", logged.select("campaign_id")).select(
        "campaign_id", "target_reasons"
    ).distinct()
    by = ["campaign_id", "target", "margin_reason", "margin_exploration_algorithm"]
    pairs = [(s, p) for s in _SIDES for p in _PLACES]
    model = wh.daily_analysis.groupBy(*by).agg(
        *[F.max(net_margin(_gross("new", s, p))).alias(n) for (s, p), n in zip(pairs, _NET)],
        F.min("updated_at").alias("min_update_at"),
    ).withColumnRenamed("target", "model_target")
    return configs.join(model, "campaign_id", "left").withColumn(
        "update_source", F.lit(cfg.model_source)
    )


def _logged_in(period: Period):
    """Half-open, unlike text periods: start <= logged_at < end."""
    at = F.col("logged_at")
    return (at >= iso_timestamp(F.lit(period.start))) & (at < iso_timestamp(F.lit(period.end)))


def _manual_branch(wh: Warehouse, cfg: Settings, period: Period) -> DataFrame:
    """Logged margin changes of every source but the model."""
    events = margin_events(
        wh, cfg, with_config=False,
        where=(F.col("source") != cfg.model_source) & _logged_in(period),
    )
    is_control = F.col("margin_type") == cfg.control
    aggs = []
    for s, test in zip(_SIDES, (is_control, ~is_control)):
        for p, m in zip(_PLACES, MARGINS):
            aggs.append(F.max(F.when(test, net_margin(m))).alias(f"new_{s}_{p}_net_margin"))
    return events.groupBy("campaign_id", "source").agg(
        *aggs, F.min("logged_at").alias("min_update_at")
    ).withColumnRenamed("source", "update_source")


def _switch_branch(wh: Warehouse, cfg: Settings) -> DataFrame:
    """Logged config changes that name a target."""
    base = wh.campaign_configs.select("id", "campaign_id", "target_reasons")
    events = change_events(
        wh.change_log, base, cfg.log_configs, fields={"model_target": "target"},
        where=json_has("new_values", "target"),
    )
    return events.withColumns(
        {"update_source": F.lit("target_switch"), "min_update_at": F.col("logged_at")}
    )


def all_updates(wh: Warehouse, cfg: Settings, period: Period, paused_after: str) -> DataFrame:
    """One timeline of model updates, manual updates and target switches.

    Campaigns paused after the date are left out; excluding them before the
    targets are counted gives the same rows and moves less data.
    """
    merged = merge_update_sources(
        [_model_branch(wh, cfg, period), _manual_branch(wh, cfg, period), _switch_branch(wh, cfg)],
        _TIMELINE,
    )
    # Both have several readers: the exclusion its three parts, the timeline its rows and their counts.
    paused = stored(paused_campaigns(wh, cfg, paused_after), "paused-campaigns")
    kept = stored(exclude_keys(merged, "campaign_id", paused), "timeline")
    counted = num_values_per_key(kept, "campaign_id", "model_target", "num_target")
    owners = wh.campaigns.select(F.col("id").alias("__id"), "customer_id")
    return (
        counted.join(owners, F.col("campaign_id") == F.col("__id"))
        .select(
            "campaign_id", "customer_id", "min_update_at", "num_target", "model_target",
            "target_reasons", "update_source", "margin_reason", "margin_exploration_algorithm",
            *_NET,
        )
        .orderBy(F.col("campaign_id").asc_nulls_last(), F.col("min_update_at").asc_nulls_last())
    )


def disabled_campaigns(updates: DataFrame) -> DataFrame:
    """The rows of ``all_updates`` that disable a campaign."""
    return updates.filter(F.col("model_target") == "disabled").orderBy(
        F.col("campaign_id").asc_nulls_last(), F.col("min_update_at").asc_nulls_last()
    )
