"""Dimension operators: exclusions, counts per key, eligibility, enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.times import day_of, full_days
from marginlab.settings import Settings
from marginlab.sources.scans import latest_snapshot


def keep_keys(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key occurs in the first column of ``wanted`` (IN subquery)."""
    keys = wanted.select(F.col(wanted.columns[0]).alias("__wanted")).distinct()
    return df.join(keys, F.col(key) == F.col("__wanted"), "left_semi")


def exclude_keys(df: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """``key NOT IN (excluded)`` with its NULL rules, without a forced broadcast.

    A NULL among the excluded keys leaves no row; a NULL key goes unless
    nothing is excluded. Spark's own plan for NOT IN broadcasts the excluded
    keys at any size. Here a plain anti join handles the values, and two counts
    (one-row subqueries) handle the NULLs.
    """
    keys = excluded.select(F.col(excluded.columns[0]).alias("__excluded"))
    n_all = keys.agg(F.count(F.lit(1))).scalar()
    n_null = keys.agg(F.count(F.when(F.col("__excluded").isNull(), 1))).scalar()
    present = keys.filter(F.col("__excluded").isNotNull()).distinct()
    kept = df.join(present, F.col(key) == F.col("__excluded"), "left_anti")
    return kept.filter((n_all == 0) | ((n_null == 0) & F.col(key).isNotNull()))


def num_values_per_key(df: DataFrame, key: str, column: str, out: str) -> DataFrame:
    """Distinct values of a column per key, joined back to every row."""
    counts = df.groupBy(F.col(key).alias("__key")).agg(F.countDistinct(column).alias(out))
    return df.join(counts, F.col(key) == F.col("__key"), "left").drop("__key")


def last_update_filter(
    df: DataFrame, keys: Sequence[str], ts: str, op: str, day: str, out: str = "max_update"
) -> DataFrame:
    """Keys whose last update day is ``op`` ("<" inactive, ">=" active) the day."""
    last = df.groupBy(*keys).agg(F.max(ts).alias(out))
    seen, bound = F.to_date(out), F.lit(day).cast("date")
    tests = {"<": seen < bound, "<=": seen <= bound, ">": seen > bound, ">=": seen >= bound}
    return last.filter(tests[op])


def eligible_campaigns(
    campaigns: DataFrame,
    as_of: str | datetime | date,
    cfg: Settings,
    state: str = "enabled",
    opt_states: Sequence[str] | None = None,
    exclude: DataFrame | Sequence[int] | None = None,
    only: Sequence[int] | None = None,
) -> DataFrame:
    """Campaigns old enough, with a high enough limit, of the right type and state.

    Ages count to the day of ``as_of``, whatever its time of day. ``exclude`` is a
    short list, or a one-column DataFrame for a long one.
    """
    out = campaigns.filter(
        (full_days("created_at", day_of(as_of)) >= cfg.min_age_days)
        & (F.col("daily_revenue_limit") > cfg.min_daily_limit)
        & (F.col("campaign_type_id") == cfg.acquisition_type)
        & (F.col("state") == state)
    )
    if opt_states is not None:
        out = out.filter(F.col("final_optimization_state").isin(*opt_states))
    if only is not None:
        out = out.filter(F.col("id").isin(*only))
    if isinstance(exclude, DataFrame):
        out = exclude_keys(out, "id", exclude)
    elif exclude:
        out = out.filter(~F.col("id").isin(*exclude))
    return out


def crm_fields(
    crm: DataFrame,
    campaigns: DataFrame,
    as_of: str | datetime | date,
    cfg: Settings,
    columns: Sequence[str] = ("sales_region", "service_level"),
) -> DataFrame:
    """Sales fields of each campaign from the newest snapshot."""
    newest = latest_snapshot(crm, as_of, cfg.snapshot_days)
    link = campaigns.select(F.col("id").alias("campaign_id"), "crm_campaign_id")
    return newest.join(link, "crm_campaign_id").select("campaign_id", *columns)


def lookup(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, str]
) -> DataFrame:
    """Left join of ``{name: dim column}``. Equal dim rows count once.

    There is no broadcast hint: Spark broadcasts by its size estimate, or at
    run time by the measured size.
    """
    side = dim.select(
        F.col(dim_key).alias("__dim_key"), *[F.col(c).alias(n) for n, c in columns.items()]
    ).distinct()
    return df.join(side, F.col(key) == F.col("__dim_key"), "left").drop("__dim_key")


def enrich_dims(
    df: DataFrame,
    customers: DataFrame | None = None,
    crm: DataFrame | None = None,
    campaigns: DataFrame | None = None,
) -> DataFrame:
    """Customer name, sales region and service level, current optimisation state."""
    if customers is not None:
        df = lookup(df, customers, "customer_id", "id", {"customer_name": "company"})
    if crm is not None:
        df = lookup(
            df, crm, "campaign_id", "campaign_id",
            {"sales_region": "sales_region", "service_level": "service_level"},
        )
    if campaigns is not None:
        name = "current_optimization_state"
        df = lookup(df, campaigns, "campaign_id", "id", {name: name})
    return df


def in_list(column: str | Column, values: Sequence) -> Column:
    return (F.col(column) if isinstance(column, str) else column).isin(*values)
