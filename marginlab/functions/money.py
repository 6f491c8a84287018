"""Money and margin expressions."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginlab.functions.times import col


def micros(c: str | Column) -> Column:
    """Micros to units."""
    return col(c).cast("double") / F.lit(1e6)


def net_margin(gross: str | Column, digits: int | None = None) -> Column:
    """Gross margin g as a share of revenue, g / (1 + g). NULL where g = -1."""
    g = col(gross).cast("double")
    out = F.try_divide(g, g + F.lit(1.0))
    return out if digits is None else F.round(out, digits)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient of two sums; NULL for a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def net_revenue_by_rate(
    spend: str | Column,
    placement: str | Column,
    is_network: Column,
    rates: Mapping[int, Decimal],
    other_rate: Decimal | None,
    scale: Decimal | None = None,
    otherwise: int | None = 0,
) -> Column:
    """Spend times the rate of its placement type, on the network exchange only.

    A NULL placement matches no rate. ``other_rate`` covers the types that are
    not listed; None leaves them to ``otherwise``.
    """
    def value(rate: Decimal) -> Column:
        out = col(spend) * F.lit(rate)
        return out if scale is None else out * F.lit(scale)

    out = None
    for kind, rate in rates.items():
        test = is_network & (col(placement) == kind)
        out = F.when(test, value(rate)) if out is None else out.when(test, value(rate))
    if other_rate is not None:
        out = out.when(is_network & ~col(placement).isin(*rates), value(other_rate))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def net_revenue_by_payout(
    spend: str | Column,
    revenue_terms: Column,
    mediation_price: str | Column,
    is_network: Column | None = None,
) -> Column:
    """Spend less what the publisher gets, by payout type; 0 for other types.

    The flat price is per thousand, and its division drops the fraction.
    """
    kind = revenue_terms["payout_type"]
    cpm = revenue_terms["publisher_flat_cpm_micros"]
    flat = (cpm - cpm % F.lit(1000)) / F.lit(1000)
    on = F.lit(True) if is_network is None else is_network
    return (
        F.when(on & (kind == "FLAT_CPM"), col(spend).cast("double") - flat)
        .when(
            on & (kind == "REVENUE_SHARE"),
            col(spend).cast("double") * (F.lit(1.0) - revenue_terms["publisher_revenue_share"]),
        )
        .when(on & (kind == "HEADER_BIDDING"), (col(spend) - col(mediation_price)).cast("double"))
        .otherwise(F.lit(0.0))
    )
