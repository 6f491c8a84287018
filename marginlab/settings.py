"""Parameters shared by the operators and plans."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Period:
    """A range over ISO-8601 text, both ends included.

    Bounds are compared as text, as the date partition keys are: an upper
    bound of ``2024-01-01`` leaves ``2024-01-01T00:00:00Z`` out.
    """

    start: str
    end: str


@dataclass(frozen=True)
class Settings:
    """Names, ids, rates and limits. A deployment sets its own values."""

    # Names carried by the data of one deployment.
    network_exchange: str = "NETWORK"
    house_exchange: str = "HOUSE"
    network_label: str = "Network"
    other_label: str = "Non-Network"
    unmatched_label: str = "UNMATCHED"
    home_country: str = "US"
    away_label: str = "Non-US"
    model_source: str = "model"

    # Names of tables in the change log.
    log_margins: str = "margins"
    log_configs: str = "campaign_configs"
    log_campaigns: str = "campaigns"

    # The A/B test, its group ids and the margin types.
    test_id: int = 916
    group_names: Mapping[int, str] = field(
        default_factory=lambda: {2063: "holdout", 2064: "control", 2065: "experiment"}
    )
    holdout: str = "holdout"
    control: str = "control"
    experiment: str = "experiment"
    margin_types: tuple[str, ...] = ("experiment", "control")

    # Optimisation states by group.
    opt_state_groups: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "CPR": ("cpr", "cpr-vt", "cprv3", "cprv3-vt"),
            "CPA": ("cpa", "cpa-vt"),
            "CPI": ("cpi", "cpi-vt"),
        }
    )
    other_opt_state: str = "others"

    # Sentinels.
    no_previous_margin: float = 999999.0
    holdout_margin: float = 999.0
    no_previous_control: float = 0.0

    # Net-revenue rate by placement type.
    network_rates: Mapping[int, Decimal] = field(
        default_factory=lambda: {
            1: Decimal("0.3526"),
            2: Decimal("0.4437"),
            3: Decimal("0.3016"),
        }
    )
    other_network_rate: Decimal = Decimal("0.3319")
    throttle_rate_scale: Decimal = Decimal("0.9")

    # Cohort length, revenue cap and outlier bound.
    cohort_days: int = 7
    revenue_cap: float = 500.0
    revenue_outlier_micros: int = 100_000_000_000

    # Eligibility.
    min_age_days: int = 33
    min_daily_limit: float = 1000.0
    acquisition_type: int = 1
    report_days: int = 14
    install_opt_states: tuple[str, ...] = ("cpi", "cpi-vt")

    # Length of the time buckets of as-of joins: about as long as a campaign takes for a
    # few dozen changes. Shorter buckets compare fewer pairs, longer ones repeat fewer intervals.
    bucket_days: int = 28
    # Parts a (campaign, bucket) is cut into by as-of joins, with its histories repeated as often.
    # None measures: heavy ones are cut in proportion to their size, others are not.
    key_splits: int | None = None

    # Unit of the time slices in which neighbours of a key are looked for; None for whole keys.
    # Shorter slices suit keys with very many changes.
    slice_by: str | None = "week"

    # Reconciliation tolerance and snapshot age.
    tolerance: float = 0.001
    snapshot_days: int = 2
