"""One hour of the hourly dataset as a repeatable job."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from marginlab.operators.asof import History
from marginlab.plans.hourly import config_dataset, config_settings, hourly_dataset, hourly_measures, hourly_settings
from marginlab.settings import Settings
from marginlab.sources.sink import write_partition
from marginlab.sources.stored import stored
from marginlab.sources.warehouse import Warehouse

_TEXT = "%Y-%m-%dT%H:%M:%SZ"

#: Hours whose facts a backfill reads in one pass.
HOURS_AT_ONCE = 24


def hours_after(hour: str, n: int) -> str:
    """The key ``n`` hours later."""
    return (datetime.strptime(hour, _TEXT) + timedelta(hours=n)).strftime(_TEXT)


def hour_bounds(hour: str) -> tuple[str, str]:
    """The hour key and the key of the hour after it."""
    return hour, hours_after(hour, 1)


def hourly_run(
    wh: Warehouse,
    cfg: Settings,
    hour: str,
    out: str,
    as_of: str | datetime | date,
    limit_days: tuple[str, str],
    settings: list[History] | None = None,
    facts: DataFrame | None = None,
) -> None:
    """Write the partition ``dt=hour``; running it again gives the same partition, an hour without rows none."""
    start, end = hour_bounds(hour)
    write_partition(hourly_dataset(wh, cfg, start, end, as_of, limit_days, settings=settings, facts=facts), out, hour)


def hourly_config_run(
    wh: Warehouse,
    cfg: Settings,
    hour: str,
    out: str,
    as_of: str | datetime | date,
    limit_days: tuple[str, str],
    settings: list[History] | None = None,
) -> None:
    """Write one hour of the config table, likewise."""
    start, end = hour_bounds(hour)
    write_partition(config_dataset(wh, cfg, start, end, as_of, limit_days, settings=settings), out, hour)


def backfill(
    run: Callable[..., None],
    wh: Warehouse,
    cfg: Settings,
    first: str,
    until: str,
    out: str,
    as_of: str | datetime | date,
    limit_days: tuple[str, str],
) -> None:
    """``run`` each hour of first <= hour < until, each into its own partition.

    The histories of settings depend on ``as_of`` alone, so they are built once for all hours. The facts of up to
    HOURS_AT_ONCE hours are read in one pass and written once; each hour takes its own.
    """
    build, measures = SETTINGS.get(run), FACTS.get(run)
    shared = {} if build is None else {"settings": build(wh, cfg, as_of, limit_days)}
    hour, read = first, first
    while hour < until:
        if measures is not None and hour >= read:
            read = min(until, hours_after(hour, HOURS_AT_ONCE))
            shared["facts"] = stored(measures(wh, cfg, hour, read), "hourly-facts")
        run(wh, cfg, hour, out, as_of, limit_days, **shared)
        hour = hour_bounds(hour)[1]


#: What builds the settings of a run.
SETTINGS = {hourly_run: hourly_settings, hourly_config_run: config_settings}

#: What reads the facts of a run.
FACTS = {hourly_run: hourly_measures}
