"""The eighteen input tables under one roof.

A plan asks for ``wh.impressions`` and gets a DataFrame. Where that comes from
(a catalogue, Parquet folders, an operational database) is decided here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Tables and what one row of each stands for.
TABLES = {
    "change_log": "one changed row of an operational table, with old and new values as JSON",
    "margins": "current margin row of a campaign and margin type",
    "campaign_configs": "current target and threshold of a campaign",
    "campaigns": "campaign",
    "customers": "customer",
    "crm_campaign_daily": "daily snapshot of a campaign's sales fields",
    "supply_hourly": "hourly funnel measures by campaign and traffic dimensions",
    "impressions": "impression with its bid",
    "matched_installs": "install joined to its bid",
    "unmatched_installs": "install without a bid",
    "matched_app_events": "in-app event joined to its bid",
    "unmatched_app_events": "in-app event without a bid",
    "app_events": "in-app event used for revenue cohorts",
    "daily_analysis": "daily output of the margin model",
    "daily_attr_d7": "daily measures attributed within seven days",
    "daily_fact": "daily measures for reporting",
    "daily_credited_d7": "daily measures attributed within seven days, with credit flag",
    "published_dataset": "published output of the hourly dataset",
}


class Warehouse:
    """Named DataFrames, built when first asked for."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._tables:
            raise KeyError(f"table {name!r} was not given")
        found = self._tables[name]
        if callable(found) and not isinstance(found, DataFrame):
            found = self._tables[name] = found()
        return found

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        names: Mapping[str, str],
        columns: Mapping[str, Mapping[str, str]] | None = None,
    ) -> Warehouse:
        """Tables of a metastore: ``{"impressions": "catalog.schema.table"}``.

        ``columns[table]`` maps the deployment's column names to the names used here.
        """
        return cls({
            t: (lambda t=t, n=n: _renamed(spark.table(n), (columns or {}).get(t)))
            for t, n in names.items()
        })

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        paths: Mapping[str, str],
        columns: Mapping[str, Mapping[str, str]] | None = None,
    ) -> Warehouse:
        """Parquet folders; a ``dt=`` folder level becomes the partition column."""
        return cls({
            t: (lambda t=t, p=p: _renamed(spark.read.parquet(p), (columns or {}).get(t)))
            for t, p in paths.items()
        })

    def with_tables(self, **tables: DataFrame) -> Warehouse:
        return Warehouse({**self._tables, **tables})


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """An operational table, read in ``partitions`` id ranges at the same time."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )


def _renamed(df: DataFrame, columns: Mapping[str, str] | None) -> DataFrame:
    return df.withColumnsRenamed(dict(columns)) if columns else df
