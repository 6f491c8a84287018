"""Measures by cohort (the day of the install, say) that late events correct.

An event can come days after the hour of its install was written. Each batch of events is kept as sums
by cohort, dimensions and unit (an impression, say); such sums can be merged, where the
squares of a unit's total cannot. The cohorts that a batch touches are summed anew from
the kept sums and published in one step; others are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlab.operators.funnel import capped
from marginlab.sources.sink import live_versions, publish_partitions, read_published

COHORT = "cohort"


class CohortStore:
    """Measures of cohorts in ``path``.

    dims      name -> type of the report dimensions
    units     name -> type of the columns that name a unit
    sums      measures that add up
    value     measure in micros, capped at ``cap`` units per event and summed per unit;
              the result has ``units`` and the sum and the sum of squares of these totals
    """

    def __init__(
        self, spark: SparkSession, path: str, dims: Mapping[str, str], units: Mapping[str, str], sums: Sequence[str],
        value: str, cap: float,
    ):
        self.spark, self.path, self.dims, self.units = spark, path, dict(dims), dict(units)
        self.sums, self.value, self.cap = list(sums), value, cap

    def _schema(self, columns: Mapping[str, str], *more: str) -> str:
        named = [f"`{n}` {t}" for n, t in {**columns, **dict.fromkeys(self.sums, "bigint")}.items()]
        return ", ".join([*named, *more])

    def _kept(self) -> DataFrame:
        """Sums of all batches by cohort, dimensions and unit."""
        schema = self._schema({**self.dims, **self.units}, "__unit double", f"{COHORT} string")
        return read_published(self.spark, f"{self.path}/kept", schema, "batch")

    def add(self, batch: str, events: DataFrame) -> list[str]:
        """Keep a batch (dims, units, sums, value and ``cohort`` as text, the day of the install, say) and publish its cohorts; returns them.

        A batch that is added again replaces what it added before, also in cohorts that it no longer
        has, so a run that was ended midway is simply run again. Rows without a cohort count nowhere.
        """
        before = self.cohorts(batch)
        sums = events.filter(F.col(COHORT).isNotNull()).groupBy(COHORT, *self.dims, *self.units).agg(
            *[F.sum(c).cast("bigint").alias(c) for c in self.sums], F.sum(capped(self.value, self.cap)).alias("__unit")
        )
        publish_partitions(sums.withColumn("batch", F.lit(batch)), f"{self.path}/kept", [batch], "batch", within=[COHORT])
        touched = sorted({*before, *self.cohorts(batch)})
        if touched:
            publish_partitions(self._summed(touched), f"{self.path}/result", touched, COHORT)
        return touched

    def cohorts(self, batch: str) -> list[str]:
        """Cohorts that a kept batch has events of."""
        if live_versions(self.spark, f"{self.path}/kept").filter(F.col("value") == batch).isEmpty():
            return []
        return sorted(r[0] for r in self._kept().filter(F.col("batch") == batch).select(COHORT).distinct().collect())

    def _summed(self, cohorts: Sequence[str]) -> DataFrame:
        """The report rows of some cohorts; the others' folders are not opened."""
        kept = self._kept().filter(F.col(COHORT).isin(*cohorts))
        units = kept.groupBy(COHORT, *self.dims, *self.units).agg(
            *[F.sum(c).alias(c) for c in self.sums], F.sum("__unit").alias("__unit")
        )
        x = F.col("__unit")
        return units.groupBy(COHORT, *self.dims).agg(
            *[F.sum(c).alias(c) for c in self.sums],
            F.count(F.lit(1)).alias("units"), F.sum(x).alias("sum_capped"), F.sum(x * x).alias("sum_squared_capped"),
        )

    def result(self) -> DataFrame:
        """All published cohorts."""
        schema = self._schema(self.dims, "units bigint", "sum_capped double", "sum_squared_capped double")
        return read_published(self.spark, f"{self.path}/result", schema, COHORT)
