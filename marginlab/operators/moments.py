"""Confidence intervals of ratios of sums, from moments that can be merged.

The moments of a group are its number of units and the sums of x, y, their squares and their
product. They add up over any parts, so parts (days, batches, stages) are summed once and
merged as often as a report needs. A ratio of sums has no exact variance; the delta method
takes that of its linear form: (s_xx - 2 r s_xy + r^2 s_yy) / (n mean_y^2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.times import col

MOMENTS = ("units", "sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy")

#: 95 % of a normal distribution lie within this many standard deviations.
NORMAL_95 = 1.959963984540054


def unit_moments(units: DataFrame, keys: Sequence[str | Column], x: str | Column, y: str | Column) -> DataFrame:
    """Moments by group of a table with one row per unit. A NULL x or y counts as 0."""
    a, b = (F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in (x, y))
    sums = {"sum_x": a, "sum_y": b, "sum_xx": a * a, "sum_yy": b * b, "sum_xy": a * b}
    return units.groupBy(*keys).agg(F.count(F.lit(1)).alias("units"), *[F.sum(c).alias(n) for n, c in sums.items()])


def merge_moments(parts: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Moments of groups from those of their parts, which share no unit."""
    return parts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MOMENTS])


def ratio_interval(moments: DataFrame, z: float = NORMAL_95) -> DataFrame:
    """Add ``ratio`` (sum of x / sum of y), its ``variance``, ``low`` and ``high``.

    NULL where the sum of y is 0; variance and bounds also for a single unit.
    """
    n = F.col("units").cast("double")

    def spread(product: str, a: str, b: str) -> Column:
        return F.try_divide(F.col(product) - F.col(a) * F.col(b) / n, n - 1)

    r, mean = F.col("ratio"), F.col("sum_y") / n
    linear = spread("sum_xx", "sum_x", "sum_x") - 2 * r * spread("sum_xy", "sum_x", "sum_y") + r * r * spread("sum_yy", "sum_y", "sum_y")
    out = moments.withColumn("ratio", F.try_divide(F.col("sum_x"), F.col("sum_y")))
    # Sums of squares cancel out to a little below 0 where there is no spread.
    out = out.withColumn("variance", F.greatest(F.try_divide(linear, n * mean * mean), F.lit(0.0)))
    out = out.withColumn("variance", F.when(F.col("ratio").isNotNull() & (F.col("units") > 1), F.col("variance")))
    half = F.lit(z) * F.sqrt("variance")
    return out.withColumns({"low": F.col("ratio") - half, "high": F.col("ratio") + half})


def ratio_lift(
    moments: DataFrame, keys: Sequence[str], group: str, control: str, experiment: str, z: float = NORMAL_95
) -> DataFrame:
    """``keys``, both ratios, ``lift`` (experiment / control - 1), its ``low`` and ``high``.

    The groups have different units, so their variances add up. Keys with one group alone have no row.
    """
    both = ratio_interval(moments.filter(F.col(group).isin(control, experiment)), z)

    def pick(name: str, which: str) -> Column:
        return F.max(F.when(F.col(group) == which, F.col(name)))

    sides = {"control": control, "experiment": experiment}
    picked = [pick(c, g).alias(f"{s}_{c}") for s, g in sides.items() for c in ("ratio", "variance")]
    out = both.groupBy(*keys).agg(*picked, F.count_distinct(F.col(group)).alias("__groups")).filter("__groups = 2").drop("__groups")
    c, e = F.col("control_ratio"), F.col("experiment_ratio")
    out = out.withColumn("lift", F.try_divide(e, c) - 1)
    variance = F.try_divide(F.col("experiment_variance"), c * c) + F.try_divide(e * e * F.col("control_variance"), c * c * c * c)
    half = F.lit(z) * F.sqrt(variance)
    out = out.withColumns({"low": F.col("lift") - half, "high": F.col("lift") + half})
    return out.select(*keys, "control_ratio", "experiment_ratio", "lift", "low", "high")
