"""Checks of a published table against a trusted one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.operators.asof import partitions_for
from marginlab.sources.stored import stored

#: Key ranges that two tables are compared by.
RANGES = 4096


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    tolerance: float = 0.001,
) -> DataFrame:
    """Keys in both tables where some metric is off by the tolerance or more.

    The delta is expected / actual - 1. An actual of zero is off unless the
    expected value is zero too (the delta then shows as NULL). A NULL metric is
    not off. An empty result means that the tables agree.
    """
    e = expected.select(*keys, *[F.col(m).alias(f"expected_{m}") for m in metrics])
    a = actual.select(*keys, *[F.col(m).alias(f"actual_{m}") for m in metrics])
    both = e.join(a, list(keys))
    both = both.withColumns(
        {
            f"delta_{m}": F.try_divide(
                F.col(f"expected_{m}").cast("double"), F.col(f"actual_{m}").cast("double")
            ) - F.lit(1.0)
            for m in metrics
        }
    )
    off = [
        (F.abs(F.col(f"delta_{m}")) >= tolerance)
        | ((F.col(f"actual_{m}") == 0) & (F.col(f"expected_{m}") != 0))
        for m in metrics
    ]
    return both.filter(reduce(or_, [F.coalesce(o, F.lit(False)) for o in off]))


def _off(metric: str, tolerance: float) -> Column:
    """True if a metric of both sides is off, also if one of them is NULL."""
    e, a = F.col(f"expected_{metric}").cast("double"), F.col(f"actual_{metric}").cast("double")
    apart = F.abs(F.try_divide(e, a) - F.lit(1.0)) >= tolerance
    return F.coalesce(apart, F.lit(False)) | F.coalesce((a == 0) & (e != 0), F.lit(False)) | (e.isNull() != a.isNull())


def differing_ranges(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], metrics: Sequence[str], ranges: int = RANGES
) -> DataFrame:
    """``range`` of the key ranges whose rows are not the same on both sides, and their ``rows`` of both.

    A range is a part of the hashes of the keys. Each side is reduced to a count and two sums of
    row hashes per range before anything moves. At most ``ranges`` rows.
    """
    def sums(df: DataFrame, side: str) -> DataFrame:
        # A hash passes over NULLs, so they are told apart by a flag.
        row = [x for c in (*keys, *metrics) for x in (F.col(c), F.col(c).isNull())]
        return df.groupBy(key_range(keys, ranges).alias("range")).agg(
            F.count(F.lit(1)).alias(f"{side}_n"),
            F.sum(F.xxhash64(*row).cast("decimal(20,0)")).alias(f"{side}_a"),
            F.sum(F.xxhash64(F.lit("again"), *row).cast("decimal(20,0)")).alias(f"{side}_b"),
        )

    both = sums(expected, "e").join(sums(actual, "a").withColumnRenamed("range", "__range"), F.col("range") == F.col("__range"), "full")
    same = F.lit(True)
    for c in ("n", "a", "b"):
        same = same & F.col(f"e_{c}").eqNullSafe(F.col(f"a_{c}"))
    return both.filter(~same).select(
        F.coalesce("range", "__range").alias("range"),
        (F.coalesce("e_n", F.lit(0)) + F.coalesce("a_n", F.lit(0))).alias("rows"),
    )


def key_range(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(ranges)).cast("int")


def reconcile_both(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    tolerance: float = 0.001,
    ranges: int = RANGES,
) -> DataFrame:
    """Keys that one side lacks, or where some metric is off: ``finding`` is "missing", "unexpected" or "changed".

    Ranges of keys whose checksums agree hold equal rows and are not compared. Only
    rows of the other ranges are shuffled by key; the list of these is bounded by
    ``ranges``, so it is broadcast. Each side is read twice, once for its checksums.

    Keys may be NULL. Metrics of a repeated key add up; a key that occurs more often on one
    side is "changed" only if its sums are off. A metric that is NULL on one side is off. The delta
    is expected / actual - 1, an actual of zero is off unless the expected value is zero too.
    """
    wanted = stored(differing_ranges(expected, actual, keys, metrics, ranges), "ranges")
    # Both sides meet in one sum by key, so that no join follows. Partitions grow in number with the rows, not in size.
    compared = wanted.agg(F.sum("rows")).first()[0] or 0

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.withColumn("__range", key_range(keys, ranges))
        rows = rows.join(F.broadcast(wanted), F.col("__range") == F.col("range"), "left_semi")
        return rows.select(*keys, F.lit(name).alias("__side"), *metrics)

    sides = side(expected, "expected").unionByName(side(actual, "actual"))
    both = sides.repartition(partitions_for(sides.sparkSession, compared), *keys).groupBy(*keys).agg(
        *[F.sum(F.when(F.col("__side") == s, F.col(m))).alias(f"{s}_{m}") for s in ("expected", "actual") for m in metrics],
        *[F.max(F.col("__side") == s).alias(f"__{s}") for s in ("expected", "actual")],
    )
    finding = (
        F.when(~F.col("__actual"), "missing")
        .when(~F.col("__expected"), "unexpected")
        .when(reduce(or_, [_off(m, tolerance) for m in metrics]), "changed")
    )
    deltas = [
        (F.try_divide(F.col(f"expected_{m}").cast("double"), F.col(f"actual_{m}").cast("double")) - F.lit(1.0)).alias(f"delta_{m}")
        for m in metrics
    ]
    out = both.select(
        *keys, finding.alias("finding"), *[f"expected_{m}" for m in metrics], *[f"actual_{m}" for m in metrics], *deltas
    )
    return out.filter(F.col("finding").isNotNull())
