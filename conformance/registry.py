"""Pairs of a Spark query and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformance.tables import warehouse, with_tables
from marginlab import Period, Settings, Warehouse

# The derived settings change about once a year, so long buckets suit them.
CFG = Settings(bucket_days=364)

# Time frame of the derived tables.
AS_OF = "2002-01-01 00:00:00"
TRAFFIC = Period("1995-06-01T00", "2001-06-30")
DAYS = Period("1995-07-01", "2001-05-31")
BUSINESS = Period("1995-06-15", "2001-06-15")
FULL = Period("1995-01-01", "2001-12-31")
AFTER, BEFORE = "1995-02-01", "2001-07-01"
EARLY = ("1995-06-01", "1995-06-02")
LIMIT_DAYS = ("1995-03-01", "2001-06-30")
FIRST_HOUR, LAST_HOUR = "1995-01-01T00:00:00Z", "2002-01-01T00:00:00Z"

DIGITS = 6
CHECKS: dict[str, Check] = {}


@dataclass(frozen=True)
class Context:
    spark: SparkSession
    sf_dir: str
    stored: Warehouse | None = None

    @cached_property
    def wh(self) -> Warehouse:
        return self.stored or warehouse(self.spark, self.sf_dir)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Check:
    name: str
    build: Callable[[Context], DataFrame]
    sql: str | None
    digits: dict[str, int]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(self.build(Context(spark, sf_dir)), self.digits)

    def run_stored(self, spark: SparkSession, sf_dir: str, stored: Warehouse) -> DataFrame:
        """The same on derived tables that were written before."""
        return self.build(Context(spark, sf_dir, stored))


def check(
    name: str,
    tables: str = "",
    sql: str | None = None,
    times: str = "",
    rounded: str = "",
):
    """Register a query; ``times`` and ``rounded`` name SQL columns to bring to plain form.

    A rounded column is given as ``name`` or ``name:digits``. The digits leave no
    ties: sums of the derived tables have at most four decimals, squares eight.
    """
    specs = [(r + f":{DIGITS}").split(":")[:2] for r in rounded.split()]
    digits = {n: int(d) for n, d in specs}

    def add(build: Callable[[Context], DataFrame]):
        text = sql
        if text is not None:
            swaps = [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times.split()]
            swaps += [f"round(CAST({n} AS DOUBLE), {d}) AS {n}" for n, d in digits.items()]
            names = tables.split()
            if swaps:
                body = text.strip()
                text = f"SELECT * REPLACE ({', '.join(swaps)}) FROM (\n{body}\n) AS result"
            if names:
                text = with_tables(names, text)
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = Check(name, build, text, digits)
        return build

    return add


def plain(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Times as text and fractions as rounded doubles, so that engines compare equal."""
    def form(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.round(c.cast("double"), digits.get(f.name, DIGITS)).alias(f.name)
        return c

    return df.select(*[form(f) for f in df.schema])
