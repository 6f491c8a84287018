"""A list of what is complete, kept beside the data it names.

Data is written to a folder that nobody reads yet; one row appended here makes
it visible. A row is one file, so readers see all of it or nothing, and a write
that fails midway leaves a folder that no row names. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Manifest:
    """Rows of ``columns`` (DDL) with ``seq``, which rises with each append."""

    def __init__(self, spark: SparkSession, path: str, columns: str):
        self.spark, self.path, self.schema = spark, path, f"{columns}, seq long"

    def rows(self) -> DataFrame:
        """What is complete; no rows before the first append."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def append(self, rows: Sequence[tuple]) -> None:
        seq = (self.rows().agg(F.max("seq")).first()[0] or 0) + 1
        one = self.spark.createDataFrame([(*r, seq) for r in rows], self.schema).coalesce(1)
        one.write.mode("append").parquet(self.path)
