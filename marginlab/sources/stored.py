"""A plan's rows written once to the shared folder, for every later reader."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marginlab.session import new_shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table. Lineage ends there, and Spark knows the table's size."""
    path = new_shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
