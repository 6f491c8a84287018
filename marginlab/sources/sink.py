"""The partitioned sink."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlab.sources.manifest import Manifest

# Characters that a partition folder's name holds in escaped form.
_ESCAPED = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


def partition_path(path: str, part_col: str, value: str) -> str:
    """Folder of one partition."""
    return f"{path}/{part_col}=" + _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)


def write_partition(df: DataFrame, path: str, value: str, part_col: str = "dt") -> None:
    """Replace one whole partition, also by no rows. ``df`` has no use for a column of that name."""
    (
        df.drop(part_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(partition_path(path, part_col, value))
    )


def write_partitions(df: DataFrame, path: str, part_col: str = "dt") -> None:
    """Replace just the partitions that occur in ``df``; a second run with as many changes nothing.

    A partition that has no rows any more keeps its old ones: ``write_partition`` is
    for that. Rows are dealt by partition first, so a partition gets few files, and
    a large one is split.
    The file committer publishes finished tasks only, so a lost executor
    costs a retry and leaves no half-written partition.
    """
    (
        df.hint("rebalance", F.col(part_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part_col)
        .parquet(path)
    )


def _live(spark: SparkSession, path: str) -> Manifest:
    return Manifest(spark, f"{path}/live", "value string, version string")


def publish_partitions(
    df: DataFrame, path: str, values: Sequence[str], part_col: str = "dt", within: Sequence[str] = ()
) -> None:
    """Replace the partitions ``values`` in one step, those without rows too.

    ``df`` holds rows of these partitions alone. They are written beside the live
    ones; one row for each in the list of live versions then puts them in their place.
    A reader meets the old partitions or the new ones, never a part, and a write that
    fails changes nothing. ``read_published`` reads them; older versions stay until
    ``live_versions`` tells a cleaner that they can go. ``within`` are text columns by
    which the rows of a partition are laid out further, for readers that filter by them.
    """
    version = uuid.uuid4().hex
    columns = [part_col, *within]
    dealt = df.withColumn(part_col, F.col(part_col).cast("string")).hint("rebalance", *[F.col(c) for c in columns])
    dealt.write.partitionBy(*columns).parquet(f"{path}/versions/version={version}")
    _live(df.sparkSession, path).append([(v, version) for v in values])


def live_versions(spark: SparkSession, path: str) -> DataFrame:
    """(value, version) of each published partition."""
    rows = _live(spark, path).rows()
    return rows.groupBy("value").agg(F.max_by("version", "seq").alias("version"))


def read_published(spark: SparkSession, path: str, schema: str, part_col: str = "dt") -> DataFrame:
    """The live partitions. ``schema`` is that of the rows without the partition column."""
    every = spark.read.schema(f"{schema}, version string, {part_col} string").parquet(f"{path}/versions")
    live = live_versions(spark, path).withColumnsRenamed({"value": part_col})
    return every.join(live, [part_col, "version"], "left_semi").drop("version")
