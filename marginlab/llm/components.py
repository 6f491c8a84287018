"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlab.session import new_shared_path


def _largest_to_smallest(edges: DataFrame, only_larger: bool) -> DataFrame:
    """Link neighbours of each node to the least of them and the node.

    ``only_larger``: for every node, its larger neighbours (large star); else its
    smaller neighbours and itself (small star). The least neighbour is a partial
    aggregate and the join's sides are plain, so Spark can split a node that has
    very many neighbours.
    """
    if only_larger:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges
    least = sides.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    linked = sides.join(least, "a")
    if only_larger:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has an edge to another; the root is the least node it reaches.

    ``edges`` has the columns ``a`` and ``b`` of an orderable type. Self loops,
    repeated edges and null ends count for nothing. Large-star and small-star
    steps alternate until every node hangs on its root; each round is written to
    the shared folder, which cuts the lineage and survives lost executors. The
    number of rounds grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    path = new_shared_path(spark, "components")
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = now.where("a > b").distinct()
    now.write.parquet(f"{path}/0")
    now, mark, step = spark.read.parquet(f"{path}/0"), None, 0
    while True:
        n, total = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if n == 0 or (n, total) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark, step = (n, total), step + 1
        star = _largest_to_smallest(now, only_larger=True)
        _largest_to_smallest(star, only_larger=False).write.parquet(f"{path}/{step}")
        now = spark.read.parquet(f"{path}/{step}")
