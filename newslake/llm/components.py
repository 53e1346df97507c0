"""Connected components of links, as alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import remove, write


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node reached.

    Each round hangs the larger neighbours of every node on the smallest node near
    it (large star), then the smaller ones (small star), until every node hangs on a
    root; that takes few rounds, also for long chains.  The smallest neighbours are
    summed up in map tasks and written to the shared folder before they are joined
    to the links, so both sides of the join have a shuffle of their own and adaptive
    execution can split a node that has a third of all links.  Nothing is collected.
    Links from a node to itself and repeated links are harmless.
    """
    spark = links.sparkSession
    ends = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    path = write(ends.filter("node != root").distinct(), "links")
    while not _is_star(spark.read.parquet(path)):
        for large in (True, False):
            edges = spark.read.parquet(path)
            if large:
                edges = edges.union(edges.select("root", "node"))
            least = write(edges.groupBy("node").agg(F.min("root").alias("least")), "least")
            nearest = spark.read.parquet(least)
            hung = edges.join(nearest, "node")
            if large:
                up = hung.filter("root > node").select(F.col("root").alias("node"), F.least("node", "least").alias("root"))
            else:
                up = hung.select(F.col("root").alias("node"), F.col("least").alias("root"))
                up = up.filter("node != root").union(nearest)
            following = write(up.distinct(), "links")
            remove(spark, path)
            remove(spark, least)
            path = following
    return spark.read.parquet(path)


def _is_star(edges: DataFrame) -> bool:
    """Whether every node hangs on one root that hangs on nothing."""
    ends = edges.select("node", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("root", F.lit(0), F.lit(1))
    )
    per_node = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return per_node.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()
