"""Connected components of an edge table, by repeated joins that keep no component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.llm.shared import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each node of the edges reaches; edges with a null end don't count.

    Large-star and small-star steps in turn: each node's neighbours are tied to the smallest of them, until every
    edge leads to the smallest node of its component. The rows are stored after every second round; rounds grow
    with the logarithm of the longest path. A step is one shuffle by node, whose copies go and whose least neighbour is found where
    they arrive; a hub's edges are sorted in one task, which can spill them.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    now = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _stars(now):
        for _ in range(2):
            now = _small_star(_large_star(now))
        now = stored(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select("v", "v").toDF("node", "component")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every edge leads to the smallest node of its component: no node leads to two, or to one that leads on."""
    ends = edges.select(F.col("u").alias("node"), "v").unionByName(edges.select(F.col("v").alias("node"), F.lit(None).alias("v")))
    least, most, leads = F.min("v"), F.max("v"), F.count("v")
    nodes = ends.groupBy("node").agg((leads > 0).alias("leads"), ((least < most) | (F.count(F.lit(1)) > leads)).alias("more"))
    return nodes.filter("leads AND more").count() == 0


def _with_least(edges: DataFrame) -> DataFrame:
    """The distinct edges with m, the smallest neighbour v of each node u."""
    here = edges.repartition("u").distinct()  # needs no second shuffle: the rows of u are together
    return here.withColumn("m", F.min("v").over(Window.partitionBy("u")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node in place of the smallest, are tied to the smallest of them."""
    return _with_least(edges).select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
