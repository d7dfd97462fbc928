"""Connected components by alternating large-star and small-star rounds.

Each round hangs every node's neighbours on the smallest node it knows; edges
stay at most as many as before, and the rounds end when the edges are stars
(about log of the longest path; none where they come as stars).  Every step is a partial aggregate and an equi-join;
no neighbourhood is collected, and the smallest node of a large component is
only ever a join key with one row on one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import written


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node hangs on one other, which hangs on none."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; component is its smallest reachable node.

    ``edges`` has long columns a and b; direction, loops, repeats and nulls do not matter.
    """
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "components")
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = written(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                        .where("a != b").distinct(), "components")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = written(hung.unionByName(low.withColumnRenamed("low", "b")).distinct(), "components")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
