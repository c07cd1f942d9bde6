"""Connected components by contraction: every node moves to its smallest neighbour until no edge is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(a long, b long) -> (node, component): the smallest node reachable from each node that has an edge.

    Each round takes the smallest neighbour of every node (counted on the map
    side, so a node with many edges is no hot task), joins it to the labels so far and renames
    the edges by it; edges inside a group vanish. Rounds are written to the
    shared folder, so a lost executor costs one round. No edge reaches the driver.
    """
    edges = stored(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "edges")
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "lowest")
        labels = stored(labels.join(smallest, labels["component"] == smallest["a"], "left").select(
            "node", F.coalesce("low", "component").alias("component")), "labels")
        left = edges.join(smallest.select("a", F.col("low").alias("low_a")), "a")
        moved = left.join(smallest.select(F.col("a").alias("b"), F.col("low").alias("low_b")), "b")
        edges = stored(moved.select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
                       .where("a <> b").distinct(), "edges")
    return labels
