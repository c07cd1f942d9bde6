"""Root-to-leaf expansion of a parent-pointer hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.session import filed


def closure(edges: DataFrame, node: str, parent: str, name: str, max_depth: int = 1000) -> DataFrame:
    """One row per node with its root, parent, depth and path of names.

    Level by level: the rows of the last level meet their children in an equi join.
    The edges and each level are written to the shared folder, so the plan stays short,
    a small level is broadcast to the edges, and a lost executor costs one level. They are
    no checkpoints: those keep what Spark knows of ``parent`` as an expression of ``node``,
    and filters inferred from it double with every level. The loop is over depth, not over
    rows. (A recursive CTE would do for small trees but has a row limit.)
    """
    tree = filed(edges.select(F.col(node).alias("node_id"), F.col(parent).alias("parent_id"), F.col(name).alias("node_name")), "edges")
    level = tree.where("parent_id IS NULL").select(
        F.col("node_id").alias("ancestor_id"), "parent_id", "node_id", F.array("node_name").alias("node_path"),
        F.lit(0).alias("depth"))
    children = tree.where("parent_id IS NOT NULL").withColumnsRenamed({"node_id": "child_id", "parent_id": "at"})
    levels = [level]
    for depth in range(1, max_depth + 1):
        level = filed(level.join(children, F.col("node_id") == F.col("at")).select(
            "ancestor_id", F.col("at").alias("parent_id"), F.col("child_id").alias("node_id"),
            F.array_append("node_path", F.col("node_name")).alias("node_path"), F.lit(depth).alias("depth")), "level")
        if level.isEmpty():
            break
        levels.append(level)
    else:
        raise ValueError(f"deeper than {max_depth} levels, or a cycle")
    result = levels[0]
    for more in levels[1:]:
        result = result.unionAll(more)
    return result
