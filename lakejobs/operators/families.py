"""Choose one child from each family: all combinations without a cross join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def spread_families(df: DataFrame, family: str, child: str) -> DataFrame:
    """Rows (group_id, family, child): group ``g`` holds the ``g``-th choice of one child per family.

    A combination is a number in a mixed-radix system whose digits are the child
    positions, so each (group, family) row knows its child by arithmetic and finds
    it with an equi join. Groups are counted out by ``spark.range`` over all tasks.
    Families and their sizes are configuration: one row per family is read to the
    driver to know how many combinations there are. Groups are in sorted order of
    the choices, so the ids do not depend on the plan.
    """
    spark = df.sparkSession
    members = df.select(F.col(family).alias("family"), F.col(child).alias("child")).withColumn(
        "position", F.row_number().over(Window.partitionBy("family").orderBy("child")) - 1)
    sizes = [(r["family"], r["n"]) for r in members.groupBy("family").agg(
        F.count("*").alias("n")).orderBy("family").collect()]
    total, digits = 1, []
    for name, size in reversed(sizes):
        digits.append(F.struct(
            F.lit(name).alias("family"), F.lit(total).cast("long").alias("stride"), F.lit(size).cast("long").alias("size")))
        total *= size
    groups = spark.range(total).select(F.col("id").alias("group_id"), F.explode(F.array(*digits)).alias("d"))
    placed = groups.select(
        "group_id", "d.family", (F.expr("group_id div d.stride") % F.col("d.size")).cast("int").alias("position"))
    return placed.join(members, ["family", "position"]).select("group_id", "family", "child")
