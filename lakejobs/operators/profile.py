"""One-pass column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.relational import rate_pct


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, NULLs and NULL share of each column, all from one aggregate."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count(c).alias(c) for c in columns])
    long = counts.unpivot(["_all"], columns, "column_name", "non_null_rows")
    missing = F.col("_all") - F.col("non_null_rows")
    return long.select(
        "column_name", F.col("_all").alias("total_rows"), missing.alias("null_rows"), "non_null_rows",
        F.coalesce(rate_pct(missing, F.col("_all")), F.lit(0.0)).alias("null_pct"))


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, distinct values, NULLs, least and greatest value of each column in one aggregate.

    Distinct values use a sketch: exact counts of many columns would expand every row per column.
    """
    parts = [F.count("*").alias("_all")]
    for c in columns:
        stats = F.struct(
            F.count(c).alias("filled"), F.approx_count_distinct(c, 0.01).alias("ndv"),
            F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("greatest"),
        )
        parts.append(F.struct(F.lit(c).alias("name"), stats.alias("s")).alias(c))
    one = df.agg(*parts)
    return one.select("_all", F.explode(F.array(*columns)).alias("c")).select(
        F.col("c.name").alias("column_name"), F.col("_all").alias("row_count"),
        (F.col("_all") - F.col("c.s.filled")).alias("null_count"), F.col("c.s.ndv").alias("ndv"),
        F.col("c.s.least").alias("min_value"), F.col("c.s.greatest").alias("max_value"))
