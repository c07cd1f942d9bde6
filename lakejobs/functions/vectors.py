"""Vector search over an array column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def top_k(df: DataFrame, vector: str, query: list[float], k: int, tie: str, condition: Column | None = None) -> DataFrame:
    """Exact nearest rows: one scan, the k best of each task, then the k best of those."""
    target = F.array(*[F.lit(float(x)) for x in query])
    rows = df.where(condition) if condition is not None else df
    return rows.withColumn("score", cosine(F.col(vector), target)).orderBy(F.desc("score"), tie).limit(k)
