"""Small relational builders shared by the plans: look-backs, latest row, ratios, set differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def since(column: str, as_of: str, days: int) -> Column:
    """Rolling look-back on a zone-less timestamp column.

    The bound folds to a literal, so it reaches the parquet scan as a pushed filter.
    """
    return F.col(column) >= F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL '{days}' DAY")


def between_half_open(column: str, start: str | None, end: str | None) -> Column:
    """``[start, end)`` slice on a timestamp column; a missing bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(column) >= F.expr(f"TIMESTAMP_NTZ '{start}'"))
    if end is not None:
        condition = condition & (F.col(column) < F.expr(f"TIMESTAMP_NTZ '{end}'"))
    return condition


def latest_by(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Newest row per key as one aggregate.

    ``max_by`` has a partial step, so a hot key is reduced before the shuffle;
    a ``row_number`` window would move every row of the key into one task.
    """
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_newest.{v}").alias(v) for v in values])


def rate_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, NULL when the whole is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def distinct_values(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct non-NULL values found in any of the columns, from one pass over the rows."""
    values = F.explode(F.array(*[F.col(c) for c in columns])).alias(name)
    return df.select(values).where(F.col(name).isNotNull()).distinct()


def anti(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def union_all_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def tag_map(**entries: str) -> Column:
    """Map column from tag columns, without the entries that are NULL."""
    pairs = [part for key, column in entries.items() for part in (F.lit(key), F.col(column))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def sorted_set(column: str) -> Column:
    return F.array_sort(F.collect_set(column))


def has_columns(df: DataFrame, required: list[str]) -> bool:
    """Whether all required columns are in the frame; an empty list is fulfilled."""
    return set(required) <= set(df.columns)
