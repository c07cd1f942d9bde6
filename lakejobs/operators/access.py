"""Row filters and column masks as data jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_row_filter(df: DataFrame, column: str, grants: DataFrame, principal: str, admins: set[str] = frozenset()) -> DataFrame:
    """Rows whose value is granted to the principal; ``grants`` has (principal, value). Admins see all rows."""
    if principal in admins:
        return df
    own = grants.where(F.col("principal") == principal).select(F.col("value").alias(column))
    return df.join(own, column, "left_semi")


def apply_masks(df: DataFrame, masks: dict[str, tuple[str, Column]], groups: set[str]) -> DataFrame:
    """Replace columns by their mask unless the caller is in the column's group: {column: (group, mask)}."""
    hidden = {c: mask for c, (group, mask) in masks.items() if group not in groups}
    return df.withColumns(hidden) if hidden else df


def apply_tag_policy(
    df: DataFrame, column_tags: dict[str, set[str]], mask_rules: dict[str, tuple[str, object]], groups: set[str]
) -> DataFrame:
    """Tag-driven masks: every column with a tag gets the tag's mask, a function of the column.

    ``column_tags`` maps column to tags (a schema-sized config); ``mask_rules`` maps
    tag to (group that may see it, function). A column with several tags takes the
    first rule, in the order of ``mask_rules``, that the caller is not cleared for.
    """
    hidden = {}
    for column, tags in column_tags.items():
        for tag, (group, mask) in mask_rules.items():
            if tag in tags and group not in groups and column in df.columns:
                hidden[column] = mask(F.col(column))
                break
    return df.withColumns(hidden) if hidden else df


def filter_views(spark, filters: dict[str, tuple[DataFrame, Column]], suffix: str = "_filtered") -> list[str]:
    """One temp view per table with its row filter put in; returns the view names."""
    names = []
    for table, (df, condition) in filters.items():
        df.where(condition).createOrReplaceTempView(f"{table}{suffix}")
        names.append(f"{table}{suffix}")
    return names
