"""Keys and computed columns: surrogate keys, generated columns and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.ordered import Slices, dense_number


def identity_assign(
    df: DataFrame, order: list[str], name: str, start: int = 1, step: int = 1, existing: DataFrame | None = None,
    by_default: bool = False, slices: Slices | None = None,
) -> DataFrame:
    """Unique, gap-free surrogate keys in the order of ``order``; numbering goes on after ``existing``.

    A given value in the input is an error, or with ``by_default`` is kept.
    """
    if name in df.columns and not by_default:
        raise ValueError(f"{name} is generated always, the input must not hold it")
    first = start
    if existing is not None:
        newest = existing.agg((F.max(name) if step > 0 else F.min(name)).alias("m")).first()["m"]
        first = start if newest is None else newest + step
    if name not in df.columns:
        return dense_number(df, order, name, first, step, slices)
    given = df.where(F.col(name).isNotNull()).withColumn(name, F.col(name).cast("long"))
    missing = dense_number(df.where(F.col(name).isNull()).drop(name), order, name, first, step, slices)
    return given.unionByName(missing)


def with_generated(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Columns computed on write; an input that brings its own value is refused."""
    given = sorted(set(columns) & set(df.columns))
    if given:
        raise ValueError(f"generated columns must not be given: {given}")
    return df.withColumns(columns)


def primary_key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    counted = df.groupBy(*key).agg(F.count("*").alias("rows"))
    reason = F.when(missing, "null").otherwise("duplicate").alias("reason")
    return counted.where(missing | (F.col("rows") > 1)).select(*key, "rows", reason)


def foreign_key_violations(df: DataFrame, key: list[str], parent: DataFrame, parent_key: list[str]) -> DataFrame:
    """Distinct key values without a parent row; NULL keys are allowed."""
    present = df.select(*key).dropna().distinct()
    known = parent.select(*[F.col(p).alias(k) for k, p in zip(key, parent_key)])
    return present.join(known, key, "left_anti")


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL rows per NOT NULL column, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_rows").where("null_rows > 0")
