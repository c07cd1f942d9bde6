"""Score scaling and model-score expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_scores(df: DataFrame, columns: dict[str, bool]) -> DataFrame:
    """Add ``<column>_score`` on a 0-100 scale; False turns the scale round; a constant column scores 50."""
    bounds = df.agg(F.struct(*[
        F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns
    ]).alias("_bounds")).scalar()
    joined = df.withColumn("_bounds", bounds)
    for c, upward in columns.items():
        lo, hi = F.col(f"_bounds.{c}.lo"), F.col(f"_bounds.{c}.hi")
        share = F.lit(100.0) * (F.col(c).cast("double") - lo) / (hi - lo)
        score = share if upward else F.lit(100.0) - share
        joined = joined.withColumn(f"{c}_score", F.when(hi == lo, F.lit(50.0)).otherwise(F.round(score, 2)))
    return joined.drop("_bounds")


def expected_goals(p_home: Column, p_draw: Column, p_away: Column, total: float = 2.5) -> Column:
    """Expected goals of both sides: the goal total split by win share plus half the draw share."""
    home, away = p_home + 0.5 * p_draw, p_away + 0.5 * p_draw
    return F.struct(
        round_half_up(total * home / (home + away), 2).alias("xg_home"),
        round_half_up(total * away / (home + away), 2).alias("xg_away"))


def round_half_up(value: Column, digits: int) -> Column:
    """Round by the decimal value, so 1.7249999999999999 counts as 1.725."""
    return F.round(value.cast("decimal(20,10)"), digits).cast("double")


def recency_weight(age_days: Column, rate: float = 0.1, floor_years: float = 0.01) -> Column:
    """Exponential decay by age in years."""
    return F.exp(F.lit(-rate) * F.greatest(age_days / 365.0, F.lit(floor_years)))
