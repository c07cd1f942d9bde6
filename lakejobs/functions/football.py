"""Football result refinement: score text, date text, blow-outs and yearly wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.functions.strings import part


def refine_games(games: DataFrame) -> DataFrame:
    """Typed score and date columns from ``FT`` ('2-1') and ``Date`` ('Sat Aug 19 2000')."""
    named = games.drop("_rescued_data").withColumnsRenamed({"Team 1": "Team1", "Team 2": "Team2"})
    return named.select(
        "Round", "Team1", "Team2", part("FT", "-", 0).try_cast("int").alias("Score_T1"),
        part("FT", "-", 1).try_cast("int").alias("Score_T2"), part("Date", " ", 0).alias("DayOfWeek"),
        part("Date", " ", 1).alias("Month"), part("Date", " ", 2).alias("Day"), part("Date", " ", 3).alias("Year"))


def large_scores(games: DataFrame, lead: int = 4) -> DataFrame:
    """Games won by more than ``lead`` goals, from one pass."""
    return games.where(F.abs(F.col("Score_T1") - F.col("Score_T2")) > lead)


def wins_per_year(games: DataFrame) -> DataFrame:
    """Home and away wins per year and team, from one pass."""
    side = F.when(F.col("Score_T1") > F.col("Score_T2"), "home").when(F.col("Score_T1") < F.col("Score_T2"), "away")
    won = games.withColumn("side", side).where("side IS NOT NULL")
    team = F.when(F.col("side") == "home", F.col("Team1")).otherwise(F.col("Team2"))
    return won.groupBy("side", "Year", team.alias("team")).agg(F.count("*").alias("wins"))
