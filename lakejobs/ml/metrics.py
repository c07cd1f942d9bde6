"""Classification metrics, votes and forecasts as aggregates and expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.operators.ordered import discrete_percentiles, running_totals
from lakejobs.session import written

EPS = 1e-15


def vote(parts: Sequence[tuple[Column, float]]) -> Column:
    """Weighted mean of probability arrays of equal length."""

    def times(weight: float):
        return lambda p: p * weight

    total: Column | None = None
    for array, weight in parts:
        scaled = F.transform(array, times(weight))
        total = scaled if total is None else F.zip_with(total, scaled, lambda a, b: a + b)
    return total


def argmax(probability: Column) -> Column:
    """Index of the greatest probability, the first one on ties."""
    return (F.array_position(probability, F.array_max(probability)) - 1).cast("int")


def class_metrics(scored: DataFrame, label: str, probability: str, classes: int) -> DataFrame:
    """Accuracy, log loss and mean Brier score in one aggregate."""
    p, y = F.col(probability), F.col(label)
    truth = F.get(p, y)
    brier = sum((F.pow(F.get(p, F.lit(c)) - (y == c).cast("double"), F.lit(2.0)) for c in range(classes)), F.lit(0.0)) / classes
    return scored.agg(
        F.count("*").alias("rows"), F.avg((argmax(p) == y).cast("double")).alias("accuracy"),
        F.avg(-F.log(F.greatest(truth, F.lit(EPS)))).alias("log_loss"), F.avg(brier).alias("brier"))


def confusion(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("rows"))


def class_report(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class from the confusion counts."""
    counts = confusion(scored, label, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    role = F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("rows").alias("support"), F.lit(0).cast("long").alias("claimed"), hit.alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), F.col("rows").alias("claimed"),
                 F.lit(0).cast("long").alias("hit")))).alias("r")
    summed = counts.select(role).groupBy("r.class").agg(
        F.sum("r.support").alias("support"), F.sum("r.claimed").alias("claimed"), F.sum("r.hit").alias("hit"))
    precision = F.coalesce(F.try_divide("hit", "claimed"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return summed.select("class", "support", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def roc_auc(scored: DataFrame, label: str, score: Column) -> DataFrame:
    """Exact area under the ROC curve; equal scores count half.

    Equal scores are counted first, and the negatives below each score are a
    running sum in slices of the score axis.
    """
    counted = written(scored.groupBy(score.alias("score")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) == 0).cast("long")).alias("neg")))
    ranked = running_totals(counted, [], ["score"], {"below": F.col("neg")}).withColumn(
        "won", F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    return ranked.agg((F.sum("won") / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def fixtures(df: DataFrame, group: str, team: str, position: str) -> DataFrame:
    """Every pair of teams inside each group, the earlier position as home side.

    The result itself holds all pairs; groups are small by definition (a tournament group).
    """
    a = df.select(F.col(group).alias("grp"), F.col(team).alias("home_team"), F.col(position).alias("_p"))
    b = df.select(F.col(group).alias("grp"), F.col(team).alias("away_team"), F.col(position).alias("_q"))
    return a.join(b, "grp").where("_p < _q").drop("_p", "_q")


def forecast(daily: DataFrame, keys: list[str], day: str, value: str, horizon: int, width: float = 1.28) -> DataFrame:
    """Trend plus weekday mean of the residuals for ``horizon`` days after each series' last day, with bounds."""
    x = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("double")
    base = daily.select(*keys, F.col(day).alias("day"), F.col(value).cast("double").alias("y"), x.alias("x"))
    line = base.groupBy(*keys).agg(
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.max("day").alias("last"))
    fitted = base.join(line, keys)
    residual = F.col("y") - F.col("intercept") - F.col("slope") * F.col("x")
    season = fitted.groupBy(*keys, F.dayofweek("day").alias("dow")).agg(F.avg(residual).alias("shift"))
    spread = fitted.withColumn("dow", F.dayofweek("day")).join(season, [*keys, "dow"]).groupBy(*keys).agg(
        F.stddev_pop(residual - F.col("shift")).alias("sd"))
    ahead = line.join(spread, keys).withColumn(
        "day", F.explode(F.expr(f"sequence(date_add(last, 1), date_add(last, {horizon}), INTERVAL 1 DAY)"))
    ).withColumn("dow", F.dayofweek("day")).join(season, [*keys, "dow"], "left")
    at = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("double")
    guess = F.col("intercept") + F.col("slope") * at + F.coalesce("shift", F.lit(0.0))
    return ahead.select(
        *keys, "day", guess.alias("forecast"), (guess - width * F.col("sd")).alias("lower"),
        (guess + width * F.col("sd")).alias("upper"))


def median_ape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Median absolute percentage error, exact (rows with actual 0 are left out)."""
    error = F.try_divide(F.abs(F.col(actual) - F.col(predicted)), F.abs(F.col(actual)))
    found = discrete_percentiles(df.select(error.alias("error")), [], "error", {"half": 0.5})
    return found.select((100.0 * F.col("half")).alias("mdape_pct"))
