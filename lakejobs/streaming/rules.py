"""Row rules: warn, fail and report. They work on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def holds(rule: Column) -> Column:
    """A NULL outcome counts as a failure."""
    return F.coalesce(rule, F.lit(False))


def expect_warn(df: DataFrame, name: str, rules: dict[str, Column], observation: Observation | None = None) -> DataFrame:
    """Keep every row and count passes and failures while the frame is read for its real purpose.

    With an ``Observation`` the counts are read from it after a batch action;
    with a plain name they are in the progress of a streaming query.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    for rule, condition in rules.items():
        metrics += [F.count_if(holds(condition)).alias(f"{rule}_passed"), F.count_if(~holds(condition)).alias(f"{rule}_failed")]
    return df.observe(observation if observation is not None else name, *metrics)


def expect_fail(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Fail the job on the first row that breaks a rule."""
    checked = df
    for rule, condition in rules.items():
        stop = F.raise_error(F.lit(f"rule {rule} failed")).cast("boolean")
        checked = checked.where(F.when(holds(condition), F.lit(True)).otherwise(stop))
    return checked


def rule_report(df: DataFrame, dataset: str, rules: dict[str, Column]) -> DataFrame:
    """Passed and failed rows per rule from one aggregate."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count_if(holds(c)).alias(r) for r, c in rules.items()])
    long = counts.unpivot(["_all"], list(rules), "rule", "passed")
    return long.select(F.lit(dataset).alias("dataset"), "rule", "passed", (F.col("_all") - F.col("passed")).alias("failed"))
