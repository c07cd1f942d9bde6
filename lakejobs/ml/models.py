"""Model jobs on Spark ML: splits, training, search, calibration, importance."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.session import written


def hash_split(df: DataFrame, key: str, shares: dict[str, int], seed: int = 42, name: str = "part") -> DataFrame:
    """Named parts by a hash of the key: the same row lands in the same part on every run and cluster size."""
    slot = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(sum(shares.values())))
    part, upper = None, 0
    for label, share in shares.items():
        upper += share
        part = F.when(slot < upper, label) if part is None else part.when(slot < upper, label)
    return df.withColumn(name, part)


def assemble(features: Sequence[str], scale: bool = True) -> list:
    """Stages for a feature vector; standardised when ``scale``. NULLs are to be filled before."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw_features" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return stages


def fill(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.fillna(0, list(features))


def classifier(kind: str, classes: int = 2, weight: str | None = None, seed: int = 42, **params):
    """forest, boosting (one-vs-rest above two classes) or logistic."""
    extra = {"weightCol": weight} if weight else {}
    if kind == "forest":
        return RandomForestClassifier(labelCol="label", seed=seed, **extra, **{"numTrees": 20, "maxDepth": 5, **params})
    if kind == "boosting":
        base = GBTClassifier(labelCol="label", seed=seed, **extra, **{"maxIter": 5, "maxDepth": 3, **params})
        return base if classes == 2 else OneVsRest(classifier=base, labelCol="label", **({"weightCol": weight} if weight else {}))
    if kind == "logistic":
        family = "binomial" if classes == 2 else "multinomial"
        return LogisticRegression(labelCol="label", family=family, **extra, **{"maxIter": 30, **params})
    raise ValueError(kind)


def train(df: DataFrame, features: Sequence[str], estimator, scale: bool = True):
    return Pipeline(stages=[*assemble(features, scale), estimator]).fit(fill(df, features))


def search(
    df: DataFrame, features: Sequence[str], estimator, grid: dict, folds: int = 5, metric: str = "logLoss", parallelism: int = 2, seed: int = 42
):
    """Cross-validated search over a parameter grid; returns (best model, trials frame).

    Rows fall into folds by ``rand(seed)``, as in Spark's ``CrossValidator``. The
    features of a fold's training rows are assembled and scaled once for all trials.
    """
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(estimator.getParam(param), values)
    combos = builder.build()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
    ready = fill(df, features)
    placed = ready.withColumn("_at", F.rand(seed)).persist()
    marks = [0.0] * len(combos)
    try:
        for fold in range(folds):
            own = (F.col("_at") >= fold / folds) & (F.col("_at") < (fold + 1) / folds)
            scale = Pipeline(stages=assemble(features)).fit(placed.where(~own))
            scaled = scale.transform(placed).select("label", "features", own.alias("_own")).persist()
            train_rows, own_rows = scaled.where(~F.col("_own")), scaled.where("_own")
            try:
                with ThreadPool(min(parallelism, len(combos))) as pool:
                    found = pool.map(
                        lambda combo: evaluator.evaluate(estimator.copy(combo).fit(train_rows).transform(own_rows)), combos)
            finally:
                scaled.unpersist()
            marks = [mark + score / folds for mark, score in zip(marks, found)]
    finally:
        placed.unpersist()
    best = (max if evaluator.isLargerBetter() else min)(range(len(combos)), key=lambda i: marks[i])
    trials = [
        (i, ", ".join(sorted(f"{p.name}={v}" for p, v in combo.items())), float(score))
        for i, (combo, score) in enumerate(zip(combos, marks))
    ]
    return train(df, features, estimator.copy(combos[best])), df.sparkSession.createDataFrame(
        trials, "trial int, params string, metric double")


@dataclass(frozen=True)
class Range:
    """A range that a parameter is drawn from: by its logarithm or evenly, whole numbers or not."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def draw(self, rng: random.Random) -> float | int:
        value = math.exp(rng.uniform(math.log(self.low), math.log(self.high))) if self.log else rng.uniform(self.low, self.high)
        return min(int(self.high), max(int(self.low), round(value))) if self.whole else value


#: Rounds of ``random_search``: share of the rows, folds that are scored, and share of the trials that go on.
ROUNDS = ((0.25, 1, 0.25), (1.0, 2, 0.25), (1.0, 5, 0.0))
#: Bytes of rows that fits side by side hold at once: each keeps a copy of its rows.
FIT_BYTES = 4 << 30
TRIALS = "round int, trial int, params map<string,double>, folds int, metric double"


def random_search(
    df: DataFrame, features: Sequence[str], estimator, space: dict[str, Range], trials: int = 96, folds: int = 5, metric: str = "logLoss",
    parallelism: int = 8, rounds: Sequence[tuple[float, int, float]] = ROUNDS, key: str | None = None, seed: int = 42
):
    """Seeded random search with successive halving; returns (best model, a row for each trial and round).

    Parameters are drawn from continuous ranges. The first round fits every trial on a part of the rows and
    scores it on one fold; the best go on to more rows and folds, the last ones to all ``folds``.
    Folds and parts come from a hash (of ``key``, else of the features), so they are the same
    on every run. Trials of a round run side by side as Spark jobs, at most ``parallelism`` and
    fewer where the copies of their rows would pass ``FIT_BYTES``; the rows of a fold are persisted for all its trials.
    """
    rng = random.Random(seed)
    larger = MulticlassClassificationEvaluator(metricName=metric).isLargerBetter()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
    drawn = [{name: r.draw(rng) for name, r in sorted(space.items())} for _ in range(trials)]
    at = F.xxhash64(F.lit(seed), *([key] if key else features))
    ready = fill(df, features).select("label", *features, F.pmod(at, F.lit(folds)).alias("_fold"), F.pmod(F.xxhash64(at), F.lit(10_000)).alias("_part"))
    # The features are assembled and scaled once for all fits.
    scale = Pipeline(stages=assemble(features)).fit(ready)
    rows = scale.transform(ready).select("label", "features", "_fold", "_part").persist()
    try:
        left, report = list(range(trials)), []
        for no, (share, scored, go_on) in enumerate(rounds, 1):
            data = rows.where(F.col("_part") < int(share * 10_000)) if share < 1 else rows
            found: list[list[float]] = []
            for fold in range(min(scored, folds)):
                # Persisted, so that each of the trials reads the rows of its fit, not all rows to leave most of them out.
                others = data.where(F.col("_fold") != fold).select("label", "features").persist()
                own = data.where(F.col("_fold") == fold).select("label", "features").persist()
                try:
                    held = others.count() * 8 * (len(features) + 2)
                    with ThreadPool(max(1, min(parallelism, FIT_BYTES // max(1, held)))) as pool:
                        found.append(pool.map(lambda trial, others=others, own=own: evaluator.evaluate(
                            estimator.copy({estimator.getParam(n): v for n, v in drawn[trial].items()}).fit(others).transform(own)), left))
                finally:
                    others.unpersist()
                    own.unpersist()
            marks = [sum(scores) / len(scores) for scores in zip(*found)]
            report += [(no, i, {n: float(v) for n, v in drawn[i].items()}, min(scored, folds), float(m)) for i, m in zip(left, marks)]
            ranked = [i for _, i in sorted(zip(marks, left), key=lambda x: (-x[0] if larger else x[0], x[1]))]
            left = ranked[:max(1, round(len(ranked) * go_on))]
        best = estimator.copy({estimator.getParam(n): v for n, v in drawn[left[0]].items()})
        model = PipelineModel([*scale.stages, best.fit(rows)])
    finally:
        rows.unpersist()
    return model, df.sparkSession.createDataFrame(report, TRIALS)


def best_run(trials: DataFrame, metric: str, larger: bool = False, alias: str = "champion") -> DataFrame:
    """The trial with the best metric, with its alias."""
    pick = F.max_by if larger else F.min_by
    return trials.agg(pick(F.struct(*trials.columns), F.col(metric)).alias("r")).select("r.*", F.lit(alias).alias("alias"))


def probabilities(scored: DataFrame, column: str = "probability") -> Column:
    return vector_to_array(F.col(column))


def importance(model, features: Sequence[str]) -> DataFrame:
    """Ranked tree importances with the ratio of each to the next (as many rows as features)."""
    values = model.stages[-1].featureImportances.toArray()
    rows = sorted(((n, float(v)) for n, v in zip(features, values)), key=lambda r: (-r[1], r[0]))
    table = [
        (i + 1, n, v, (v / rows[i + 1][1]) if i + 1 < len(rows) and rows[i + 1][1] else None) for i, (n, v) in enumerate(rows)]
    from pyspark.sql import SparkSession

    return SparkSession.active().createDataFrame(table, "rank int, feature string, importance double, ratio_to_next double")


def calibrate(scored: DataFrame, probability: str, label: str, classes: int, key: str, folds: int = 5) -> DataFrame:
    """Isotonic calibration per class and renormalised probabilities, as ``calibrated``.

    ``probability`` is an array column. Rows fall into ``folds`` by a hash of
    ``key``; each fold is calibrated by a fit on the other folds, so no row takes
    part in its own fit. Rows of equal score are one weighted row of the fit: they
    are counted once for all fits, by class and fold, and the fits read the counts.
    One pass then applies the fits.
    """
    placed = scored.withColumn("_fold", F.pmod(F.xxhash64(F.lit(7), key), F.lit(folds)))
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), F.get(F.col(probability), F.lit(c)).alias("score"), (F.col(label) == c).cast("long").alias("hit"))
        for c in range(classes)])).alias("e")
    counts = written(placed.select("_fold", entries).select("_fold", "e.*").groupBy("class", "score", "_fold").agg(
        F.sum("hit").alias("hits"), F.count("hit").alias("known"), F.count("*").alias("rows")))
    out = placed
    for c in range(classes):
        out = out.withColumn("_f", array_to_vector(F.array(F.get(F.col(probability), F.lit(c)))))
        own = F.lit(None).cast("double")
        for fold in range(folds):
            equal = counts.where((F.col("class") == c) & (F.col("_fold") != fold)).groupBy("score").agg(
                (F.sum("hits") / F.sum("known")).alias("target"), F.sum("rows").cast("double").alias("weight"))
            fit = IsotonicRegression(
                featuresCol="score", labelCol="target", weightCol="weight", predictionCol=f"_c{c}_{fold}",
            ).fit(equal.select(array_to_vector(F.array("score")).alias("score"), "target", "weight"))
            out = fit.setFeaturesCol("_f").transform(out)
            own = F.when(F.col("_fold") == fold, F.col(f"_c{c}_{fold}")).otherwise(own)
        out = out.withColumn(f"_c{c}", own).drop("_f", *[f"_c{c}_{fold}" for fold in range(folds)])
    parts = F.array(*[F.greatest(F.col(f"_c{c}"), F.lit(1e-9)) for c in range(classes)])
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return out.withColumn("calibrated", F.transform(parts, lambda x: x / total)).drop("_fold", *[f"_c{c}" for c in range(classes)])


def regressor(weight: str | None = None, **params) -> GBTRegressor:
    extra = {"weightCol": weight} if weight else {}
    return GBTRegressor(labelCol="label", seed=42, **extra, **{"maxIter": 10, "maxDepth": 4, **params})
