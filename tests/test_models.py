"""Match features against plain loops; splits, calibration and the model queries."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from lakejobs.ml import metrics, models
from lakejobs.operators import match_features as mf
from lakejobs.operators.ordered import plan_slices
from tests.conftest import SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def played(tables):
    return tables.matches.limit(300).toPandas().sort_values(["match_date", "match_id"])


def test_form_equals_a_loop(spark, tables, played):
    got = {(r["match_id"], r["side"]): r for r in mf.recent_form(spark.createDataFrame(played)).collect()}
    history = defaultdict(list)
    for m in played.itertuples(index=False):
        sides = [("home", m.home_team, m.home_score, m.away_score), ("away", m.away_team, m.away_score, m.home_score)]
        for side, team, _, _ in sides:
            recent = history[team][-10:]
            r = got[m.match_id, side]
            assert r["form_matches"] == len(recent)
            if recent:
                ws = [math.exp(-0.15 * max((m.match_date - d).days, 1) / 365.0) for d, _, _ in recent]
                goals = sum(w * gf for w, (_, gf, _) in zip(ws, recent)) / sum(ws)
                assert abs(r["form_w_gf"] - goals) < 1e-4
        for side, team, gf, ga in sides:
            history[team].append((m.match_date, gf, ga))


def test_sliced_features_equal_unsliced(tables):
    cut = plan_slices(tables.matches, "match_date", 150)
    assert not cut.single
    assert rows(mf.recent_form(tables.matches, slices=cut)) == rows(mf.recent_form(tables.matches))
    assert rows(mf.head_to_head(tables.matches, slices=cut)) == rows(mf.head_to_head(tables.matches))
    assert rows(mf.experience(tables.matches, slices=cut)) == rows(mf.experience(tables.matches))


def test_elo_equals_a_loop_and_slices_agree(spark, played):
    matches = spark.createDataFrame(played)
    whole = mf.elo_history(matches)
    sliced = mf.elo_history(matches, rows_per_slice=70)
    assert rows(whole) == rows(sliced)
    got = {r["match_id"]: r for r in whole.collect()}
    rating = defaultdict(lambda: 1500.0)
    k_of = {"FIFA World Cup": 60, "FIFA World Cup qualification": 40, "Copa América": 50, "UEFA Nations League": 40, "Friendly": 20}
    for m in played.itertuples(index=False):
        a, b = rating[m.home_team], rating[m.away_team]
        expected = 1 / (1 + 10 ** ((b - a - 50) / 400))
        gap = abs(m.home_score - m.away_score)
        mult = 1.0 if gap <= 1 else 1.5 if gap == 2 else (11 + gap) / 8
        actual = 1.0 if m.home_score > m.away_score else 0.5 if m.home_score == m.away_score else 0.0
        change = k_of[m.tournament] * mult * (actual - expected)
        r = got[m.match_id]
        assert abs(r["home_elo_before"] - a) < 0.006 and abs(r["elo_win_prob_home"] - expected) < 6e-5
        rating[m.home_team], rating[m.away_team] = a + change, b - change


def test_elo_pools_are_independent(spark, played):
    two = spark.createDataFrame(played.assign(pool=played["match_id"] % 2))
    both = mf.elo_history(two, pool="pool")
    one = mf.elo_history(two.where("pool = 1"))
    assert rows(both.where("pool = '1'").drop("pool")) == rows(one.drop("pool"))


def test_hash_split_is_stable(tables):
    parts = {"train": 60, "validation": 20, "test": 20}
    split = models.hash_split(tables.orders, "o_orderkey", parts)
    moved = models.hash_split(tables.orders.repartition(5), "o_orderkey", parts)
    assert rows(split.select("o_orderkey", "part")) == rows(moved.select("o_orderkey", "part"))
    shares = {r["part"]: r["count"] / 1500 for r in split.groupBy("part").count().collect()}
    assert 0.55 < shares["train"] < 0.65 and set(shares) == set(parts)


def test_metrics_by_hand(spark):
    scored = spark.createDataFrame(
        [(0, [0.7, 0.2, 0.1]), (1, [0.2, 0.5, 0.3]), (2, [0.5, 0.3, 0.2])], "label int, p array<double>")
    got = metrics.class_metrics(scored, "label", "p", 3).first()
    assert abs(got["accuracy"] - 2 / 3) < 1e-9
    assert abs(got["log_loss"] + (math.log(0.7) + math.log(0.5) + math.log(0.2)) / 3) < 1e-9
    report = {r["class"]: r for r in metrics.class_report(
        scored.withColumn("predicted", metrics.argmax(F.col("p"))), "label", "predicted").collect()}
    assert report[0]["precision"] == 0.5 and report[0]["recall"] == 1.0 and report[2]["f1"] == 0.0
    binary = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, s double")
    assert metrics.roc_auc(binary, "label", F.col("s")).first()[0] == 0.75
    actual = spark.createDataFrame([(100.0, 110.0), (100.0, 80.0), (50.0, 50.0)], "a double, p double")
    assert abs(metrics.median_ape(actual, "a", "p").first()[0] - 10.0) < 1e-9


def test_calibration_sums_to_one(spark, tables):
    got = entry_module.queries()["calibrate_isotonic"](spark, SMALL)
    assert got.count() == tables.matches.count()
    assert got.where("abs(p0 + p1 + p2 - 1) > 0.00001").count() == 0


@pytest.mark.parametrize("key", ["train_classifier", "train_regressor", "tune_search", "feature_importance", "udf_model_score"])
def test_model_queries(spark, key):
    found = entry_module.queries()[key](spark, SMALL).collect()
    assert found
    if key == "train_classifier":
        assert all(r["log_loss"] < math.log(3) for r in found)  # better than equal shares
    if key == "feature_importance":
        assert abs(sum(r["importance"] for r in found) - 1) < 1e-6


def test_features_use_only_the_past(tables):
    """Dropping the later half of the matches changes no feature of the earlier half."""
    groups = tables.nation.select(F.col("n_nationkey").alias("team"), F.col("n_regionkey").alias("group"))
    early = tables.matches.where("match_date < DATE '1998-01-01'")
    whole = mf.match_features(tables.matches, groups, "2001-09-01").where("match_date < DATE '1998-01-01'")
    assert rows(whole) == rows(mf.match_features(early, groups, "2001-09-01"))


def test_boosting_with_three_classes(spark, tables):
    from lakejobs.plans.models import FEATURES, featured
    from lakejobs.tables import Tables

    table = featured(Tables(spark, SMALL))
    model = models.train(table, FEATURES, models.classifier("boosting", 3, maxIter=2, maxDepth=2))
    right = model.transform(models.fill(table, FEATURES)).where("prediction = label").count()
    most = table.groupBy("label").count().agg(F.max("count")).first()[0]
    assert right >= most * 0.9


def test_calibration_reads_the_scores_once_and_leaves_the_own_fold_out(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    made = [(i, (i * 7 % 20) / 20.0, int(i * 11 % 17 > 8)) for i in range(300)]
    scored = spark.createDataFrame(made, "id int, x double, y int").select("id", F.array(1 - F.col("x"), F.col("x")).alias("p"), "y").checkpoint()
    found = models.calibrate(scored, "p", "y", 2, "id")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    fold = scored.withColumn("fold", F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(5)))
    got = {r["id"]: r["calibrated"] for r in found.collect()}
    for number in range(5):
        others, own = fold.where(F.col("fold") != number), fold.where(F.col("fold") == number)
        raw = {}
        for c in range(2):
            def at(df, c=c):
                return df.select("id", array_to_vector(F.array(F.get("p", F.lit(c)))).alias("features"), (F.col("y") == c).cast("double").alias("label"))
            for r in IsotonicRegression().fit(at(others)).transform(at(own)).collect():
                raw.setdefault(r["id"], []).append(max(r["prediction"], 1e-9))
        for i, parts in raw.items():
            assert all(abs(a - b / sum(parts)) < 1e-9 for a, b in zip(got[i], parts))


def test_rating_slices_open_their_own_files(tables, spark, monkeypatch):
    plan = plan_slices(tables.matches, "match_date", 300)
    monkeypatch.setattr(mf, "plan_slices", lambda *_: plan)
    assert len(plan.borders) >= 2
    sliced = mf.elo_history(tables.matches)
    assert "orders.parquet" not in sliced._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(mf, "plan_slices", lambda *_: type(plan)())
    single = mf.elo_history(tables.matches)
    assert any("/elo-" in name for name in single.inputFiles()) and rows(sliced) == rows(single)


def test_bounds_build_the_features_once(spark, monkeypatch):
    import lakejobs.plans.models as plans

    calls = []
    real = plans.match_features
    monkeypatch.setattr(plans, "match_features", lambda *a: calls.append(1) or real(*a))
    entry_module.queries()["prediction_bounds"](spark, SMALL)
    assert len(calls) == 1


def test_features_of_the_fits_are_files_with_only_their_sums(spark, tables):
    """Each pass of a fit opens the columns it needs; the form is summed for the features that are asked for."""
    from lakejobs.plans.models import FEATURES, featured
    from lakejobs.tables import Tables

    made = featured(Tables(spark, SMALL))
    assert any("/features-" in name for name in made.inputFiles())
    groups = tables.nation.select(F.col("n_nationkey").alias("team"), F.col("n_regionkey").alias("group"))
    whole = mf.match_features(tables.matches, groups, "2001-09-01").select("match_id", *FEATURES)
    assert rows(made.select("match_id", *FEATURES)) == rows(whole)
    few = mf.FormSums(fields=("gf",))
    assert set(few.sums()) == {"s_w", "s_gf", "form_matches", "p_all", "p_new", "d_w", "d_gf"}


def test_trials_read_persisted_folds_and_few_large_fits_run_at_once(spark, monkeypatch):
    made = spark.range(400).select((F.col("id") % 3).cast("double").alias("label"), ((F.col("id") * 7) % 31 + F.col("id") % 3 * 9).cast("double").alias("x"))
    space = {"regParam": models.Range(1e-3, 1.0, log=True)}
    real, seen, sizes = models.LogisticRegression.fit, [], []
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, df, *a: seen.append(df.storageLevel.useMemory) or real(self, df, *a))
    pool = models.ThreadPool
    monkeypatch.setattr(models, "ThreadPool", lambda n: sizes.append(n) or pool(n))

    def run():
        _, trials = models.random_search(made, ["x"], models.classifier("logistic", 3, maxIter=3), space, trials=8, folds=3, rounds=((0.5, 1, 0.25), (1.0, 3, 0.0)))
        return [(r["round"], r["trial"], r["folds"], round(r["metric"], 9)) for r in trials.collect()]

    side_by_side = run()
    assert all(seen) and len(seen) == 8 + 2 * 3 + 1 and max(sizes) == 8
    del sizes[:]
    monkeypatch.setattr(models, "FIT_BYTES", 1)
    assert run() == side_by_side and set(sizes) == {1}
