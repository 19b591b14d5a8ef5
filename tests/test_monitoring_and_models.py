import math
from datetime import date, timedelta

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows
from sidelines import registry
from sidelines.plans import models, monitoring
from sidelines.schemas import MODEL_MONITORING_LOG
from sidelines.sources.star import StarDomain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def team_features(spark):
    return registry._team_features(StarDomain(spark, SF_DIR)).persist()


@pytest.fixture(scope="module")
def player_features(spark):
    return registry._player_features(StarDomain(spark, SF_DIR)).persist()


def test_labels_are_filled_once(spark):
    predictions = spark.createDataFrame([("a", 1, None), ("b", 1, False), ("c", 1, None), ("d", 1, None)],
                                        "game_id string, model_version_id int, actual_label boolean")
    games = spark.createDataFrame([("a", 9, True), ("b", 9, True), ("c", None, None)],
                                  "game_id string, home_score int, home_win boolean")
    assert rows(monitoring.backfill_labels(predictions, games), "game_id", "actual_label") == [
        ("a", True), ("b", False), ("c", None), ("d", None)]


def test_weekly_metrics_by_hand(spark):
    predictions = spark.createDataFrame(
        [("a", 1, 0.8, True, True), ("b", 1, 0.0, False, True), ("c", 1, 0.4, False, None)],
        "game_id string, model_version_id int, predicted_home_win_prob double, predicted_label boolean, actual_label boolean")
    games = spark.createDataFrame([(g, date(2024, 1, 3)) for g in "abc"], "game_id string, game_date date")
    got = monitoring.weekly_metrics(predictions, games).first()
    assert (got["week_start"], got["n_predictions"], got["accuracy"]) == (date(2024, 1, 1), 2, 0.5)
    assert got["log_loss"] == pytest.approx((-math.log(0.8) - math.log(1e-6)) / 2)
    assert got["brier_score"] == pytest.approx((0.04 + (1 - 1e-6) ** 2) / 2)


def weeks(spark, *series):
    monday = date(2024, 1, 1)
    return spark.createDataFrame([(m, monday + timedelta(weeks=w), a) for m, values in enumerate(series, 1)
                                  for w, a in enumerate(values)], "model_version_id long, week_start date, accuracy double")


def test_drift(spark):
    metrics = weeks(spark, [0.1], [0.75, 0.7], [0.75, 0.69], [0.0, 0.7, 0.7, 0.7, 0.7, 0.6], [0.5, 0.9])
    alerts = monitoring.drift_alerts(metrics)
    got = {r["model_version_id"]: r for r in alerts.collect()}
    # one week never alerts; a drop of 0.05 (here a little more in binary) is the edge; only four weeks count
    assert set(got) - {2} == {3, 4}
    assert got[4]["trailing_avg_accuracy"] == pytest.approx(0.7) and got[4]["drop"] == pytest.approx(0.1)
    exact = monitoring.drift_alerts(weeks(spark, [0.5, 0.25]), threshold=0.25)
    assert exact.count() == 0


def test_log_is_refreshed(spark):
    log = spark.createDataFrame([], MODEL_MONITORING_LOG)
    metrics = weeks(spark, [0.123456, 0.5]).selectExpr("*", "3L as n_predictions", "0.1 as log_loss", "0.2 as brier_score")
    once = monitoring.updated_log(log, metrics)
    twice = monitoring.updated_log(once, metrics.withColumn("accuracy", F.lit(0.9)))
    assert [str(r[0]) for r in once.orderBy("week_start").select("accuracy").collect()] == ["0.1235", "0.5000"]
    assert twice.count() == 2 and {str(r[0]) for r in twice.select("accuracy").collect()} == {"0.9000"}
    versions = spark.createDataFrame([(1, "m", "v1")], "model_version_id long, model_name string, version_tag string")
    assert monitoring.accuracy_history(twice, versions).count() == 2
    assert monitoring.accuracy_history(twice, versions, "other").count() == 0


def test_registry_is_idempotent(spark):
    versions = spark.createDataFrame([], "model_version_id long, model_name string, version_tag string")
    versions, first = models.register_version(versions, "m", "v1")
    versions, second = models.register_version(versions, "m", "v2")
    again, known = models.register_version(versions, "m", "v1")
    assert (first, second, known, again.count()) == (1, 2, 1, 2)


def test_auc_equals_the_evaluator(spark):
    df = spark.range(4000).select(((F.hash("id") % 50) / 100.0 + 0.5).alias("p"),
                                  (F.abs(F.hash("id", F.lit(1))) % 3 == 0).cast("int").alias("y"))
    ours = models.binary_metrics(df, "p", "y").first()
    vector = F.udf(lambda p: Vectors.dense([1 - p, p]), returnType=__import__("pyspark.ml.linalg", fromlist=["VectorUDT"]).VectorUDT())
    other = BinaryClassificationEvaluator(rawPredictionCol="r", labelCol="y", numBins=0).evaluate(
        df.withColumn("r", vector("p")).withColumn("y", F.col("y").cast("double")))
    assert ours["auc"] == pytest.approx(other, abs=1e-9)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0.2, 0), (0.4, 0)], "p double, y int")
    got = models.binary_metrics(df, "p", "y").first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"], got["auc"]) == (1.0, 0.0, 0.0, 0.0, None)


@pytest.fixture(scope="module")
def baseline(spark, team_features):
    return models.train_outcome_baseline(team_features)


def test_baseline_is_repeatable_and_can_be_saved(spark, baseline, team_features, tmp_path):
    model, metrics = baseline
    first = metrics.first()
    assert first["n_rows"] > 300 and 0.4 < first["accuracy"] <= 1 and 0 <= first["auc"] <= 1
    again = models.train_outcome_baseline(team_features.repartition(5))[1].first()
    assert again["accuracy"] == first["accuracy"] and again["auc"] == pytest.approx(first["auc"], abs=1e-6)
    models.save_model(model, str(tmp_path / "m"))
    loaded, names = models.load_model(str(tmp_path / "m"))
    assert names == models.FORM_FEATURES
    sample = models.outcome_training(team_features)
    assert rows(models.predict(loaded, sample).select("game_id", "probability")) == rows(
        models.predict(model, sample).select("game_id", "probability"))


def test_boosted_comparison_scoring_and_log(spark, baseline, team_features):
    model, comparison = models.train_outcome_boosted(team_features, rounds=5)
    by_label = {r["label"]: r for r in comparison.collect()}
    assert set(by_label) == {"v1_form", "v2_form_and_rest"}
    assert by_label["v1_form"]["n_rows"] == by_label["v2_form_and_rest"]["n_rows"]
    assert by_label["v1_form"]["accuracy_lift"] == 0.0

    importances = models.feature_importances(model, models.OUTCOME_FEATURES, spark).collect()
    assert len(importances) == 7 and sum(r["importance"] for r in importances) == pytest.approx(1.0)

    requests = registry._requests(StarDomain(spark, SF_DIR))
    scored = models.score_outcomes(requests, {models.BASELINE_MODEL: baseline[0], models.BOOSTED_MODEL: model})
    assert scored.count() == requests.count()
    bad = scored.filter("(days_rest is null) != (model_used = 'game_outcome_logreg') or home_win_probability not between 0 and 1")
    assert bad.count() == 0
    assert scored.filter("(refused is null) != (home_win_probability is not null)").count() == 0
    assert 0 < scored.filter("refused is not null").count() < scored.count()
    boosted = models.score_outcomes(requests, {models.BOOSTED_MODEL: model})
    assert boosted.count() == requests.count() and "no model game_outcome_logreg" in {r[0] for r in boosted.select("refused").collect()}
    lacking = requests.limit(3).withColumn("rolling_point_diff", F.lit(None).cast("double"))
    assert {r["refused"][:7] for r in models.score_outcomes(lacking, {models.BOOSTED_MODEL: model}).collect()} == {"missing"}
    only = models.score_outcomes(requests, {models.BASELINE_MODEL: baseline[0]})
    assert rows(only.select("model_used").distinct()) == [("game_outcome_logreg",)]

    logged = spark.createDataFrame([], "game_id string, model_version_id long")
    new = models.new_predictions(model, team_features, logged, 1)
    assert new.count() == models.prediction_candidates(team_features).count()
    assert models.new_predictions(model, team_features, new, 1).count() == 0
    assert models.new_predictions(model, team_features, new, 2).count() == new.count()


def test_decline_model(spark, player_features):
    model, metrics = models.train_decline(player_features, rounds=3)
    got = metrics.first()
    assert 0 <= got["precision"] <= 1 and 0 < got["recall"] <= 1
    requests = models.decline_training(player_features).select("player_id", "game_id", *models.DECLINE_FEATURES)
    scored = models.score_decline(requests, model)
    assert scored.filter("decline_risk_score between 0 and 1").count() == requests.count()
    lacking = requests.limit(2).withColumn("rolling_minutes", F.lit(None).cast("double"))
    refused = models.score_decline(lacking, model).collect()
    assert len(refused) == 2 and all(r["refused"] and r["decline_flag"] is None for r in refused)


def test_class_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert rows(models.with_class_weight(df, "y").distinct()) == [(0, 1.0), (1, 3.0)]
