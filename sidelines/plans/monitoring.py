"""Prediction log, weekly quality and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sidelines.functions import scalars as S
from sidelines.operators.keyed import upsert

ACCURACY_DROP = 0.05
TRAILING_WEEKS = 4


def backfill_labels(predictions: DataFrame, games: DataFrame) -> DataFrame:
    """Fill the actual label of predictions whose contest has a result. A label that is set stays."""
    results = games.filter(F.col("home_score").isNotNull()).select("game_id", "home_win")
    return (predictions.join(results, "game_id", "left")
            .withColumn("actual_label", F.coalesce("actual_label", "home_win"))
            .select(*predictions.columns))


def newly_labelled(predictions: DataFrame, games: DataFrame) -> DataFrame:
    """Only the predictions that ``backfill_labels`` would change: what an upsert of the log has to write."""
    results = games.filter(F.col("home_score").isNotNull()).select("game_id", "home_win")
    return (predictions.filter(F.col("actual_label").isNull()).join(results, "game_id")
            .select("game_id", "model_version_id", F.col("home_win").alias("actual_label"))
            .filter(F.col("actual_label").isNotNull()))


def weekly_metrics(predictions: DataFrame, games: DataFrame) -> DataFrame:
    """Accuracy, log loss and Brier score per model and week (Monday). Plain averages, combined before the shuffle."""
    scored = (predictions.filter(F.col("actual_label").isNotNull())
              .join(games.select("game_id", "game_date"), "game_id"))
    return scored.groupBy("model_version_id", S.week_start("game_date").alias("week_start")).agg(*quality_metrics())


def quality_metrics() -> list:
    """Aggregates over (predicted_home_win_prob, predicted_label, actual_label). Probabilities are clipped."""
    actual = F.col("actual_label")
    p = S.clip_probability("predicted_home_win_prob")
    correct = (F.col("predicted_label") == actual).cast("int")
    return [F.count("*").alias("n_predictions"),
            F.avg(correct).alias("accuracy"),
            F.avg(-F.when(actual, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
            F.avg(F.pow(p - actual.cast("double"), 2)).alias("brier_score")]


def monitoring_rows(metrics: DataFrame) -> DataFrame:
    """As the log stores them: four decimal places."""
    return metrics.select("model_version_id", "week_start", "n_predictions",
                          S.at_scale("accuracy", 5, 4).alias("accuracy"),
                          S.at_scale("log_loss", 7, 4).alias("log_loss"),
                          S.at_scale("brier_score", 7, 4).alias("brier_score"))


def updated_log(log: DataFrame, metrics: DataFrame) -> DataFrame:
    """The log with one row per model and week; a repeated week is replaced and its time refreshed."""
    rows = monitoring_rows(metrics).withColumn("logged_at", F.current_timestamp())
    return upsert(log, rows, ["model_version_id", "week_start"])


def weekly_trailing(metrics: DataFrame) -> DataFrame:
    """Each week with the mean accuracy of up to four weeks before it. Groups are as long as a model has weeks."""
    weeks = W.partitionBy("model_version_id").orderBy("week_start")
    return metrics.withColumn("trailing_avg_accuracy",
                              F.avg("accuracy").over(weeks.rowsBetween(-TRAILING_WEEKS, -1)))


def drift_alerts(metrics: DataFrame, threshold: float = ACCURACY_DROP) -> DataFrame:
    """Models whose latest week is more than ``threshold`` below their trailing mean. One week alone never alerts."""
    newest = W.partitionBy("model_version_id").orderBy(F.col("week_start").desc())
    drop = F.col("trailing_avg_accuracy") - F.col("accuracy")
    return (weekly_trailing(metrics).withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
            .select("model_version_id", F.col("accuracy").alias("latest_accuracy"), "trailing_avg_accuracy",
                    drop.alias("drop"))
            .filter(F.col("drop") > threshold))


def accuracy_history(log: DataFrame, versions: DataFrame, model_name: str | None = None) -> DataFrame:
    """Weekly accuracy with model names, of one model or of all."""
    named = log.join(versions.select("model_version_id", "model_name", "version_tag"), "model_version_id")
    if model_name is not None:
        named = named.filter(F.col("model_name") == model_name)
    return (named.select("model_name", "version_tag", "week_start", "n_predictions", "accuracy", "log_loss",
                         "brier_score")
            .orderBy("week_start", "model_name", "version_tag"))
