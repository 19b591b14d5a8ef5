"""Training sets, models, their quality and batch scoring (Spark ML)."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidelines.functions import scalars as S
from sidelines.operators.keyed import absent_from
from sidelines.operators.quality import request_rules, required, with_reason
from sidelines.operators.ranking import prefix_sums
from sidelines.operators.schedule import with_opponent
from sidelines.operators.split import stratified_split

# Fixed lists and parameters.
FORM_FEATURES = ["rolling_win_pct", "rolling_point_diff", "is_home", "opponent_rolling_win_pct"]
REST_FEATURES = FORM_FEATURES + ["days_rest", "is_back_to_back"]
OUTCOME_FEATURES = REST_FEATURES + ["rest_advantage"]
DECLINE_FEATURES = ["rolling_ts_pct", "season_to_date_ts_pct", "rolling_minutes", "rolling_load_index",
                    "days_rest", "is_back_to_back", "age_years"]
DECLINE_THRESHOLD = 0.05
OUTCOME_ROUNDS = 300
DECLINE_ROUNDS = 250
SEED = 42
TEST_SHARE = 0.2
BASELINE_MODEL = "game_outcome_logreg"
BOOSTED_MODEL = "game_outcome_xgb"
DECLINE_MODEL = "player_decline"


# --- training sets -----------------------------------------------------------------------------------------

def outcome_training(team_features: DataFrame) -> DataFrame:
    """Rows with complete form features."""
    return team_features.dropna(subset=[*FORM_FEATURES, "won"])


def with_rest_asymmetry(team_features: DataFrame) -> DataFrame:
    """The opponent's rest beside the team's own."""
    return (with_opponent(team_features, {"days_rest": "opponent_days_rest",
                                          "is_back_to_back": "opponent_is_back_to_back"})
            .withColumn("rest_advantage", S.rest_advantage()))


def rest_training(team_features: DataFrame) -> DataFrame:
    return with_rest_asymmetry(team_features).dropna(subset=[*OUTCOME_FEATURES, "won"])


def decline_training(player_features: DataFrame) -> DataFrame:
    """Label: this contest's TS% is more than 0.05 below the average before it. The features are lagged."""
    gap = F.col("season_to_date_ts_pct") - F.col("ts_pct")
    return (player_features.dropna(subset=["ts_pct", "season_to_date_ts_pct"])
            .withColumn("decline_flag", (gap > DECLINE_THRESHOLD).cast("int"))
            .dropna(subset=DECLINE_FEATURES))


def decline_rate(training: DataFrame) -> DataFrame:
    return training.agg(F.avg("decline_flag").alias("decline_rate"), F.sum("decline_flag").alias("n_declines"),
                        F.count("*").alias("n_rows"))


# --- models ------------------------------------------------------------------------------------------------

def _assembler(features: Sequence[str], output: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output)


def logistic_pipeline(features: Sequence[str], label: str, n_train: int) -> Pipeline:
    """Standardised features; the penalty equals a unit inverse strength on the summed loss."""
    return Pipeline(stages=[
        _assembler(features, "_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=1000, regParam=1.0 / max(n_train, 1),
                           standardization=False)])


def boosted_pipeline(features: Sequence[str], label: str, rounds: int, weight: str | None = None) -> Pipeline:
    trees = GBTClassifier(featuresCol="_features", labelCol=label, maxDepth=4, stepSize=0.05, maxIter=rounds,
                          subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=SEED)
    if weight is not None:
        trees = trees.setWeightCol(weight)
    return Pipeline(stages=[_assembler(features, "_features"), trees])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``probability`` (of class 1), unrounded."""
    return model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias("probability"))


def with_class_weight(train: DataFrame, label: str) -> DataFrame:
    """Positives weigh as much as the negatives together."""
    counts = train.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    return train.withColumn("_weight", F.when(F.col(label) == 1, counts["neg"] / max(counts["pos"], 1)).otherwise(1.0))


def train_outcome_baseline(team_features: DataFrame, training: DataFrame | None = None):
    """Fit on 80 %, measure on 20 %. Returns the model and a one-row metrics table."""
    data = outcome_training(team_features) if training is None else training
    return _fit_and_measure(data, "won", ["game_id", "team_id"], FORM_FEATURES, boosted_rounds=None)


def train_outcome_boosted(team_features: DataFrame, rounds: int = OUTCOME_ROUNDS):
    """Without (v1) and with (v2) the rest features, on the same rows. Returns the v2 model and the comparison."""
    data = rest_training(team_features)
    _, v1 = _fit_and_measure(data, "won", ["game_id", "team_id"], FORM_FEATURES, rounds)
    model, v2 = _fit_and_measure(data, "won", ["game_id", "team_id"], OUTCOME_FEATURES, rounds)
    return model, compare_versions(v1, v2)


def train_decline(player_features: DataFrame, rounds: int = DECLINE_ROUNDS):
    data = decline_training(player_features)
    return _fit_and_measure(data, "decline_flag", ["player_id", "game_id"], DECLINE_FEATURES, rounds, weighted=True)


def _fit_and_measure(data: DataFrame, label: str, keys, features, boosted_rounds: int | None, weighted=False):
    # read many times: to split, to fit and to measure
    data = data.select(*keys, *features, label).persist()
    try:
        split = stratified_split(data, label, keys, TEST_SHARE, SEED)
        train, test = split.filter(~F.col("is_test")), split.filter("is_test")
        if boosted_rounds is None:
            pipeline = logistic_pipeline(features, label, train.count())
        else:
            if weighted:
                train = with_class_weight(train, label)
            pipeline = boosted_pipeline(features, label, boosted_rounds, "_weight" if weighted else None)
        model = pipeline.fit(train)
        measured = binary_metrics(predict(model, test), "probability", label)
        # one row of numbers; taken now, while the rows are cached
        metrics = data.sparkSession.createDataFrame(measured.collect(), measured.schema)
    finally:
        data.unpersist()
    return model, metrics


def compare_versions(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Both metric rows and the lift of the second over the first."""
    rows = v1.withColumn("label", F.lit("v1_form")).unionByName(v2.withColumn("label", F.lit("v2_form_and_rest")))
    base = v1.first()["accuracy"]
    return rows.withColumn("accuracy_lift", F.col("accuracy") - F.lit(base))


def feature_importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(features, importances, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    """The pipeline carries its feature list in its first stage; all models have this one format."""
    model.write().overwrite().save(path)


def is_saved(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def load_model(path: str) -> tuple[PipelineModel, list[str]]:
    model = PipelineModel.load(path)
    return model, model.stages[0].getInputCols()


# --- quality -----------------------------------------------------------------------------------------------

def area_under_roc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """The chance that a positive scores above a negative, ties counting half. NULL without both classes.

    Rows are first combined per distinct score; the running count of negatives is a distributed prefix sum.
    """
    positive = F.col(label).cast("int") == 1
    per_score = (scored.groupBy(F.col(score).alias("_score"))
                 .agg(F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")))
    below = prefix_sums(per_score, ["_score"], ["_neg"])
    pairs = F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2))
    return below.agg(F.try_divide(pairs, F.sum("_pos") * F.sum("_neg").cast("double")).alias("auc"))


def binary_metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: accuracy, log loss, Brier score, precision, recall, F1 (0 when undefined) and AUC."""
    y = F.col(label).cast("int")
    predicted = F.col(score) >= 0.5
    p = S.clip(F.col(score).cast("double"), sys.float_info.epsilon, 1 - sys.float_info.epsilon)
    hit = F.count_if(predicted & (y == 1))
    precision = F.coalesce(F.try_divide(hit, F.count_if(predicted)), F.lit(0.0))
    recall = F.coalesce(F.try_divide(hit, F.count_if(y == 1)), F.lit(0.0))
    rates = scored.agg(
        F.count("*").alias("n_rows"),
        F.avg((predicted == (y == 1)).cast("int")).alias("accuracy"),
        F.avg(-F.when(y == 1, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
        F.avg(F.pow(F.col(score).cast("double") - y, 2)).alias("brier_score"),
        precision.alias("precision"), recall.alias("recall"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return rates.withColumn("f1", f1).withColumn("auc", area_under_roc(scored, score, label).scalar())


# --- scoring -----------------------------------------------------------------------------------------------

def prediction_candidates(team_features: DataFrame, features: Sequence[str] = OUTCOME_FEATURES) -> DataFrame:
    """One row per contest, from the home side, with complete features."""
    return (with_rest_asymmetry(team_features).filter("is_home").dropna(subset=list(features))
            .select("game_id", *features))


def new_predictions(model: PipelineModel, team_features: DataFrame, logged: DataFrame, model_version_id: int,
                    features: Sequence[str] = OUTCOME_FEATURES) -> DataFrame:
    """Predictions of contests that this model version has not predicted yet; the first one is kept for ever."""
    candidates = prediction_candidates(team_features, features).withColumn("model_version_id", F.lit(model_version_id))
    scored = predict(model, absent_from(candidates, logged, ["game_id", "model_version_id"]))
    return scored.select(
        "game_id", F.col("model_version_id").cast("long").alias("model_version_id"),
        S.at_scale("probability", 5, 4).alias("predicted_home_win_prob"),
        (F.col("probability") >= 0.5).alias("predicted_label"),
        F.lit(None).cast("boolean").alias("actual_label"),
        F.current_timestamp().alias("predicted_at"))


def score_route(requests: DataFrame, boosted_available: bool = True) -> DataFrame:
    """Which model scores a row: the boosted one if it exists and the rest days are known, else the baseline."""
    boosted = F.lit(boosted_available) & F.col("days_rest").isNotNull()
    return (requests.withColumn("model_used", F.when(boosted, BOOSTED_MODEL).otherwise(BASELINE_MODEL))
            .withColumn("is_back_to_back", F.coalesce("is_back_to_back", F.lit(0)))
            .withColumn("rest_advantage", F.coalesce(F.col("rest_advantage").cast("double"), F.lit(0.0))))


def score_outcomes(requests: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Every request, scored or with the reason why it is ``refused``: values out of range, or no model for it.

    The label comes from the unrounded probability.
    """
    routed = score_route(with_reason(requests, request_rules()).withColumnRenamed("reason", "refused"), BOOSTED_MODEL in models)
    no_model = F.when(~F.col("model_used").isin(list(models)), F.concat(F.lit("no model "), "model_used"))
    routed = routed.withColumn("refused", F.coalesce("refused", no_model))
    scored = routed.filter(F.col("refused").isNotNull()).withColumn("probability", F.lit(None).cast("double"))
    for name, model in models.items():
        own = routed.filter((F.col("model_used") == name) & F.col("refused").isNull())
        scored = scored.unionByName(predict(model, own))
    return (scored.withColumn("home_win_probability", F.round("probability", 4))
            .withColumn("predicted_home_win", F.col("probability") >= 0.5).drop("probability"))


def score_decline(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Every request, scored, or ``refused`` if a feature is missing."""
    marked = with_reason(requests, [required(*DECLINE_FEATURES)]).withColumnRenamed("reason", "refused")
    scored = (predict(model, marked.filter(F.col("refused").isNull()))
              .unionByName(marked.filter(F.col("refused").isNotNull()).withColumn("probability", F.lit(None).cast("double"))))
    return (scored.withColumn("decline_risk_score", F.round("probability", 4))
            .withColumn("decline_flag", F.col("probability") >= 0.5).drop("probability"))


# --- registry ----------------------------------------------------------------------------------------------

def register_version(versions: DataFrame, model_name: str, version_tag: str) -> tuple[DataFrame, int]:
    """The registry with this (name, tag) in it, and its id. Registering twice changes nothing."""
    known = versions.filter((F.col("model_name") == model_name) & (F.col("version_tag") == version_tag)).first()
    if known is not None:
        return versions, known["model_version_id"]
    new_id = (versions.agg(F.max("model_version_id")).first()[0] or 0) + 1
    row = versions.sparkSession.createDataFrame([(new_id, model_name, version_tag)],
                                                "model_version_id long, model_name string, version_tag string")
    if "trained_at" in versions.columns:
        row = row.withColumn("trained_at", F.current_timestamp())
    return versions.unionByName(row, allowMissingColumns=True), new_id
