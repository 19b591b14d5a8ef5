"""Every query by name, over the star-schema test tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sidelines.functions import scalars as S
from sidelines.operators import keyed, schedule, split
from sidelines.operators import quality as Q
from sidelines.plans import analytics, dashboard, features, loaders, models, monitoring, sqlfiles
from sidelines.session import new_folder
from sidelines.sources import conferences, deliveries, files, warehouse
from sidelines.sources.star import StarDomain
from sidelines.streaming import jobs

Query = Callable[[StarDomain], DataFrame]

_QUERIES: dict[str, Query] = {}
SLICE = (date(1997, 1, 1), date(1997, 12, 31))


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def run_on(name: str, tables) -> DataFrame:
    """A query over any source of the domain tables, for example a ``Warehouse``."""
    return _QUERIES[name](tables)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Query):
        return lambda spark, sf_dir: build(StarDomain(spark, sf_dir))

    return {name: bound(build) for name, build in _QUERIES.items()}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round the floating-point columns: sums of doubles differ in the last digits between engines."""
    return df.select(*[S.round_half_up(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _team_features(d):
    return features.team_game_features(d.games)


def _player_features(d):
    return features.player_game_features(d.stats, d.games, d.tracking, d.players)


# --- analytic queries --------------------------------------------------------------------------------------

@query
def rolling_team_win_pct(d):
    return analytics.rolling_team_win_pct(d.games, d.teams)


@query
def player_efficiency_decline(d):
    return analytics.player_efficiency_decline(d.stats, d.games, d.players)


@query
def home_away_splits(d):
    return analytics.home_away_splits(d.games, d.teams)


@query
def home_edge(d):
    return analytics.home_edge(d.games, d.teams)


@query
def back_to_back_fatigue(d):
    return analytics.back_to_back_fatigue(d.games, d.stats)


@query
def b2b_summary(d):
    return analytics.back_to_back_summary(_team_features(d), d.stats)


@query
def team_shooting(d):
    return rounded(analytics.team_shooting(d.stats))


@query
def load_next_corr(d):
    return rounded(analytics.load_next_corr(d.stats, d.games, d.tracking))


@query
def load_quartiles(d):
    return analytics.load_quartiles(d.stats, d.games, d.tracking)


@query
def load_quartile_dashboard(d):
    return analytics.load_quartile_dashboard(_player_features(d))


@query
def aging_curve(d):
    return analytics.aging_curve(d.stats, d.games, d.players)


@query
def aging_summary(d):
    return analytics.aging_summary(d.stats, d.games, d.players)


@query
def form_buckets(d):
    return analytics.form_buckets(_team_features(d))


# --- feature tables ----------------------------------------------------------------------------------------

@query
def team_features(d):
    return rounded(_team_features(d))


@query
def player_features(d):
    return rounded(_player_features(d))


@query
def opponent_form(d):
    return rounded(_team_features(d).select("game_id", "team_id", "opponent_id", "opponent_rolling_win_pct"))


# --- dashboard ---------------------------------------------------------------------------------------------

@query
def latest_per_player(d):
    return rounded(dashboard.latest_per_player(_player_features(d)).select("player_id", "game_id", "decline_gap"))


@query
def decline_flags(d):
    return dashboard.decline_flags(_player_features(d))


@query
def risk_landscape(d):
    return rounded(dashboard.risk_landscape(_player_features(d)))


@query
def gap_histogram(d):
    return dashboard.gap_histogram(_player_features(d))


@query
def team_trend(d):
    return rounded(dashboard.team_trend(_team_features(d), d.teams))


@query
def player_trend(d):
    return rounded(dashboard.player_trend(_player_features(d)))


@query
def b2b_count(d):
    return dashboard.back_to_back_count(_team_features(d), d.teams)


@query
def distinct_sorted(d):
    return dashboard.distinct_sorted(d.players, "full_name")


# --- scans, sides, scalars ---------------------------------------------------------------------------------

@query
def completed_scan(d):
    return schedule.completed(d.games).select("game_id", "game_date", "home_team_id", "away_team_id")


@query
def date_range_slice(d):
    return files.in_range(d.games, "game_date", *SLICE).select("game_id", "game_date")


@query
def team_long(d):
    return schedule.team_long(d.games)


@query
def ts_pct(d):
    return rounded(d.stats.select("player_id", "game_id", S.true_shooting().alias("ts_pct")))


@query
def load_index(d):
    rows = d.stats.join(d.tracking, ["player_id", "game_id"], "left")
    return rounded(rows.select("player_id", "game_id", S.load_index().alias("load_index")))


@query
def season_label(d):
    day = F.col("o_orderdate").cast("date")
    return d.table("orders").select("o_orderkey", S.season_of_date(day).alias("season_by_date"),
                                    S.season_of_year(F.year(day)).alias("season_by_year"))


@query
def pad_id(d):
    key = F.col("o_orderkey")
    raw = F.when(key % 3 == 0, key.cast("string")).otherwise(F.concat(key.cast("string"), F.repeat(F.lit("7"), F.lit(9))))
    return d.table("orders").select("o_orderkey", S.pad_id(raw).alias("padded"))


@query
def parse_minutes(d):
    minutes = F.col("l_quantity").cast("int").cast("string")
    seconds = F.lpad((F.col("l_orderkey") % 60).cast("string"), 2, "0")
    form = F.col("l_linenumber")
    raw = (F.when(form == 1, F.concat(minutes, F.lit(":"), seconds)).when(form == 2, minutes)
           .when(form == 3, F.concat(minutes, F.lit(".000000:"), seconds))
           .when(form == 4, F.concat(minutes, F.lit(".5"))).when(form == 5, "DNP"))
    return (d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", raw.alias("raw"))
            .select("l_orderkey", "l_linenumber", "l_partkey", S.parse_minutes("raw").alias("bulk_minutes"),
                    S.parse_minutes("raw", live=True).alias("live_minutes")))


@query
def parse_bio(d):
    return loaders.parsed_bio(deliveries.biographies(d))


@query
def sink_rounding(d):
    return d.predictions.select("game_id", S.at_scale(F.col("predicted_home_win_prob") / 7, 5, 4).alias("prob"),
                                S.at_scale(F.col("predicted_home_win_prob") * 97 / 9, 7, 4).alias("metric"))


# --- validation and keys -----------------------------------------------------------------------------------

_STATS_ORDER = ["source_line", "source_team", "source_quantity", "source_price"]


def _by(*columns):
    return [F.col(c).asc_nulls_last() for c in columns]


@query
def teams_validate(d):
    return Q.validate_teams(d.raw_teams, _by("copy")).select("team_id", "abbreviation", "name")


@query
def players_validate(d):
    order = [F.col("season").asc(), *_by("source_row", "source_line", "team_id", "source_quantity")]
    return Q.validate_players(d.raw_players, order).select("player_id", "full_name", "team_id", "season")


@query
def games_validate(d):
    return Q.validate_games(d.raw_games, _by("copy")).drop("copy")


@query
def stats_validate(d):
    return Q.validate_player_game_stats(d.raw_stats, _by(*_STATS_ORDER)).drop(*_STATS_ORDER)


@query
def tracking_validate(d):
    return rounded(Q.validate_tracking_stats(d.raw_tracking, _by(*_STATS_ORDER)).drop(*_STATS_ORDER))


@query
def dedupe_first(d):
    return (keyed.first_per_key(d.raw_stats, ["player_id", "game_id"], _by(*_STATS_ORDER))
            .select("player_id", "game_id", "source_line", "source_team"))


@query
def reject_report(d):
    numbers = Q.numeric_stats(d.raw_stats)
    reports = {
        "teams": Q.reject_report(d.raw_teams, Q.team_rules()),
        "games": Q.reject_report(d.raw_games, Q.game_rules(d.raw_games)),
        "player_game_stats": Q.reject_report(numbers, Q.stats_rules(numbers)),
        "player_tracking_stats": Q.reject_report(d.raw_tracking, Q.tracking_rules(d.raw_tracking)),
    }
    parts = [report.select(F.lit(name).alias("table_name"), "reason", "n_rows") for name, report in reports.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def implausible_ids(d):
    rows = d.table("lineitem").select(
        F.when(F.col("l_linenumber") == 6, None)
        .when(F.col("l_linenumber") == 3, F.col("l_partkey") * 10_000_000).otherwise(F.col("l_partkey"))
        .alias("player_id"))
    return Q.with_reason(rows, [Q.plausible_player_ids()]).groupBy("player_id", "reason").agg(F.count("*").alias("n_rows"))


@query
def fk_violations(d):
    return keyed.missing_references(d.stats, "game_id", d.games, "game_id").select("player_id", "game_id")


@query
def dup_keys(d):
    return keyed.duplicate_keys(d.raw_stats, ["player_id", "game_id"])


def _requests(d):
    """One scoring request per contest, some out of range or incomplete."""
    key = F.col("game_id").cast("long")
    return d.games.select(
        "game_id", ((key % 120) / 100).alias("rolling_win_pct"), (key % 31 - 15.0).alias("rolling_point_diff"),
        (key % 2 == 0).alias("is_home"), ((key % 101) / 100).alias("opponent_rolling_win_pct"),
        F.when(key % 5 != 0, key % 8).alias("days_rest"), F.when(key % 7 != 0, key % 3).cast("int").alias("is_back_to_back"),
        F.when(key % 11 != 0, key % 9 - 4.0).alias("rest_advantage"))


@query
def domain_violations(d):
    teams = Q.reject_report(d.raw_teams, [Q.conference_rule()])
    requests = Q.reject_report(_requests(d), Q.request_rules())
    return teams.unionByName(requests)


@query
def upsert(d):
    key = F.col("team_id")
    existing = d.teams.filter(key % 10 < 7)
    incoming = d.teams.filter((key % 4 < 2) | (key % 10 >= 7)).select(
        "team_id", "abbreviation", F.concat(F.lit("New "), "name").alias("name"),
        F.when(key % 3 != 0, F.col("division")).alias("division"))
    return keyed.upsert(existing, incoming, ["team_id"])


@query
def insert_if_absent(d):
    key = F.col("game_id").cast("long")
    incoming = d.predictions.withColumn("predicted_home_win_prob", 1 - F.col("predicted_home_win_prob"))
    return rounded(keyed.insert_if_absent(d.predictions.filter(key % 5 < 3), incoming,
                                          ["game_id", "model_version_id"]))


@query
def bio_backlog(d):
    return loaders.bio_backlog(d.players)


@query
def bio_backlog_next(d):
    """The players that the next run of the biography job asks for: the limit is the feature."""
    return loaders.bio_backlog(d.players, 500)


@query
def bio_update(d):
    columns = {c: F.lit(None).cast(t) for c, t in
               [("position", "string"), ("height_inches", "int"), ("weight_lbs", "int")]}
    return loaders.apply_bio(d.players.withColumns(columns), loaders.parsed_bio(deliveries.biographies(d).filter("PLAYER_ID % 3 <> 0")))


# --- loading -----------------------------------------------------------------------------------------------

def _with_abbreviation(d):
    return deliveries.abbreviations(d.table("supplier")), conferences.conference_lookup(d.spark)


@query
def ref_lookup_join(d):
    rows, lookup = _with_abbreviation(d)
    return files.with_lookup(rows, lookup, "abbreviation")


@query
def unmapped_keys(d):
    rows, lookup = _with_abbreviation(d)
    return files.unmapped_keys(rows, lookup, "abbreviation")


@query
def latest_team_per_player(d):
    order = [F.col(c).desc_nulls_first() for c in ("source_row", "source_line", "team_id", "source_quantity")]
    return loaders.latest_team_per_player(d.raw_players, order).select("player_id", "team_id", "season")


@query
def supplement_missing(d):
    key = F.col("player_id")
    known = d.players.filter(key % 4 != 1).select("player_id", "full_name")
    details = d.raw_players.withColumnRenamed("full_name", "player_name")
    order = _by("source_row", "source_line", "team_id", "source_quantity")
    return loaders.with_supplement(known, details, order)


@query
def scoreboard_merge(d):
    header = d.games.select(F.col("game_date").alias("GAME_DATE"), F.col("game_id").cast("long").alias("GAME_ID"),
                            F.col("home_team_id").alias("HOME_TEAM_ID"), F.col("away_team_id").alias("VISITOR_TEAM_ID"))
    lines = (schedule.team_long(schedule.completed(d.games))
             .select(F.col("game_date").alias("GAME_DATE"), F.col("team_id").alias("TEAM_ID"),
                     F.col("team_score").alias("PTS"), F.col("game_id").cast("long").alias("SEQ")))
    return files.merge_scoreboard(header, lines)


def _stored_stats(tables: loaders.WarehouseTables) -> DataFrame:
    return tables["player_game_stats"].read().select(
        "player_id", "game_id", "team_id", F.col("minutes").cast("double").alias("minutes"), "points", "rebounds", "fgm", "fga",
        "ftm", "fta", "plus_minus", "started")


def _bulk_loaded(d, through: str = "player_game_stats") -> loaders.WarehouseTables:
    tables, folder = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse")), new_folder(d.spark, "bulk")
    deliveries.bulk_files(d, folder)
    loaders.load_bulk(d.spark, folder, tables, through=through)
    return tables


@query
def bulk_load_teams(d):
    return _bulk_loaded(d, "teams")["teams"].read()


@query
def bulk_load_players(d):
    return _bulk_loaded(d, "players")["players"].read().select("player_id", "full_name", "team_id")


@query
def bulk_load_games(d):
    return _bulk_loaded(d, "games")["games"].read()


@query
def bulk_load_stats(d):
    return _stored_stats(_bulk_loaded(d))


@query
def bulk_load_report(d):
    return _bulk_loaded(d).load_report().select("table_name", "reason", "n_rows")


@query
def bulk_load_waiting(d):
    """The rows that name a team, player or contest that the files do not have."""
    tables = _bulk_loaded(d)
    waiting = {name: tables[f"{name}{loaders.WAITING}"].read() for name in ("players", "games", "player_game_stats")}
    null = F.lit(None)
    return (waiting["players"].select("player_id", null.cast("string").alias("game_id"))
            .unionByName(waiting["games"].select(null.cast("bigint").alias("player_id"), "game_id"))
            .unionByName(waiting["player_game_stats"].select("player_id", "game_id")))


def _landed_loaded(d) -> loaders.WarehouseTables:
    tables, folder = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse")), new_folder(d.spark, "landing")
    deliveries.landed_files(d, folder)
    loaders.load_landed(d.spark, folder, tables, *files.date_range(start=date(1900, 1, 1), end=date(2100, 1, 1)))
    return tables


@query
def landed_load_games(d):
    return _landed_loaded(d)["games"].read().drop("season_type")


@query
def landed_load_stats(d):
    return _stored_stats(_landed_loaded(d))


@query
def landed_load_tracking(d):
    return _landed_loaded(d)["player_tracking_stats"].read().select(
        "player_id", "game_id", F.col("distance_miles").cast("double").alias("distance_miles"),
        F.col("avg_speed_mph").cast("double").alias("avg_speed_mph"), "touches")


@query
def landed_load_report(d):
    return _landed_loaded(d).load_report().select("table_name", "reason", "n_rows")


@query
def stream_landing(d):
    """The landed files in three batches, in no order: the stored box scores, beside the stored scores of their contests."""
    tables, folder = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse")), new_folder(d.spark, "landing")
    deliveries.landed_files(d, folder)
    n_files = len(d.spark.read.option("recursiveFileLookup", "true").text(folder).inputFiles())
    jobs.ingest_landing(d.spark, folder, tables, new_folder(d.spark, "progress"),
                        files_per_batch=math.ceil(n_files / 3)).awaitTermination()
    games = tables["games"].read().select("game_id", "home_score", "away_score")
    return _stored_stats(tables).join(games, "game_id")


@query
def bio_enrichment(d):
    """The biographies as landed files, taken into the stored players."""
    tables, folder = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse")), new_folder(d.spark, "bio")
    tables["players"].replace(d.players)
    deliveries.biographies(d).filter("PLAYER_ID % 3 <> 0").write.json(folder)
    loaders.enrich_players(d.spark, folder, tables)
    return tables["players"].read().select("player_id", "full_name", "birth_date", "position", "height_inches", "weight_lbs")


@query
def bio_still_missing(d):
    tables, folder = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse")), new_folder(d.spark, "bio")
    tables["players"].replace(d.players)
    deliveries.biographies(d).filter("PLAYER_ID % 3 <> 0").write.json(folder)
    return loaders.enrich_players(d.spark, folder, tables)


# --- sinks -------------------------------------------------------------------------------------------------

@query
def full_replace(d):
    """A derived table that is written, and then replaced by one made from itself."""
    path = f"{new_folder(d.spark, 'derived')}/load_index"
    stored = warehouse.materialize(load_index(d), path)
    return warehouse.materialize(stored.filter("load_index >= 20"), path)


@query
def preview_rows(d):
    """The limit is the feature."""
    return warehouse.preview(dashboard.distinct_sorted(d.players, "full_name"))


@query
def records_output(d):
    folder = new_folder(d.spark, "records")
    warehouse.write_records(d.players, folder)
    return d.spark.read.schema(d.players.schema).json(folder)


@query
def sql_file(d):
    """Two statements of a file, the first of which fails: the second one's result."""
    schedule.completed(d.games).createOrReplaceTempView("sidelines_completed")
    text = """-- rows of a table that is not there; the file goes on
        SELECT * FROM sidelines_not_there;
        /* contests and points; at home */ SELECT home_team_id AS team_id, 'a;b' AS mark, count(*) AS n_games,
            sum(home_score) AS points FROM sidelines_completed GROUP BY home_team_id;"""
    return [result for _, result, _ in sqlfiles.run_text(d.spark, text)][1]


# --- monitoring --------------------------------------------------------------------------------------------

def _labelled(d):
    return monitoring.backfill_labels(d.predictions, d.games)


@query
def backfill_labels(d):
    return _labelled(d)


@query
def weekly_metrics(d):
    return rounded(monitoring.weekly_metrics(_labelled(d), d.games))


@query
def drift_alerts(d):
    """With forty model versions, so that there is something to alert about."""
    many = _labelled(d).withColumn("model_version_id", 1 + F.col("game_id").cast("long") % 40)
    return rounded(monitoring.drift_alerts(monitoring.weekly_metrics(many, d.games)))


@query
def monitoring_accuracy(d):
    log = monitoring.monitoring_rows(monitoring.weekly_metrics(_labelled(d), d.games))
    return monitoring.accuracy_history(log, d.model_versions, models.BOOSTED_MODEL)


@query
def monitoring_log(d):
    """The stored log after a first run that knew a third of the outcomes, and a second one that knew all."""
    tables = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse"))
    log = tables["model_monitoring_log"]
    for labelled in (d.predictions, _labelled(d)):
        log.replace(monitoring.updated_log(log.read(), monitoring.weekly_metrics(labelled, d.games)))
    doubles = [F.col(c).cast("double").alias(c) for c in ("accuracy", "log_loss", "brier_score")]
    return log.read().select("model_version_id", "week_start", "n_predictions", *doubles)


@query
def prediction_log(d):
    """The stored log after two runs, the first of which knows one version only, and the outcomes filled in."""
    log = loaders.WarehouseTables(d.spark, new_folder(d.spark, "warehouse"))["game_predictions"]
    log.insert_if_absent(d.predictions.filter("model_version_id = 1"))
    log.insert_if_absent(d.predictions.withColumn("predicted_home_win_prob", F.col("predicted_home_win_prob") / 2))
    log.upsert(monitoring.newly_labelled(log.read(), d.games))
    return log.read().select("game_id", "model_version_id", "predicted_label", "actual_label",
                             F.col("predicted_home_win_prob").cast("double").alias("predicted_home_win_prob"))


@query
def model_registry(d):
    """The versions that the predictions name; registered again they keep their ids, a new one gets the next."""
    versions = d.model_versions
    for name, tag in ((models.BASELINE_MODEL, "v1"), (models.BOOSTED_MODEL, "v2"), (models.BOOSTED_MODEL, "v3")):
        versions, _ = models.register_version(versions, name, tag)
    return versions


# --- models ------------------------------------------------------------------------------------------------

@query
def outcome_training(d):
    return rounded(models.outcome_training(_team_features(d)).select("game_id", "team_id", *models.FORM_FEATURES, "won"))


@query
def rest_asymmetry(d):
    return rounded(models.rest_training(_team_features(d))
                   .select("game_id", "team_id", "opponent_days_rest", "opponent_is_back_to_back",
                           *models.OUTCOME_FEATURES, "won"))


@query
def decline_label(d):
    return (models.decline_training(_player_features(d)).select("player_id", "game_id", "decline_flag"))


@query
def decline_rate(d):
    return rounded(models.decline_rate(models.decline_training(_player_features(d))))


@query
def prediction_candidates(d):
    return rounded(models.prediction_candidates(_team_features(d)))


@query
def score_route(d):
    return rounded(models.score_route(_requests(d))
                   .select("game_id", "model_used", "is_back_to_back", "rest_advantage"))


@query
def binary_metrics(d):
    labelled = _labelled(d).filter(F.col("actual_label").isNotNull())
    return rounded(models.binary_metrics(labelled, "predicted_home_win_prob", "actual_label"))


@query
def stratified_split(d):
    """How many rows of each label the split of the outcome data sets aside."""
    data = models.outcome_training(_team_features(d)).select("game_id", "team_id", "won")
    return (split.stratified_split(data, "won", ["game_id", "team_id"]).groupBy("won")
            .agg(F.count("*").alias("n_rows"), F.count_if("is_test").alias("n_test")))


@query
def outcome_baseline_metrics(d):
    """Fit the logistic baseline on four fifths of all team rows and measure it on the rest: the rows that were measured,
    and whether every metric is where a fitted model's must be. The metrics themselves are no exact numbers."""
    metrics = models.train_outcome_baseline(_team_features(d))[1]
    shares = F.col("accuracy").between(0.4, 1) & F.col("auc").between(0.4, 1) & F.col("f1").between(0, 1)
    losses = F.col("log_loss").between(0, 0.8) & F.col("brier_score").between(0, 0.3)
    return metrics.select("n_rows", (shares & losses).alias("metrics_in_bounds"))


# --- streaming ---------------------------------------------------------------------------------------------

def _stream(d, name):
    """The table as a stream of its files. The pattern lets the table be one file or a folder of files."""
    return d.spark.readStream.schema(d.table(name).schema).parquet(f"{d.sf_dir}/{name}.parque[t]")


def _in_batches(d, rows: DataFrame, name: str) -> DataFrame:
    """The rows as a stream of nine files in no order of time, two to a batch; of large tables a multiple of both."""
    folder, times = new_folder(d.spark, name), math.ceil(rows.rdd.getNumPartitions() / 4) or 1
    rows.repartition(9 * times, *rows.columns).write.parquet(folder)
    return d.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2 * times).parquet(folder)


def _drained(d, stream: DataFrame, name: str) -> DataFrame:
    """Run the stream over everything present and read what it wrote."""
    folder = new_folder(d.spark, name)
    jobs.append_to(stream, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return d.spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _predictions(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    prob = (key * 7919 % 1000) / F.lit(1000.0)
    return orders.select(
        key.cast("string").alias("game_id"), (1 + key % 2).alias("model_version_id"),
        prob.alias("predicted_home_win_prob"), (prob >= 0.5).alias("predicted_label"),
        (F.col("o_custkey") % 2 == 0).alias("actual_label"), F.col("o_orderdate").cast("timestamp").alias("predicted_at"))


@query
def stream_weekly_quality(d):
    stream, folder = _in_batches(d, _predictions(d.table("orders")), "predictions"), new_folder(d.spark, "weekly-quality")
    jobs.weekly_quality(stream, "predicted_at", f"{folder}/out", f"{folder}/progress").awaitTermination()
    return rounded(jobs.weekly_metrics_of(d.spark.read.parquet(f"{folder}/out")))


@query
def stream_first_deliveries(d):
    rows = d.table("lineitem").select("l_partkey", "l_orderkey", F.col("l_shipdate").cast("timestamp").alias("arrived"))
    stream, folder = _in_batches(d, rows, "deliveries"), new_folder(d.spark, "first-deliveries")
    jobs.first_deliveries(stream, ["l_partkey", "l_orderkey"], "arrived", f"{folder}/out", f"{folder}/progress").awaitTermination()
    return d.spark.read.parquet(f"{folder}/out").select("l_partkey", "l_orderkey")


@query
def stream_label_predictions(d):
    predictions = _predictions(_stream(d, "orders")).withColumn("actual_label", F.lit(None).cast("boolean"))
    key = F.col("o_orderkey")
    outcomes = _stream(d, "orders").filter(F.col("o_orderstatus") != "P").select(
        key.cast("string").alias("game_id"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval((key % 20).cast("int"))).alias("decided_at"),
        (F.col("o_custkey") % 2 == 0).alias("home_win"))
    labelled = jobs.label_predictions(predictions, outcomes, "3 days", "14 DAYS")
    return rounded(_drained(d, labelled.select("game_id", "model_version_id", "predicted_home_win_prob",
                                               "predicted_label", "actual_label"), "labels"))


@query
def stream_late_outcomes(d):
    """Predictions and outcomes in nine files each, in no order: every outcome finds its prediction, within 14 days of it."""
    orders, key = d.table("orders"), F.col("o_orderkey")
    predictions = _predictions(orders).withColumn("actual_label", F.lit(None).cast("boolean"))
    outcomes = orders.filter(F.col("o_orderstatus") != "P").select(
        key.cast("string").alias("game_id"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval((key % 20).cast("int"))).alias("decided_at"),
        (F.col("o_custkey") % 2 == 0).alias("home_win"))
    folder = new_folder(d.spark, "late-outcomes")
    labels = jobs.LateLabels(d.spark, folder, "14 DAYS")
    labels.follow(_in_batches(d, predictions, "asked"), _in_batches(d, outcomes, "decided"), f"{folder}/progress").awaitTermination()
    return rounded(labels.labelled.read().select("game_id", "model_version_id", "predicted_home_win_prob", "predicted_label",
                                                 "actual_label"))
