"""The jobs over one warehouse folder, in the order a nightly run uses them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from sidelines.plans import analytics, dashboard, features, incremental, loaders, models, monitoring
from sidelines.schemas import REFERENCES, SCHEMAS
from sidelines.sources import files
from sidelines.sources.warehouse import materialize
from sidelines.streaming import jobs as streams


class Jobs:
    def __init__(self, spark: SparkSession, root: str, strict: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = loaders.WarehouseTables(spark, f"{self.root}/tables", strict)

    def _derived(self, name: str) -> str:
        return f"{self.root}/derived/{name}"

    def _model(self, name: str) -> str:
        return f"{self.root}/models/{name}"

    def features(self) -> incremental.FeatureTables:
        stored = [self.tables[name].read() for name in ("games", "player_game_stats", "player_tracking_stats", "players")]
        return incremental.FeatureTables(self.spark, f"{self.root}/features", *stored)

    def derived(self, name: str) -> DataFrame:
        if name in (incremental.TEAM_TABLE, incremental.PLAYER_TABLE):
            return self.features().read(name)
        return self.spark.read.parquet(self._derived(name))

    def load_bulk(self, folder: str) -> None:
        loaders.load_bulk(self.spark, folder, self.tables)

    def load_landed(self, landing: str, days: int | None = 3, start: date | None = None, end: date | None = None) -> DataFrame:
        """Returns the ids of the contests that were loaded."""
        return loaders.load_landed(self.spark, landing, self.tables, *files.date_range(days, start, end))

    def follow_landing(self, landing: str) -> None:
        """Take in what has landed since the last time, each file once, and bring the features up to date."""
        streams.ingest_landing(self.spark, landing, self.tables, f"{self.root}/progress/landing", self.update_features).awaitTermination()

    def enrich_players(self, bio: str) -> DataFrame:
        return loaders.enrich_players(self.spark, bio, self.tables)

    def build_features(self, write: bool = True) -> dict[str, DataFrame] | None:
        """Both feature tables, replaced as a whole; nothing happens before the first result is in."""
        tables = self.features()
        if tables.games.filter("home_score is not null").first() is None:
            return None
        if not write:
            return {incremental.TEAM_TABLE: features.team_game_features(tables.games),
                    incremental.PLAYER_TABLE: features.player_game_features(tables.stats, tables.games, tables.tracking, tables.players)}
        tables.rebuild()
        return {name: tables.read(name) for name in (incremental.TEAM_TABLE, incremental.PLAYER_TABLE)}

    def update_features(self, changed_games: DataFrame, changed_players: DataFrame | None = None) -> None:
        """The rows of both feature tables that these contests change."""
        self.features().update(changed_games, changed_players)

    def maintain(self, most_deltas: int = 8) -> None:
        """Merge what evenings have written, and remove files that nobody needs any more."""
        for name in (*SCHEMAS, *[f"{name}{loaders.WAITING}" for name in REFERENCES]):
            self.tables[name].compact(most_deltas)
            self.tables[name].vacuum()
        self.features().compact(most_deltas)

    def build_summaries(self) -> dict[str, DataFrame]:
        stats = self.tables["player_game_stats"].read()
        built = {
            "dashboard_back_to_back_fatigue":
                analytics.back_to_back_summary(self.derived("team_game_features"), stats),
            "dashboard_aging_curve":
                analytics.aging_summary(stats, self.tables["games"].read(), self.tables["players"].read()),
        }
        return {name: materialize(df, self._derived(name)) for name, df in built.items()}

    def train(self, name: str, rounds: int | None = None) -> DataFrame:
        """Fit, save and measure one of the three models."""
        if name == models.BASELINE_MODEL:
            model, metrics = models.train_outcome_baseline(self.derived("team_game_features"))
        elif name == models.BOOSTED_MODEL:
            model, metrics = models.train_outcome_boosted(self.derived("team_game_features"),
                                                          rounds or models.OUTCOME_ROUNDS)
        elif name == models.DECLINE_MODEL:
            model, metrics = models.train_decline(self.derived("player_game_features"), rounds or models.DECLINE_ROUNDS)
        else:
            raise ValueError(f"no model named {name}")
        models.save_model(model, self._model(name))
        return metrics

    def log_predictions(self, name: str = models.BOOSTED_MODEL, version: str = "v1") -> int:
        """Log predictions of the contests that this version has not predicted yet. Returns the version's id."""
        registry = self.tables["model_versions"]
        versions, version_id = models.register_version(registry.read(), name, version)
        registry.upsert(versions)
        model, names = models.load_model(self._model(name))
        log = self.tables["game_predictions"]
        log.insert_if_absent(models.new_predictions(model, self.derived("team_game_features"), log.read(), version_id, names))
        return version_id

    def score_outcomes(self, requests: DataFrame) -> DataFrame:
        """Outcome probabilities of the requests, by the models that have been trained; none is lost."""
        trained = {name: models.load_model(self._model(name))[0] for name in (models.BASELINE_MODEL, models.BOOSTED_MODEL)
                   if models.is_saved(self.spark, self._model(name))}
        return models.score_outcomes(requests, trained)

    def score_decline(self, requests: DataFrame) -> DataFrame:
        return models.score_decline(requests, models.load_model(self._model(models.DECLINE_MODEL))[0])

    def update_monitoring(self) -> DataFrame:
        """Fill in known outcomes, log the weekly quality and return the drift alerts."""
        games, log = self.tables["games"].read(), self.tables["game_predictions"]
        log.upsert(monitoring.newly_labelled(log.read(), games))
        metrics = monitoring.weekly_metrics(log.read(), games)
        weekly = self.tables["model_monitoring_log"]
        weekly.replace(monitoring.updated_log(weekly.read(), metrics))
        return monitoring.drift_alerts(metrics)

    def accuracy_history(self, model_name: str | None = None) -> DataFrame:
        return monitoring.accuracy_history(self.tables["model_monitoring_log"].read(),
                                           self.tables["model_versions"].read(), model_name)

    def decline_flags(self) -> DataFrame:
        return dashboard.decline_flags(self.derived("player_game_features"))

    def dashboard(self) -> dict[str, Callable[[], DataFrame]]:
        """The tables of the dashboard's pages by name, over what is stored; a table is built when it is called."""
        stored = {name: partial(self.derived, name) for name in (incremental.TEAM_TABLE, incremental.PLAYER_TABLE)}
        team, player = stored[incremental.TEAM_TABLE], stored[incremental.PLAYER_TABLE]
        games, teams, stats = [self.tables[name].read() for name in ("games", "teams", "player_game_stats")]
        return {
            "home_edge": lambda: analytics.home_edge(games, teams),
            "team_trend": lambda: dashboard.team_trend(team(), teams),
            "b2b_count": lambda: dashboard.back_to_back_count(team(), teams),
            "b2b_summary": lambda: analytics.back_to_back_summary(team(), stats),
            "form_buckets": lambda: analytics.form_buckets(team()),
            "decline_flags": lambda: dashboard.decline_flags(player()),
            "risk_landscape": lambda: dashboard.risk_landscape(player()),
            "gap_histogram": lambda: dashboard.gap_histogram(player()),
            "load_quartile_dashboard": lambda: analytics.load_quartile_dashboard(player()),
            "player_names": lambda: dashboard.distinct_sorted(player(), "full_name"),
            "player_trend": lambda: dashboard.player_trend(player()),
        }

    def analytic_queries(self) -> dict[str, Callable[[], DataFrame]]:
        """By name; a query is built when it is called."""
        read = {name: self.tables[name].read() for name in ("teams", "players", "games", "player_game_stats",
                                                            "player_tracking_stats")}
        teams, players, games = read["teams"], read["players"], read["games"]
        stats, tracking = read["player_game_stats"], read["player_tracking_stats"]
        return {
            "rolling_team_win_pct": partial(analytics.rolling_team_win_pct, games, teams),
            "player_efficiency_decline": partial(analytics.player_efficiency_decline, stats, games, players),
            "home_away_splits": partial(analytics.home_away_splits, games, teams),
            "back_to_back_fatigue": partial(analytics.back_to_back_fatigue, games, stats),
            "load_next_corr": partial(analytics.load_next_corr, stats, games, tracking),
            "load_quartiles": partial(analytics.load_quartiles, stats, games, tracking),
            "aging_curve": partial(analytics.aging_curve, stats, games, players),
        }

    def nightly(self, landing: str, days: int = 1) -> DataFrame:
        self.update_features(self.load_landed(landing, days))
        return self.update_monitoring()
