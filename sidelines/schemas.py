"""Logical schemas of the warehouse tables. Surrogate ids and audit columns are left out: natural keys identify rows."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "STRING": T.StringType(), "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(), "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(),
    "DECIMAL(5,2)": T.DecimalType(5, 2), "DECIMAL(5,4)": T.DecimalType(5, 4), "DECIMAL(7,4)": T.DecimalType(7, 4),
    "MAP<STRING,DOUBLE>": T.MapType(T.StringType(), T.DoubleType()),
}


def table(ddl: str) -> T.StructType:
    """The schema of a column list; unlike Spark's own parser it needs no session."""
    fields = (column.split() for column in ddl.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# The columns of the tables.
TEAMS = table("team_id BIGINT, abbreviation STRING, name STRING, conference STRING, division STRING")
PLAYERS = table(
    "player_id BIGINT, full_name STRING, position STRING, birth_date DATE, height_inches INT, weight_lbs INT, "
    "team_id BIGINT")
GAMES = table(
    "game_id STRING, game_date DATE, season STRING, season_type STRING, home_team_id BIGINT, away_team_id "
    "BIGINT, home_score INT, away_score INT, home_win BOOLEAN")
PLAYER_GAME_STATS = table(
    "player_id BIGINT, game_id STRING, team_id BIGINT, minutes DECIMAL(5,2), points DOUBLE, rebounds DOUBLE, "
    "offensive_reb DOUBLE, defensive_reb DOUBLE, assists DOUBLE, steals DOUBLE, blocks DOUBLE, turnovers "
    "DOUBLE, fouls DOUBLE, fgm DOUBLE, fga DOUBLE, fg3m DOUBLE, fg3a DOUBLE, ftm DOUBLE, fta DOUBLE, plus_minus "
    "DOUBLE, usage_rate DECIMAL(5,2), started BOOLEAN")
PLAYER_TRACKING_STATS = table(
    "player_id BIGINT, game_id STRING, distance_miles DECIMAL(5,2), avg_speed_mph DECIMAL(5,2), touches DOUBLE, "
    "drives DOUBLE, secondary_ast DOUBLE, contested_shots DOUBLE")
INJURY_REPORTS = table("player_id BIGINT, report_date DATE, status STRING, description STRING")
MODEL_VERSIONS = table(
    "model_version_id BIGINT, model_name STRING, version_tag STRING, trained_at TIMESTAMP, metrics "
    "MAP<STRING,DOUBLE>")
GAME_PREDICTIONS = table(
    "game_id STRING, model_version_id BIGINT, predicted_home_win_prob DECIMAL(5,4), predicted_label BOOLEAN, "
    "actual_label BOOLEAN, predicted_at TIMESTAMP")
PLAYER_DECLINE_PREDICTIONS = table(
    "player_id BIGINT, game_id STRING, model_version_id BIGINT, decline_risk_score DECIMAL(5,4), decline_flag "
    "BOOLEAN, predicted_at TIMESTAMP")
MODEL_MONITORING_LOG = table(
    "model_version_id BIGINT, week_start DATE, n_predictions BIGINT, accuracy DECIMAL(5,4), log_loss "
    "DECIMAL(7,4), brier_score DECIMAL(7,4), notes STRING, logged_at TIMESTAMP")

LINE_SCORES = table("game_date DATE, team_id BIGINT, seq BIGINT, points DOUBLE")  # a team's last score of a day, as landed

KEYS = {
    "line_scores": ["game_date", "team_id"],
    "teams": ["team_id"],
    "players": ["player_id"],
    "games": ["game_id"],
    "player_game_stats": ["player_id", "game_id"],
    "player_tracking_stats": ["player_id", "game_id"],
    "injury_reports": ["player_id", "report_date"],
    "model_versions": ["model_name", "version_tag"],
    "game_predictions": ["game_id", "model_version_id"],
    "player_decline_predictions": ["player_id", "game_id", "model_version_id"],
    "model_monitoring_log": ["model_version_id", "week_start"],
}

# Which columns of a table name a row of another, by its key.
REFERENCES = {
    "players": {"team_id": "teams"},
    "games": {"home_team_id": "teams", "away_team_id": "teams"},
    "player_game_stats": {"game_id": "games", "player_id": "players", "team_id": "teams"},
    "player_tracking_stats": {"game_id": "games", "player_id": "players"},
}

# How a large table is divided: by the leading digits of the contest id, which stand for the season, and within these into
# buckets by the contest, so that the size of a part does not depend on how ids are spelt.
_BY_CONTEST = ["games", "player_game_stats", "player_tracking_stats", "game_predictions", "player_decline_predictions"]
PARTS = {**dict.fromkeys(_BY_CONTEST, "substring(game_id, 1, 5)"), "line_scores": "year(game_date)"}
BUCKETS = dict.fromkeys(_BY_CONTEST, 16)

SCHEMAS = {
    "line_scores": LINE_SCORES,
    "teams": TEAMS, "players": PLAYERS, "games": GAMES, "player_game_stats": PLAYER_GAME_STATS,
    "player_tracking_stats": PLAYER_TRACKING_STATS, "injury_reports": INJURY_REPORTS,
    "model_versions": MODEL_VERSIONS, "game_predictions": GAME_PREDICTIONS,
    "player_decline_predictions": PLAYER_DECLINE_PREDICTIONS, "model_monitoring_log": MODEL_MONITORING_LOG,
}
