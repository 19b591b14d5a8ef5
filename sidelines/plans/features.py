"""The two feature tables. Every feature of a row uses earlier rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidelines.functions import scalars as S
from sidelines.operators.history import History, Previous, Rolling, Running
from sidelines.operators.schedule import completed, team_long, with_opponent

TEAM_WINDOW = 10
PLAYER_WINDOW = 5
ORDER = ["game_date", "game_id"]

TEAM_FEATURES = ["game_id", "game_date", "season", "team_id", "opponent_id", "is_home", "won", "rolling_win_pct",
                 "rolling_point_diff", "days_rest", "is_back_to_back", "opponent_rolling_win_pct"]
PLAYER_FEATURES = ["player_id", "full_name", "game_id", "game_date", "season", "team_id", "minutes", "points",
                   "ts_pct", "rolling_ts_pct", "season_to_date_ts_pct", "ts_pct_decline_gap", "rolling_minutes",
                   "load_index", "rolling_load_index", "days_rest", "is_back_to_back", "age_years"]


TEAM_COLUMNS = {
    "rolling_win_pct": Rolling("won", TEAM_WINDOW, current=False),
    "rolling_point_diff": Rolling("_diff", TEAM_WINDOW, current=False),
    "_previous": Previous("game_date"),
}
PLAYER_COLUMNS = {
    "rolling_ts_pct": Rolling("ts_pct", PLAYER_WINDOW, current=False, min_count=2),
    "rolling_minutes": Rolling("minutes", PLAYER_WINDOW, current=False),
    "rolling_load_index": Rolling("load_index", PLAYER_WINDOW, current=False),
    "_previous": Previous("game_date"),
    "_season_mean": Running("ts_pct", current=False, min_count=2, within=("season",)),
}


def team_rows(games: DataFrame) -> DataFrame:
    """A row per team and completed contest."""
    return (team_long(completed(games)).withColumn("won", F.col("won").cast("int"))
            .withColumn("_diff", F.col("team_score") - F.col("opponent_score")))


def team_history(rows: DataFrame) -> History:
    return History(rows, "team_id", ORDER, TEAM_COLUMNS)


def with_rest(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("days_rest", F.datediff("game_date", "_previous"))


def team_form(games: DataFrame) -> DataFrame:
    """Lagged form and rest per team and contest: one shuffle of the staged rows on the team."""
    rows = team_rows(games)
    return with_rest(team_history(rows).over_staged(rows))


def with_opponents(form: DataFrame) -> DataFrame:
    """Both rows of each contest, as features."""
    return (with_opponent(form, {"rolling_win_pct": "opponent_rolling_win_pct"})
            .withColumn("is_back_to_back", S.back_to_back("days_rest")).select(*TEAM_FEATURES))


def team_game_features(games: DataFrame) -> DataFrame:
    return with_opponents(team_form(games))


def player_rows(stats: DataFrame, games: DataFrame, tracking: DataFrame) -> DataFrame:
    """A row per player and contest; contests without a result have no date and no season."""
    return (stats.select("player_id", "game_id", "team_id", F.col("minutes").cast("double").alias("minutes"),
                         "points", S.true_shooting().alias("ts_pct"))
            .join(tracking.select("player_id", "game_id", "distance_miles"), ["player_id", "game_id"], "left")
            .join(completed(games).select("game_id", "game_date", "season"), "game_id", "left")
            .withColumn("load_index", S.load_index()))


def player_history(rows: DataFrame) -> History:
    """A season is a block of a player's history (its label rises with the dates), so that the mean over the season so far
    needs nothing from other blocks."""
    return History(rows, "player_id", ORDER, PLAYER_COLUMNS, block="season")


def with_players(rolled: DataFrame, players: DataFrame) -> DataFrame:
    """The features of rolled rows; players are joined last."""
    return (rolled
            # rows without a season belong to no season
            .withColumn("season_to_date_ts_pct", F.when(F.col("season").isNotNull(), F.col("_season_mean")))
            .withColumn("ts_pct_decline_gap", F.col("rolling_ts_pct") - F.col("season_to_date_ts_pct"))
            .withColumn("days_rest", F.datediff("game_date", "_previous"))
            .withColumn("is_back_to_back", S.back_to_back("days_rest"))
            .join(players.select("player_id", "full_name", "birth_date"), "player_id", "left")
            .withColumn("age_years", S.age_in_years("birth_date", "game_date"))
            .select(*PLAYER_FEATURES))


def player_game_features(stats: DataFrame, games: DataFrame, tracking: DataFrame, players: DataFrame) -> DataFrame:
    """Rows of contests without a result stay, without date and season, and sort last."""
    rows = player_rows(stats, games, tracking)
    return with_players(player_history(rows).over_staged(rows), players)
