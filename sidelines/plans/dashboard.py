"""The tables behind the dashboard: current decline list, risk landscape, trends and selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sidelines.functions import scalars as S
from sidelines.operators.keyed import first_per_key

FLAG_THRESHOLD = 0.05
HISTOGRAM_BINS = 40


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


def pick(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Rows with one of the values; all rows when no choice is made."""
    return df if values is None else df.filter(F.col(column).isin(list(values)))


def latest_per_player(player_features: DataFrame) -> DataFrame:
    """Each player's last row. A row without a date sorts last, so it counts as the latest.

    ``decline_gap`` is baseline minus recent form here, the opposite sign of the feature table.
    """
    newest = [F.col("game_date").desc_nulls_first(), F.col("game_id").desc()]
    return (first_per_key(player_features, ["player_id"], newest)
            .withColumn("decline_gap", F.col("season_to_date_ts_pct") - F.col("rolling_ts_pct")))


def decline_flags(player_features: DataFrame) -> DataFrame:
    """Players whose recent TS% is more than 0.05 below their season so far, largest gap first."""
    def shown(column):
        return S.round_half_up(column, 3).alias(column)

    return (latest_per_player(player_features).filter(F.col("decline_gap") > FLAG_THRESHOLD)
            .orderBy(F.col("decline_gap").desc_nulls_last(), "player_id")
            .select("player_id", "full_name", shown("rolling_ts_pct"), shown("season_to_date_ts_pct"),
                    shown("decline_gap"), shown("rolling_load_index"), shown("age_years")))


def risk_landscape(player_features: DataFrame) -> DataFrame:
    return (latest_per_player(player_features).dropna(subset=["age_years", "decline_gap", "rolling_load_index"])
            .select("player_id", "full_name", "age_years", "decline_gap", "rolling_load_index"))


def gap_histogram(player_features: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Players per equal-width bin of the decline gap; the largest value belongs to the last bin.

    The gap is taken in whole millionths, so that a value on the edge of a bin falls on the same side of it however its
    digits came about. So there are some millions of distinct gaps at most, and one window over their counts finds the limits.
    """
    counts = (latest_per_player(player_features).select("decline_gap").dropna()
              .select((F.round(F.col("decline_gap").cast("decimal(28,9)"), 6) * 1_000_000).cast("long").alias("gap"))
              .groupBy("gap").agg(F.count("*").alias("n")))
    everything = W.partitionBy()
    limits = counts.withColumns({"low": F.min("gap").over(everything), "high": F.max("gap").over(everything)})
    bin_ = F.when(F.col("low") == F.col("high"), F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide((F.col("gap") - F.col("low")) * bins, F.col("high") - F.col("low"))) + 1, F.lit(bins)))
    return (limits.select(bin_.cast("int").alias("bin"), "n").groupBy("bin")
            .agg(F.sum("n").alias("n_players")).orderBy("bin"))


def player_trend(player_features: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Recent form and season so far of the chosen players, by date."""
    return (pick(player_features, "full_name", names).dropna(subset=["full_name"])
            .select("full_name", "game_date", "player_id", "game_id", "rolling_ts_pct", "season_to_date_ts_pct")
            .orderBy("full_name", "game_date", "player_id", "game_id"))


def with_team_names(team_features: DataFrame, teams: DataFrame) -> DataFrame:
    return team_features.join(teams.select("team_id", "abbreviation", "name"), "team_id", "left")


def team_trend(team_features: DataFrame, teams: DataFrame, abbreviations: Sequence[str] | None = None) -> DataFrame:
    """Form over time of the chosen teams, for one line or a comparison."""
    return (pick(with_team_names(team_features, teams), "abbreviation", abbreviations)
            .select("abbreviation", "game_date", "game_id", "rolling_win_pct", "rolling_point_diff")
            .orderBy("abbreviation", "game_date", "game_id"))


def back_to_back_count(team_features: DataFrame, teams: DataFrame) -> DataFrame:
    """Back-to-back contests per team. It spans all seasons in the table."""
    return (team_features.groupBy("team_id").agg(F.sum("is_back_to_back").alias("n_back_to_back"))
            .join(teams.select("team_id", "abbreviation"), "team_id")
            .select("abbreviation", "n_back_to_back"))
