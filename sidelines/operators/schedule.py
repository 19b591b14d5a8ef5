"""Contests seen from each side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SIDE_COLUMNS = ["game_id", "game_date", "season", "team_id", "opponent_id", "team_score", "opponent_score",
                "is_home"]


def completed(games: DataFrame) -> DataFrame:
    """Contests with a result. The predicate reaches the Parquet scan."""
    return games.filter(F.col("home_score").isNotNull())


def team_long(games: DataFrame) -> DataFrame:
    """Two rows per contest, the home side's and the away side's, from one scan. A tie is won by nobody."""
    def side(team, opponent, score, against, is_home):
        return F.struct(F.col(team).alias("team_id"), F.col(opponent).alias("opponent_id"),
                        F.col(score).alias("team_score"), F.col(against).alias("opponent_score"),
                        F.lit(is_home).alias("is_home"))

    sides = F.array(side("home_team_id", "away_team_id", "home_score", "away_score", True),
                    side("away_team_id", "home_team_id", "away_score", "home_score", False))
    return (games.select("game_id", "game_date", "season", F.explode(sides).alias("side"))
            .select("game_id", "game_date", "season", "side.*")
            .withColumn("won", F.col("team_score") > F.col("opponent_score")))


def with_opponent(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the other side's value of each column, under the new name.

    A contest has exactly two rows, so the other side is the next row or the previous one. That is one
    shuffle of one input, where a self-join would shuffle the input twice.
    """
    pair = W.partitionBy("game_id").orderBy(F.col("is_home").desc())
    return df.select("*", *[F.coalesce(F.lead(c).over(pair), F.lag(c).over(pair)).alias(new)
                            for c, new in columns.items()])
