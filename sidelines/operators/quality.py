"""Row rules: what is kept, what is rejected and why.

The rules of a table are evaluated in one pass, in order; a row's reason is the first rule it fails. The clean
rows and the rejects are filters on that one column, so nothing is counted rule by rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.functions import scalars as S
from sidelines.operators.keyed import first_per_key

MAX_PLAUSIBLE_PLAYER_ID = 9_999_999

# Fixed list: columns of a box score in which anything that is not a number counts as 0.
ZERO_FILLED = ["minutes", "points", "rebounds", "assists", "steals", "blocks", "turnovers", "fouls",
               "fgm", "fga", "fg3m", "fg3a", "ftm", "fta"]
MADE_AND_ATTEMPTED = [("fgm", "fga"), ("fg3m", "fg3a"), ("ftm", "fta")]


@dataclass(frozen=True)
class Rule:
    """``holds`` must be true; NULL counts as a failure."""

    reason: str
    holds: Column


def required(*columns: str) -> Rule:
    holds = F.lit(True)
    for column in columns:
        holds = holds & F.col(column).isNotNull()
    return Rule(f"missing {' or '.join(columns)}", holds)


def with_reason(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reason``: NULL for a good row."""
    failed = [F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.reason)) for rule in rules]
    return df.withColumn("reason", F.coalesce(*failed, F.lit(None).cast("string")))


def clean(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return with_reason(df, rules).filter(F.col("reason").isNull()).drop("reason")


def rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return with_reason(df, rules).filter(F.col("reason").isNotNull())


def reject_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return rejects(df, rules).groupBy("reason").agg(F.count("*").alias("n_rows"))


def load_report(df: DataFrame, rules: Sequence[Rule], kept: DataFrame) -> DataFrame:
    """``(reason, n_rows)`` of all rows that do not become a row of their own: rejects by reason, and repeated keys, which are
    the sound rows less the first ones of their keys, ``kept``. Only counts are shuffled."""
    counts = with_reason(df, rules).groupBy("reason").agg(F.count("*").alias("n_rows"))
    first = kept.agg((-F.count("*")).alias("n_rows")).select(F.lit(None).cast("string").alias("reason"), "n_rows")
    repeated = F.coalesce("reason", F.lit("repeated key")).alias("reason")
    return (counts.unionByName(first).groupBy(repeated).agg(F.sum("n_rows").alias("n_rows"))
            .filter("n_rows > 0"))


def judged_report(judged: DataFrame) -> DataFrame:
    """The same of rows that have their ``reason`` already, and ``copy``, which is 1 for the first sound row of its keys."""
    return (judged.filter("reason is not null or copy > 1").groupBy(F.coalesce("reason", F.lit("repeated key")).alias("reason"))
            .agg(F.count("*").alias("n_rows")))


def plausible_player_ids(column: str = "player_id") -> Rule:
    return Rule("implausible player id", F.col(column) <= MAX_PLAUSIBLE_PLAYER_ID)


def team_rules() -> list[Rule]:
    return [required("team_id", "abbreviation", "name")]


def player_rules() -> list[Rule]:
    return [required("player_id", "full_name")]


def game_rules(df: DataFrame) -> list[Rule]:
    rules = [required("game_id", "game_date", "home_team_id", "away_team_id"),
             Rule("home and away team are the same", F.col("home_team_id") != F.col("away_team_id"))]
    if "home_score" in df.columns:
        pending = F.col("home_score").isNull()
        played = (F.col("home_score") >= 0) & (F.col("away_score") >= 0)
        rules.append(Rule("negative score", pending | F.coalesce(played, F.lit(False))))
    return rules


def stats_rules(df: DataFrame) -> list[Rule]:
    """For rows whose counts are already numbers (see ``numeric_stats``)."""
    return [required("player_id", "game_id", "team_id")] + [
        Rule(f"{made} > {attempted}", F.col(made) <= F.col(attempted))
        for made, attempted in MADE_AND_ATTEMPTED if made in df.columns and attempted in df.columns]


def tracking_rules(df: DataFrame) -> list[Rule]:
    rules = [required("player_id", "game_id")]
    if "distance_miles" in df.columns:
        rules.append(Rule("implausible distance", F.col("distance_miles").between(0, 10)))
    if "avg_speed_mph" in df.columns:
        rules.append(Rule("implausible speed", F.col("avg_speed_mph").between(0, 15)))
    return rules


def conference_rule() -> Rule:
    conference = F.col("conference")
    return Rule("unknown conference", conference.isNull() | conference.isin("East", "West"))


def request_rules() -> list[Rule]:
    """Ranges that a row to be scored must respect."""
    flag = F.col("is_back_to_back")
    return [
        required("rolling_win_pct", "rolling_point_diff", "is_home", "opponent_rolling_win_pct"),
        Rule("rolling_win_pct outside 0..1", F.col("rolling_win_pct").between(0, 1)),
        Rule("opponent_rolling_win_pct outside 0..1", F.col("opponent_rolling_win_pct").between(0, 1)),
        Rule("is_back_to_back outside 0..1", flag.isNull() | flag.between(0, 1)),
    ]


def numeric_stats(df: DataFrame) -> DataFrame:
    """Turn the listed counts that are present into numbers; the other columns stay as they are."""
    return df.withColumns({c: S.numeric_or_zero(c) for c in ZERO_FILLED if c in df.columns})


# The dedupe comes after the rules, so that a bad first copy does not hide a good second one.

def validate_teams(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    good = clean(df, team_rules()).withColumn("team_id", F.col("team_id").cast("long"))
    return first_per_key(good, ["team_id"], order)


def validate_players(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    good = clean(df, player_rules()).withColumn("player_id", F.col("player_id").cast("long"))
    return first_per_key(good, ["player_id"], order)


def validate_games(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return first_per_key(clean(df, game_rules(df)), ["game_id"], order)


def validate_player_game_stats(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    numbers = numeric_stats(df)
    return first_per_key(clean(numbers, stats_rules(numbers)), ["player_id", "game_id"], order)


def validate_tracking_stats(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return first_per_key(clean(df, tracking_rules(df)), ["player_id", "game_id"], order)
