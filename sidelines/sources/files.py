"""Bulk CSV files and the landed feed."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sidelines.functions import scalars as S
from sidelines.operators.keyed import first_per_key
from sidelines.operators.quality import ZERO_FILLED
from sidelines.schemas import table
from sidelines.session import written

DAMAGED = "_damaged_line"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, names in lower case. Nothing is inferred; the loaders cast what they need."""
    try:
        df = spark.read.option("header", True).option("escape", '"').csv(path)
    except AnalysisException as missing:
        raise FileNotFoundError(f"no bulk file at {path}: put the exported CSV there") from missing
    return lower_names(df)


def read_csv_checked(spark: SparkSession, path: str,
                     shaped: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The file's sound rows, read once and staged, and ``(reason, n_rows)`` of its damaged lines: those with more or
    fewer fields than the header, which is also where an unclosed quote ends. ``shaped`` says what is staged of the rows; it
    keeps the column ``DAMAGED``, and every line is held against the whole header, whatever else it keeps."""
    names = read_csv(spark, path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, DAMAGED)])
    raw = (spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", DAMAGED).option("columnPruning", False).csv(path))
    staged = written(shaped(raw) if shaped else raw, "csv")
    damaged = staged.filter(F.col(DAMAGED).isNotNull()).agg(F.count("*").alias("n_rows")).filter("n_rows > 0")
    return (staged.filter(F.col(DAMAGED).isNull()).drop(DAMAGED),
            damaged.select(F.lit("damaged line").alias("reason"), "n_rows"))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def col_or(df: DataFrame, names: Sequence[str] | str, default=None, type_: str = "string") -> Column:
    """The first of the columns that exists, or the default. Values play no part in the choice."""
    for name in [names] if isinstance(names, str) else names:
        if name in df.columns:
            return F.col(name)
    return F.lit(default).cast(type_)


def with_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join with a lookup."""
    return df.join(lookup, key, "left")


def unmapped_keys(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Keys without an entry in the lookup."""
    return (df.select(key).filter(F.col(key).isNotNull()).distinct()
            .join(lookup.select(key), key, "left_anti"))


# --- the landed feed ---------------------------------------------------------------------------------------

# The columns of the feed and their names in the tables.
HEADER_FEED = table("GAME_DATE DATE, GAME_ID STRING, HOME_TEAM_ID BIGINT, VISITOR_TEAM_ID BIGINT")
LINE_SCORE_FEED = table("GAME_DATE DATE, SEQ BIGINT, TEAM_ID BIGINT, PTS DOUBLE")
BOX_FEED = table(
    "GAME_ID STRING, PLAYER_ID BIGINT, TEAM_ID BIGINT, MIN STRING, PTS DOUBLE, REB DOUBLE, OREB DOUBLE, DREB "
    "DOUBLE, AST DOUBLE, STL DOUBLE, BLK DOUBLE, TO DOUBLE, PF DOUBLE, FGM DOUBLE, FGA DOUBLE, FG3M DOUBLE, "
    "FG3A DOUBLE, FTM DOUBLE, FTA DOUBLE, PLUS_MINUS DOUBLE, START_POSITION STRING")
TRACKING_FEED = table(
    "GAME_ID STRING, PLAYER_ID BIGINT, DIST DOUBLE, AVG_SPEED DOUBLE, TCHS DOUBLE, DRIVES DOUBLE, SAST DOUBLE, "
    "CFGA DOUBLE")
DAY = "day"  # of a landing folder
BIO_FEED = table("PLAYER_ID BIGINT, POSITION STRING, BIRTHDATE STRING, HEIGHT STRING, WEIGHT STRING")

BOX_COLUMNS = {"PTS": "points", "REB": "rebounds", "OREB": "offensive_reb", "DREB": "defensive_reb",
               "AST": "assists", "STL": "steals", "BLK": "blocks", "TO": "turnovers", "PF": "fouls",
               "FGM": "fgm", "FGA": "fga", "FG3M": "fg3m", "FG3A": "fg3a", "FTM": "ftm", "FTA": "fta",
               "PLUS_MINUS": "plus_minus"}
BOX_COUNTS = [name for name, column in BOX_COLUMNS.items() if column not in ZERO_FILLED]  # a load fills the others anyway
TRACKING_COLUMNS = {"DIST": "distance_miles", "AVG_SPEED": "avg_speed_mph", "TCHS": "touches",
                    "DRIVES": "drives", "SAST": "secondary_ast", "CFGA": "contested_shots"}


def read_landing(spark: SparkSession, path: str, schema: T.StructType, counts: Collection[str] = (),
                 days: tuple[date, date] | None = None) -> DataFrame:
    """Landed JSON rows, one per line. ``schema`` names the columns that the feed can deliver.

    The feed lands in folders by the contest's day, ``day=2024-01-05``, of which only those from ``days`` are listed and read;
    files that lie in no such folder are all read.
    """
    lines = spark.read.text(path)
    if days is not None and DAY in lines.columns:
        lines = in_range(lines, DAY, *days)
    return from_lines(lines, schema, counts)


def from_lines(lines: DataFrame, schema: T.StructType, counts: Collection[str] = ()) -> DataFrame:
    """Rows of JSON ``lines(value)``. One of the ``counts`` that a record does not have is 0, one that it has as null is
    null; a line that is no record has nulls only, which the rules of its table reject and report."""
    names, texts = schema.names, [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    rows = lines.select("value", F.from_json("value", schema).alias("row"))
    if not counts:
        return rows.select(*[F.col(f"row.{name}") for name in names])

    # A record has no more keys than colons outside of its texts. If it has as many values, every other column is absent from
    # it, and its keys need not be read in a second pass. Escapes and NaN, which the two passes judge differently, need both.
    n_values = sum((F.col(f"row.{name}").isNotNull().cast("int") for name in names), F.lit(0))
    n_colons = _colons("value") - sum((F.coalesce(_colons(f"row.{name}"), F.lit(0)) for name in texts), F.lit(0))
    odd = F.lit(False)
    for mark in ("\\", "NaN", "INF", "Inf"):
        odd = odd | F.contains("value", F.lit(mark))
    full = F.startswith("value", F.lit("{")) & ~odd & (n_colons == n_values)
    rows = rows.select("value", "row", F.coalesce(full, F.lit(False)).alias("full"))
    rows = rows.select("row", "full", F.when(~F.col("full"), F.json_object_keys("value")).alias("there"))

    def value(name: str) -> Column:
        own = F.col(f"row.{name}")
        absent = F.col("full") | (F.col("there").isNotNull() & ~F.array_contains("there", name))
        return (F.when(own.isNull() & absent, F.lit(0.0)).otherwise(own) if name in counts else own).alias(name)

    return rows.select(*map(value, names))


def _colons(text: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit(":"), F.lit("")))


def canonical_box(df: DataFrame) -> DataFrame:
    """Feed names to table names. A column that the feed does not deliver at all counts as 0."""
    return df.select(
        F.col("PLAYER_ID").alias("player_id"), S.pad_id("GAME_ID").alias("game_id"),
        F.col("TEAM_ID").alias("team_id"),
        S.parse_minutes(col_or(df, "MIN"), live=True).alias("minutes"),
        *[col_or(df, source, 0, "double").alias(target) for source, target in BOX_COLUMNS.items()],
        F.coalesce(F.length(col_or(df, "START_POSITION")) > 0, F.lit(False)).alias("started"))


def canonical_tracking(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("PLAYER_ID").alias("player_id"), S.pad_id("GAME_ID").alias("game_id"),
        *[col_or(df, source, 0, "double").alias(target) for source, target in TRACKING_COLUMNS.items()])


def merge_scoreboard(header: DataFrame, line_score: DataFrame) -> DataFrame:
    """Contests of a day with both scores. A team listed twice on a day has its last row count; no score, pending."""
    last = first_per_key(line_score, ["GAME_DATE", "TEAM_ID"], [F.col("SEQ").desc()], few=True)
    home = last.select("GAME_DATE", F.col("TEAM_ID").alias("HOME_TEAM_ID"), F.col("PTS").alias("_home"))
    away = last.select("GAME_DATE", F.col("TEAM_ID").alias("VISITOR_TEAM_ID"), F.col("PTS").alias("_away"))
    return (header.join(home, ["GAME_DATE", "HOME_TEAM_ID"], "left")
            .join(away, ["GAME_DATE", "VISITOR_TEAM_ID"], "left")
            .select(S.pad_id("GAME_ID").alias("game_id"), F.col("GAME_DATE").alias("game_date"),
                    S.season_of_date("GAME_DATE").alias("season"),
                    F.col("HOME_TEAM_ID").alias("home_team_id"), F.col("VISITOR_TEAM_ID").alias("away_team_id"),
                    F.col("_home").cast("int").alias("home_score"), F.col("_away").cast("int").alias("away_score")))


def date_range(days: int | None = 3, start: date | None = None, end: date | None = None,
               today: date | None = None) -> tuple[date, date]:
    """[today - days, today], or an explicit range given whole. Both ends belong to it."""
    if (start is None) != (end is None):
        raise ValueError("start and end must be given together")
    if start is not None:
        if start > end:
            raise ValueError("start must be on or before end")
        return start, end
    end = today or date.today()
    return end - timedelta(days=days), end


def in_range(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the range."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
