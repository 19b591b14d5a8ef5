"""The domain tables of the test data as files in the forms that the loads take, with faults for them to find."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.operators import keyed, schedule
from sidelines.sources import conferences
from sidelines.session import written
from sidelines.sources.star import StarDomain

_SCANS_PER_FILE = 4  # so many partitions of the order lines make three more files of a landed kind
_RAW_ORDER = ["source_line", "source_team", "source_quantity", "source_price"]
_LINE_ORDER = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]  # what these are made from


def abbreviations(suppliers: DataFrame) -> DataFrame:
    """``(s_suppkey, abbreviation)``: a real team's abbreviation each, except that nine of 45 are unknown."""
    names = F.array(*[F.lit(row[0]) for row in sorted(conferences.rows())])
    slot = (F.col("s_suppkey") % 45).cast("int")
    code = F.when(slot < 36, F.get(names, slot)).otherwise(F.concat(F.lit("X"), slot.cast("string")))
    return suppliers.select("s_suppkey", code.alias("abbreviation"))


def _twice_if(condition: Column) -> Column:
    return F.explode(F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")


def bulk_files(d: StarDomain, folder: str) -> None:
    """Teams, players, games and box scores as CSV. Some teams and players are missing that the others name."""
    key, suppliers = F.col("s_suppkey"), d.table("supplier")
    teams = suppliers.join(abbreviations(suppliers), "s_suppkey").filter(key % 23 != 5).select(
        F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit(".0"))).otherwise(key.cast("string")).alias("TEAM_ID"),
        F.when(key % 7 != 3, F.col("abbreviation")).alias("ABBREVIATION"), F.col("s_name").alias("NICKNAME"),
        _twice_if(key % 5 == 0))

    player = F.col("player_id")
    name = F.when(player % 13 != 5, F.concat(F.lit("Player "), player.cast("string"))).alias("PLAYER_NAME")
    # the name follows from the id: least of the numbers alone, rows are hashed, with a text they would all be sorted
    players = (d.raw_players.filter(player % 16 != 1).groupBy("player_id", "season").agg(F.min("team_id").alias("TEAM_ID"))
               .select(name, player.alias("PLAYER_ID"), "TEAM_ID", F.col("season").alias("SEASON")))

    day = F.col("game_date")
    games = d.raw_games.select(
        F.col("game_id").cast("long").alias("GAME_ID"), day.alias("GAME_DATE_EST"),
        (F.year(day) - (F.month(day) < 8).cast("int")).alias("SEASON"), F.col("home_team_id").alias("HOME_TEAM_ID"),
        F.col("away_team_id").alias("VISITOR_TEAM_ID"), F.col("home_score").cast("double").alias("PTS_HOME"),
        F.col("away_score").alias("PTS_AWAY"))

    line = F.col("source_line")
    lines = d.raw_stats_of(keyed.first_per_key(d.table("lineitem"), ["l_partkey", "l_orderkey"],
                                               [F.col(c).asc_nulls_last() for c in _LINE_ORDER]))
    details = lines.select(
        F.col("game_id").cast("long").alias("GAME_ID"), F.when(player % 16 != 1, F.col("team_id")).alias("TEAM_ID"),
        player.alias("PLAYER_ID"), name,
        F.when(line <= 2, "G").alias("START_POSITION"), F.col("minutes").alias("MIN"), F.col("points").alias("PTS"),
        F.col("fgm").alias("FGM"), F.col("fga").alias("FGA"), F.col("ftm").alias("FTM"), F.col("fta").alias("FTA"),
        F.col("plus_minus").alias("PLUS_MINUS"), _twice_if(line == 1))

    for name, rows in {"teams": teams, "players": players, "games": games, "games_details": details}.items():
        rows.drop("copy").write.option("header", True).option("compression", "gzip").csv(f"{folder}/{name}.csv")


def landed_files(d: StarDomain, folder: str) -> None:
    """Headers, scores, box scores and tracking rows as JSON: headers and scores in three files each, or a multiple that grows
    with the order lines, the others in the files that their tasks write. Compressed files can't be split when they are read."""
    games, n_files = written(d.games, "contests"), 3 * (math.ceil(d.table("lineitem").rdd.getNumPartitions() / _SCANS_PER_FILE) or 1)
    header = games.select(F.col("game_date").alias("GAME_DATE"), F.col("game_id").cast("long").alias("GAME_ID"),
                            F.col("home_team_id").alias("HOME_TEAM_ID"), F.col("away_team_id").alias("VISITOR_TEAM_ID"))
    scores = schedule.team_long(schedule.completed(games)).select(
        F.col("game_date").alias("GAME_DATE"), F.col("team_id").alias("TEAM_ID"), F.col("team_score").alias("PTS"),
        F.col("game_id").cast("long").alias("SEQ"))
    contest = F.col("game_id").cast("long")
    seconds = F.lpad((contest % 60).cast("string"), 2, "0")
    box = d.stats.select(
        contest.alias("GAME_ID"), F.col("player_id").alias("PLAYER_ID"), F.col("team_id").alias("TEAM_ID"),
        F.concat(F.col("minutes").cast("int").cast("string"), F.lit(":"), seconds).alias("MIN"), F.col("points").alias("PTS"),
        F.col("fgm").alias("FGM"), F.col("fga").alias("FGA"), F.col("ftm").alias("FTM"), F.col("fta").alias("FTA"),
        F.when(F.col("fta") == 1, "F").otherwise("").alias("START_POSITION"))
    tracking = d.raw_tracking_of(keyed.first_per_key(d.table("lineitem"), ["l_partkey", "l_orderkey"],
                                                     [F.col(c).asc_nulls_last() for c in _LINE_ORDER])).select(
        contest.alias("GAME_ID"), F.col("player_id").alias("PLAYER_ID"), F.col("distance_miles").alias("DIST"),
        F.col("avg_speed_mph").alias("AVG_SPEED"))
    kinds = {"header": header.repartition(n_files), "line_score": scores.repartition(n_files), "box": box, "tracking": tracking}
    for name, rows in kinds.items():
        (rows.write.option("ignoreNullFields", False).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
         .json(f"{folder}/{name}"))


def biographies(d: StarDomain) -> DataFrame:
    """A bio row for every part, some of them malformed."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return d.table("part").select(
        key.alias("PLAYER_ID"), F.concat("p_type", F.lit("-"), "p_name").alias("POSITION"),
        F.when(size % 7 == 0, "unknown").otherwise(
            F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), (key % 9000).cast("int")),
                          "yyyy-MM-dd'T'00:00:00")).alias("BIRTHDATE"),
        F.when(size % 5 == 0, "tall").otherwise(
            F.concat((5 + size % 3).cast("string"), F.lit("-"), (key % 12).cast("string"))).alias("HEIGHT"),
        F.when(size % 4 == 0, "200 lbs").otherwise((150 + key % 150).cast("string")).alias("WEIGHT"))
