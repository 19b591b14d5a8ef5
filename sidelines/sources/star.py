"""The domain tables derived from the star schema of the test data (see FIXTURES.md, part 3).

Suppliers stand for teams, parts for players, orders with two or more suppliers for contests, order lines
for player statistics. Everything is a deterministic expression over whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sidelines.functions import scalars as S
from sidelines.operators import keyed


# Contests from this day on have no result yet.
FIRST_PENDING = "2001-06-01"


def _digits(key, width: int):
    text = F.col(key).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


class StarDomain:
    """Lazily built domain tables over one folder of star-schema Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def teams(self) -> DataFrame:
        # nation and region have 25 and 5 rows by definition of the star schema
        places = (self.table("nation").join(F.broadcast(self.table("region")), F.expr("n_regionkey = r_regionkey")))
        return (self.table("supplier")
                .join(F.broadcast(places), F.expr("s_nationkey = n_nationkey"))
                .select(F.col("s_suppkey").alias("team_id"),
                        F.concat(F.lit("T"), _digits("s_suppkey", 4)).alias("abbreviation"),
                        F.col("s_name").alias("name"),
                        F.when(F.col("n_regionkey") % 2 == 0, "East").otherwise("West").alias("conference"),
                        F.col("r_name").alias("division")))

    @cached_property
    def games(self) -> DataFrame:
        # one shuffle, by the contest, serves both groupings
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_quantity").repartition("l_orderkey")
        sides = (lines.groupBy("l_orderkey", "l_suppkey")
                 .agg(F.sum("l_quantity").cast("int").alias("score")))
        pairs = (sides.groupBy("l_orderkey")
                 .agg(F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high"),
                      F.min_by("score", "l_suppkey").alias("low_score"),
                      F.max_by("score", "l_suppkey").alias("high_score"))
                 .filter("low < high"))
        low_at_home = F.col("o_orderkey") % 2 == 0
        played = F.col("o_orderdate") < F.lit(FIRST_PENDING).cast("timestamp")
        game_date = F.col("o_orderdate").cast("date")
        return (self.table("orders").join(pairs, F.expr("o_orderkey = l_orderkey"))
                .select(S.pad_id("o_orderkey").alias("game_id"),
                        game_date.alias("game_date"),
                        S.season_of_date(game_date).alias("season"),
                        F.when(low_at_home, F.col("low")).otherwise(F.col("high")).alias("home_team_id"),
                        F.when(low_at_home, F.col("high")).otherwise(F.col("low")).alias("away_team_id"),
                        F.when(played, F.when(low_at_home, F.col("low_score"))
                               .otherwise(F.col("high_score"))).alias("home_score"),
                        F.when(played, F.when(low_at_home, F.col("high_score"))
                               .otherwise(F.col("low_score"))).alias("away_score"))
                .withColumn("home_win", F.col("home_score") > F.col("away_score")))

    @cached_property
    def players(self) -> DataFrame:
        key = F.col("p_partkey")
        birth = F.date_add(F.lit("1962-01-01").cast("date"), (key * 37 % 6000).cast("int"))
        return self.table("part").select(
            key.alias("player_id"),
            F.concat("p_name", F.lit(" #"), key.cast("string")).alias("full_name"),
            F.when(F.col("p_size") % 10 != 0, birth).alias("birth_date"))

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines, the first per (player, contest). Both tables made from it stay partitioned by that key."""
        lines = self.table("lineitem").select(
            F.col("l_partkey").alias("player_id"), S.pad_id("l_orderkey").alias("game_id"), "l_linenumber",
            "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
        return keyed.first_per_key(
            lines, ["player_id", "game_id"],
            [F.col(c).asc() for c in ("l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")])

    @cached_property
    def stats(self) -> DataFrame:
        fga = F.col("l_quantity").cast("int") % 20
        hundredths = F.round(100 * F.col("l_discount")).cast("int")
        fgm = F.floor(fga * (30 + 5 * hundredths) / 100).cast("int")
        fta = F.col("l_linenumber") % 3
        return self._lines.select(
            "player_id", "game_id", F.col("l_suppkey").alias("team_id"), F.col("l_quantity").alias("minutes"),
            (2 * fgm + fta).alias("points"), fgm.alias("fgm"), fga.alias("fga"),
            fta.alias("ftm"), fta.alias("fta"))

    @cached_property
    def tracking(self) -> DataFrame:
        return (self._lines.filter("l_returnflag = 'A'")
                .select("player_id", "game_id", (F.round(100 * F.col("l_tax")) / 2).alias("distance_miles")))

    @cached_property
    def predictions(self) -> DataFrame:
        """Logged predictions of every contest; one in three already has an actual label."""
        key = F.col("game_id").cast("long")
        prob = (key * 7919 % 1000) / F.lit(1000.0)
        return self.games.select(
            "game_id", (1 + key % 2).alias("model_version_id"),
            prob.alias("predicted_home_win_prob"), (prob >= 0.5).alias("predicted_label"),
            F.when(key % 3 == 0, key % 6 == 0).alias("actual_label"))

    @cached_property
    def model_versions(self) -> DataFrame:
        """The registry: one row per version that the predictions name (two of them)."""
        version = F.col("model_version_id")
        return (self.table("orders").select((1 + F.col("o_orderkey") % 2).alias("model_version_id")).distinct()
                .select(version,
                        F.when(version == 1, "game_outcome_logreg").otherwise("game_outcome_xgb").alias("model_name"),
                        F.concat(F.lit("v"), version.cast("string")).alias("version_tag")))

    # Raw inputs with the faults that the validation rules look for.

    @cached_property
    def raw_teams(self) -> DataFrame:
        key = F.col("s_suppkey")
        copies = F.when(key % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        nation = F.col("n_regionkey")
        return (self.table("supplier").join(F.broadcast(self.table("nation")), F.expr("s_nationkey = n_nationkey"))
                .select(F.when(key % 11 != 10, key).alias("team_id"),
                        F.when(key % 7 != 3, F.concat(F.lit("T"), _digits("s_suppkey", 4))).alias("abbreviation"),
                        F.col("s_name").alias("name"),
                        F.when(nation == 4, "North").when(nation % 2 == 0, "East").when(nation == 1, "West")
                        .alias("conference"),
                        F.explode(copies).alias("copy")))

    @cached_property
    def raw_players(self) -> DataFrame:
        """One row per player and season, as order lines imply them; some without a name."""
        key = F.col("l_partkey")
        season = F.year("l_shipdate")
        return (self.table("lineitem")
                .select(key.alias("player_id"),
                        F.when(key % 13 != 5, F.concat(F.lit("Player "), key.cast("string"))).alias("full_name"),
                        F.when(F.col("l_linenumber") != 4, F.col("l_suppkey")).alias("team_id"),
                        season.alias("season"), F.col("l_orderkey").alias("source_row"),
                        F.col("l_linenumber").alias("source_line"), F.col("l_quantity").alias("source_quantity")))

    @cached_property
    def raw_games(self) -> DataFrame:
        key = F.col("game_id").cast("long")
        return self.games.select(
            F.when(key % 19 != 7, F.col("game_id")).alias("game_id"), "game_date", "season", "home_team_id",
            F.when(key % 11 == 4, F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("away_team_id"),
            F.when(key % 13 == 6, F.lit(-5)).otherwise(F.col("home_score")).alias("home_score"),
            F.when(key % 17 != 9, F.col("away_score")).alias("away_score"),
            F.explode(F.when(key % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))

    @cached_property
    def raw_stats(self) -> DataFrame:
        """Every order line, numbers as text, some of them junk, some with more made than attempted."""
        return self.raw_stats_of(self.table("lineitem"))

    @staticmethod
    def raw_stats_of(lines: DataFrame) -> DataFrame:
        """The same of some order lines: what picks lines moves their few numbers, not the text made from them."""
        line = F.col("l_linenumber")
        quantity = F.col("l_quantity").cast("int")
        return lines.select(
            F.col("l_partkey").alias("player_id"), S.pad_id("l_orderkey").alias("game_id"),
            F.when(quantity != 13, F.col("l_suppkey")).alias("team_id"),
            F.when(quantity == 7, "DNP").otherwise(quantity.cast("string")).alias("minutes"),
            F.when(line == 5, "n/a").otherwise((quantity % 20).cast("string")).alias("points"),
            (quantity % 9).cast("string").alias("fgm"),
            F.when(quantity != 30, ((quantity % 20) + line).cast("string")).alias("fga"),
            (line % 3).cast("string").alias("ftm"), F.lit("2").alias("fta"),
            F.when(line != 6, quantity - 25).alias("plus_minus"),
            line.alias("source_line"), F.col("l_suppkey").alias("source_team"),
            F.col("l_quantity").alias("source_quantity"), F.col("l_extendedprice").alias("source_price"))

    @cached_property
    def raw_tracking(self) -> DataFrame:
        return self.raw_tracking_of(self.table("lineitem"))

    @staticmethod
    def raw_tracking_of(lines: DataFrame) -> DataFrame:
        return lines.select(
            F.col("l_partkey").alias("player_id"), S.pad_id("l_orderkey").alias("game_id"),
            F.when(F.col("l_linenumber") != 7, F.round(100 * F.col("l_tax")) * 1.5).alias("distance_miles"),
            (F.col("l_quantity") / 3).alias("avg_speed_mph"),
            F.col("l_linenumber").alias("source_line"), F.col("l_suppkey").alias("source_team"),
            F.col("l_quantity").alias("source_quantity"), F.col("l_extendedprice").alias("source_price"))
