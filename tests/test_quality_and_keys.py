from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sidelines.operators import keyed
from sidelines.operators import quality as Q
from sidelines.operators.split import stratified_split


def by(*columns):
    return [F.col(c).asc_nulls_last() for c in columns]


def test_teams(spark):
    df = spark.createDataFrame(
        [(1.0, "A", "Team A", "East", "Atlantic"), (1.0, "A", "Team A", "East", "Atlantic"),
         (None, "B", "Team B", "West", "Pacific"), (3.0, "C", "Team C", "West", "Pacific")],
        "team_id double, abbreviation string, name string, conference string, division string")
    assert rows(Q.validate_teams(df, by("name")), "team_id") == [(1,), (3,)]


def test_a_player_may_have_no_team(spark):
    df = spark.createDataFrame([(1, "Player One", "G", 10.0), (2, "Player Two", "F", None)],
                               "player_id int, full_name string, position string, team_id double")
    assert Q.validate_players(df, by("full_name")).count() == 2


GAMES = "game_id string, game_date date, season string, home_team_id int, away_team_id int, home_score int, away_score int"


def test_games(spark):
    d = date(2024, 1, 1)
    df = spark.createDataFrame([("1", d, "s", 1, 2, 100, 95), ("2", d, "s", 2, 2, 100, 90), ("3", d, "s", 3, 4, -5, 80),
                                ("4", d, "s", 1, 2, None, None), ("5", d, "s", 1, 2, 100, None),
                                (None, d, "s", 1, 2, 1, 2)], GAMES)
    assert rows(Q.validate_games(df, by("game_date")), "game_id") == [("1",), ("4",)]
    report = {r["reason"]: r["n_rows"] for r in Q.reject_report(df, Q.game_rules(df)).collect()}
    assert report == {"home and away team are the same": 1, "negative score": 2,
                      "missing game_id or game_date or home_team_id or away_team_id": 1}


def test_more_made_than_attempted(spark):
    df = spark.createDataFrame(
        [(1, "1", 1, "30", "20", 8, 15, 2, 5, 2, 2), (2, "1", 1, "25", "15", 12, 10, 1, 3, 0, 0),
         (3, "1", 1, "DNP", None, 0, 0, 0, 0, 0, 0)],
        "player_id int, game_id string, team_id int, minutes string, points string, fgm int, fga int, fg3m int, "
        "fg3a int, ftm int, fta int")
    out = Q.validate_player_game_stats(df, by("team_id"))
    assert rows(out, "player_id", "minutes", "points") == [(1, 30.0, 20.0), (3, 0.0, 0.0)]


def test_a_bad_first_copy_does_not_hide_a_good_second_one(spark):
    df = spark.createDataFrame([(1, "g", 1, 5, 3, 1), (1, "g", 1, 2, 3, 2)],
                               "player_id int, game_id string, team_id int, fgm int, fga int, copy int")
    assert rows(Q.validate_player_game_stats(df, by("copy")), "copy") == [(2,)]


def test_plus_minus_stays_null(spark):
    df = spark.createDataFrame([(1, "g", 1, None, None)],
                               "player_id int, game_id string, team_id int, points int, plus_minus int")
    assert rows(Q.validate_player_game_stats(df, by("team_id")), "points", "plus_minus") == [(0.0, None)]


def test_tracking(spark):
    df = spark.createDataFrame([(1, "g", 2.5, 4.0), (2, "g", 10.0, 15.0), (3, "g", 10.1, 4.0), (4, "g", None, 4.0),
                                (5, "g", 1.0, None)],
                               "player_id int, game_id string, distance_miles double, avg_speed_mph double")
    assert rows(Q.validate_tracking_stats(df, by("game_id")), "player_id") == [(1,), (2,)]


def test_implausible_ids(spark):
    df = spark.createDataFrame([(1,), (9_999_999,), (10_000_000,), (None,)], "player_id long")
    assert rows(Q.clean(df, [Q.plausible_player_ids()])) == [(1,), (9_999_999,)]


def test_first_per_key_limits_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    first = keyed.first_per_key(df, ["k"], [F.col("id")])
    assert rows(first) == [(0, 0), (1, 1)]
    first.explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


OLD = "k long, a string, b int, c int"


def test_upsert(spark):
    old = spark.createDataFrame([(1, "x", 1, 1), (2, "y", 2, 2), (3, "z", 3, 3)], OLD)
    new = spark.createDataFrame([(2, None, 20), (4, "w", 40)], "k long, a string, b int")
    merged = keyed.upsert(old, new, ["k"])
    assert merged.columns == ["k", "a", "b", "c"]
    want = [(1, "x", 1, 1), (2, None, 20, 2), (3, "z", 3, 3), (4, "w", 40, None)]
    assert rows(merged) == want
    assert rows(keyed.upsert(merged, new, ["k"])) == want


def test_insert_if_absent_keeps_the_first(spark):
    old = spark.createDataFrame([(1, "x", 1, 1)], OLD)
    new = spark.createDataFrame([(1, "new", 9, 9), (2, "y", 2, 2)], OLD)
    assert rows(keyed.insert_if_absent(old, new, ["k"])) == [(1, "x", 1, 1), (2, "y", 2, 2)]


def test_references_and_duplicates(spark):
    df = spark.createDataFrame([(1, 7), (2, 8), (3, None), (3, 7)], "k int, r int")
    target = spark.createDataFrame([(7,)], "id int")
    assert rows(keyed.missing_references(df, "r", target, "id").select("k", "r")) == [(2, 8)]
    assert rows(keyed.duplicate_keys(df, ["k"])) == [(3, 2)]


@pytest.mark.parametrize("partitions", [1, 9])
def test_split_is_exact_and_independent_of_partitioning(spark, partitions):
    df = spark.range(5003).select("id", F.when(F.col("id") % 10 < 3, 1).otherwise(0).alias("y")).repartition(partitions)
    out = stratified_split(df, "y", ["id"])
    got = {r["y"]: (r["t"], r["n"]) for r in out.groupBy("y").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert got == {0: (700, 3500), 1: (301, 1503)}
    chosen = sorted(r["id"] for r in out.filter("is_test").collect())
    again = sorted(r["id"] for r in stratified_split(df.repartition(3), "y", ["id"]).filter("is_test").collect())
    other = sorted(r["id"] for r in stratified_split(df, "y", ["id"], seed=1).filter("is_test").collect())
    assert chosen == again and chosen != other


def test_split_of_few_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id long, y int")
    out = stratified_split(df, "y", ["id"])
    assert out.count() == 3 and out.filter("is_test").count() == 0
