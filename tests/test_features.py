"""Feature tables on hand-made contests."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sidelines.plans import analytics
from sidelines.plans.features import player_game_features, team_game_features

GAMES = "game_id string, game_date date, season string, home_team_id long, away_team_id long, home_score int, away_score int"


def games_of(spark, data):
    return spark.createDataFrame(data, GAMES)


def three_games(spark, last_score=110):
    return games_of(spark, [("g1", date(2024, 1, 1), "2023-24", 1, 2, 100, 95),
                            ("g2", date(2024, 1, 3), "2023-24", 2, 1, 90, 92),
                            ("g3", date(2024, 1, 5), "2023-24", 1, 2, last_score, 105)])


def test_two_rows_per_contest_and_no_look_ahead(spark):
    out = team_game_features(three_games(spark))
    assert out.count() == 6
    team = out.filter("team_id = 1").orderBy("game_date").collect()
    assert [r["rolling_win_pct"] for r in team] == [None, 1.0, 1.0]
    assert [r["rolling_point_diff"] for r in team] == [None, 5.0, 3.5]
    assert [r["days_rest"] for r in team] == [None, 2, 2]
    assert [r["opponent_rolling_win_pct"] for r in team] == [None, 0.0, 0.0]


def test_back_to_back(spark):
    games = games_of(spark, [("g1", date(2024, 1, 1), "2023-24", 1, 2, 100, 95),
                             ("g2", date(2024, 1, 2), "2023-24", 1, 3, 90, 92)])
    team = team_game_features(games).filter("team_id = 1").orderBy("game_date").collect()
    assert [r["is_back_to_back"] for r in team] == [0, 1]


def test_a_result_does_not_change_its_own_features(spark):
    def own(df):
        return rows(df.filter("game_id = 'g3'").drop("won"))

    assert own(team_game_features(three_games(spark, 110))) == own(team_game_features(three_games(spark, 1)))


def test_tie_is_won_by_nobody_and_pending_is_left_out(spark):
    games = games_of(spark, [("g1", date(2024, 1, 1), "2023-24", 1, 2, 90, 90),
                             ("g2", date(2024, 1, 2), "2023-24", 1, 2, None, None)])
    out = team_game_features(games)
    assert rows(out, "game_id", "team_id", "won") == [("g1", 1, 0), ("g1", 2, 0)]


def test_player_features(spark):
    games = games_of(spark, [(f"g{i}", date(2024, 1, i), "2023-24" if i < 6 else "2024-25", 1, 2, 10, 9)
                             for i in range(1, 8)] + [("g9", date(2024, 2, 1), "2024-25", 1, 2, None, None)])
    stats = spark.createDataFrame(
        [(7, f"g{i}", 1, 10.0 * i, 2 * i, i if i != 2 else 0, 0) for i in range(1, 8)] + [(7, "g9", 1, 5.0, 1, 1, 0)],
        "player_id long, game_id string, team_id long, minutes double, points int, fga int, fta int")
    tracking = spark.createDataFrame([(7, "g1", 2.0)], "player_id long, game_id string, distance_miles double")
    players = spark.createDataFrame([(7, "Seven", date(2000, 1, 1))], "player_id long, full_name string, birth_date date")
    out = {r["game_id"]: r for r in player_game_features(stats, games, tracking, players).collect()}

    assert out["g1"]["load_index"] == 20.0 and out["g2"]["load_index"] == 20.0
    assert out["g2"]["ts_pct"] is None
    # the row without an attempt takes a place in the frame but does not count towards the minimum
    assert [out[f"g{i}"]["rolling_ts_pct"] for i in (1, 2, 3, 4)] == [None, None, None, 1.0]
    # the season mean starts anew with the season
    assert [out[f"g{i}"]["season_to_date_ts_pct"] for i in (3, 4, 6, 7)] == [None, 1.0, None, None]
    assert out["g4"]["rolling_minutes"] == 20.0
    # the contest without a result sorts last and has no season
    assert out["g9"]["season"] is None and out["g9"]["season_to_date_ts_pct"] is None
    assert out["g9"]["rolling_minutes"] == 50.0
    assert out["g9"]["days_rest"] is None and out["g9"]["is_back_to_back"] == 0
    assert out["g1"]["age_years"] == pytest.approx(8766 / 365.25)


def test_teams_without_home_or_away_contests_disappear(spark):
    games = games_of(spark, [("g1", date(2024, 1, 1), "2023-24", 1, 2, 100, 95),
                             ("g2", date(2024, 1, 2), "2023-24", 2, 1, 100, 95),
                             ("g3", date(2024, 1, 3), "2023-24", 3, 1, 100, 95)])
    teams = spark.createDataFrame([(i, f"T{i}") for i in (1, 2, 3)], "team_id long, abbreviation string")
    out = analytics.home_away_splits(games, teams)
    assert rows(out, "team_id", "home_wins", "away_wins", "home_court_edge") == [(1, 1, 0, 1.0), (2, 1, 0, 1.0)]


def test_rest_of_zero_days_is_in_the_last_bucket(spark):
    games = games_of(spark, [("g1", date(2024, 1, 1), "2023-24", 1, 2, 9, 8),
                             ("g2", date(2024, 1, 1), "2023-24", 1, 3, 9, 8),
                             ("g3", date(2024, 1, 2), "2023-24", 1, 3, 9, 8)])
    stats = spark.createDataFrame([("g2", 1, 1, 2), ("g3", 1, 0, 0)], "game_id string, team_id long, fgm int, fga int")
    out = analytics.back_to_back_fatigue(games, stats)
    # the contest without an attempt counts as a contest but not in the mean
    assert rows(out) == [("3+ days rest", 1, 0.5), ("back_to_back (1 day rest)", 1, None)]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "x double, y double")
    assert df.agg(analytics.correlation("x", "y").alias("r")).first()["r"] is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0)], "x double, y double")
    assert line.agg(analytics.correlation("x", "y").alias("r")).first()["r"] == pytest.approx(1.0)


def test_average_so_far_is_a_career_average(spark):
    games = games_of(spark, [(f"g{i}", date(2024, 1, i), f"20{i}", 1, 2, 9, 8) for i in range(1, 8)])
    players = spark.createDataFrame([(1, "One")], "player_id long, full_name string")
    points = [20, 20, 20, 20, 2, 2, 2]
    stats = spark.createDataFrame([(1, f"g{i + 1}", 30.0, p, 10, 0) for i, p in enumerate(points)],
                                  "player_id long, game_id string, minutes double, points int, fga int, fta int")
    out = analytics.player_efficiency_decline(stats, games, players)
    assert rows(out, "game_id", "rolling_5_ts_pct", "season_to_date_ts_pct") == [
        ("g6", 0.64, 0.7), ("g7", 0.46, 0.614)]
    short = stats.withColumn("minutes", F.lit(9.99))
    assert analytics.player_efficiency_decline(short, games, players).count() == 0
