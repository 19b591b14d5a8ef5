"""Feature tables kept up to date equal a full build, bit for bit, and only what changes is written."""

import random
from datetime import date, timedelta

import pytest

from conftest import rows
from sidelines.plans import features
from sidelines.plans.incremental import PLAYER_TABLE, TEAM_TABLE, FeatureTables

GAMES = "game_id string, game_date date, season string, home_team_id long, away_team_id long, home_score int, away_score int"
STATS = "player_id long, game_id string, team_id long, minutes double, points double, fga double, fta double"
TRACKING = "player_id long, game_id string, distance_miles double"
PLAYERS = "player_id long, full_name string, birth_date date"


class World:
    """Contests of eight teams over four seasons; every team has three players, who miss one now and then."""

    def __init__(self, spark, n=160):
        self.spark, self.random = spark, random.Random(5)
        self.games, self.stats, self.tracking = {}, {}, {}
        self.players = {p: (f"P{p}", date(1980, 1, 1) + timedelta(days=97 * p)) for p in range(24)}
        for i in range(n):
            self.play(f"g{i:04d}", date(2018, 1, 3) + timedelta(days=8 * i + self.random.randint(0, 2)))

    def play(self, game_id, day, score=True):
        home, away = self.random.sample(range(8), 2)
        points = (self.random.randint(70, 130), self.random.randint(70, 130)) if score else (None, None)
        year = day.year if day.month >= 8 else day.year - 1
        self.games[game_id] = (day, f"{year}-{(year + 1) % 100:02d}", home, away, *points)
        for team in (home, away):
            for player in range(3 * team, 3 * team + 3):
                if self.random.random() < 0.8:
                    self.stats[player, game_id] = (team, self.random.randint(0, 480) / 10, float(self.random.randint(0, 40)),
                                                   float(self.random.randint(0, 25)), float(self.random.randint(0, 9)))
                    if self.random.random() < 0.7:
                        self.tracking[player, game_id] = self.random.randint(1, 50) / 10

    def tables(self):
        create = self.spark.createDataFrame
        return [create([(g, *v) for g, v in self.games.items()], GAMES), create([(*k, *v) for k, v in self.stats.items()], STATS),
                create([(*k, v) for k, v in self.tracking.items()], TRACKING), create([(p, *v) for p, v in self.players.items()], PLAYERS)]


def full(tables):
    games, stats, tracking, players = tables
    return features.team_game_features(games), features.player_game_features(stats, games, tracking, players)


def check(kept, tables):
    for name, want in zip((TEAM_TABLE, PLAYER_TABLE), full(tables)):
        assert kept.read(name).dtypes == want.dtypes
        assert rows(kept.read(name)) == rows(want), name  # doubles too, to the last bit


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """One warehouse, which the tests below change one after another."""
    world, tmp_path = World(spark), tmp_path_factory.mktemp("features")
    tables = FeatureTables(spark, str(tmp_path), *world.tables())
    tables.rebuild()

    def update(changed, players=None):
        now = world.tables()
        tables = FeatureTables(spark, str(tmp_path), *now)
        tables.update(spark.createDataFrame([(g,) for g in changed], "game_id string"),
                      players and spark.createDataFrame([(p,) for p in players], "player_id long"))
        check(tables, now)
        return tables

    return world, update, tables


def versions(table):
    return max(e["version"] for e in table._entries())


def rows_of(spark, table, since):
    """The rows that later versions than ``since`` wrote."""
    paths = [e["path"] for e in table._entries() if e["version"] > since and e["path"]]
    return spark.read.schema(table.stored).parquet(*paths) if paths else None


def test_a_night_rewrites_only_what_comes_after_it(spark, kept):
    world, update, tables = kept
    before = versions(tables.team.table)
    world.play("g9001", date(2022, 1, 1))
    tables = update(["g9001"])
    new = rows_of(spark, tables.team.table, before)
    assert rows(new.filter("not _gone"), "game_id") == [("g9001",)] * 2  # the last contest of both teams
    # the state of two blocks, and nothing of earlier years
    assert {r["_block"] for r in rows_of(spark, tables.team.state, before).collect()} == {date(2022, 1, 1)}


def test_a_late_contest_rewinds_its_teams_and_players(spark, kept):
    world, update, tables = kept
    before = versions(tables.team.table)
    world.play("g9002", date(2019, 6, 2))
    tables = update(["g9002"])
    home, away = world.games["g9002"][2:4]
    new = rows_of(spark, tables.team.table, before).filter("not _gone").collect()
    assert all(r["game_date"] >= date(2019, 6, 2) for r in new)
    # rows of other teams only where they meet one of the two
    met = {g for g, v in world.games.items() if {home, away} & {v[2], v[3]}}
    assert {r["game_id"] for r in new} <= met and len(new) < 2 * len(world.games)


def test_corrected_moved_pending_and_withdrawn_contests(spark, kept):
    world, update, _ = kept
    day, season, home, away, *_ = world.games["g0100"]
    world.games["g0100"] = (day, season, home, away, 200, 1)
    world.games["g0050"] = (date(2020, 3, 3), "2019-20", *world.games["g0050"][2:])  # played much later
    world.games["g0120"] = (*world.games["g0120"][:4], None, None)  # the result was withdrawn
    day, season, home, away, *score = world.games["g0130"]
    world.games["g0130"] = (day, season, (home + 3) % 8 if (home + 3) % 8 != away else (home + 4) % 8, away, *score)  # another team
    del world.games["g0140"]
    for key in [k for k in world.stats if k[1] == "g0140"]:
        del world.stats[key]
    update(["g0050", "g0100", "g0120", "g0130", "g0140", "unknown"])


def test_pending_contests_get_their_result(spark, kept):
    world, update, _ = kept
    for i in range(4):
        world.play(f"g80{i:02d}", date(2021, 12, 1 + i), score=False)
    tables = update([f"g80{i:02d}" for i in range(4)])
    assert tables.read(TEAM_TABLE).filter("game_id like 'g80%'").count() == 0
    for i in range(4):
        world.games[f"g80{i:02d}"] = (*world.games[f"g80{i:02d}"][:4], 100 + i, 99)
    update([f"g80{i:02d}" for i in range(4)])


def test_a_players_birth_date(spark, kept):
    world, update, _ = kept
    world.players[7] = ("Renamed", date(1979, 12, 31))
    tables = update([], [7])
    assert tables.read(PLAYER_TABLE).filter("player_id = 7").select("full_name").distinct().collect() == [("Renamed",)]
    tables.compact(most_deltas=0)
    check(tables, world.tables())
