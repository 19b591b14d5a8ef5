"""The physical plans that matter at scale."""

import re

import pytest

from sidelines import registry
from sidelines.plans import analytics, features
from sidelines.sources.star import StarDomain
from sidelines.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    names = ("teams", "games", "players", "stats", "tracking")
    return Warehouse.build(StarDomain(spark, "/root/testdata/sf0.001"), str(tmp_path_factory.mktemp("w")), names)


@pytest.fixture
def plan(spark, capsys):
    """The plan of a DataFrame as it would be for tables too large to broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)

    def text(df):
        capsys.readouterr()
        df.explain()
        return re.sub(r"#\d+L?", "", capsys.readouterr().out)

    yield text
    for key, value in before.items():
        spark.conf.set(key, value)


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


def test_one_shuffle_of_the_rows_serves_all_team_windows(warehouse, plan):
    """The rows once, by team and block; beside them only what has been merged before: sums, and the last rows of each block."""
    text = plan(features.team_form(warehouse.games))
    assert text.count("Exchange hashpartitioning(_entity_none, _entity, _block_none, _block") == 3
    assert text.count("WindowGroupLimit [_entity_none, _entity, _block_none, _block], [game_date DESC") == 2  # before and after
    assert text.count("Exchange hashpartitioning(_entity_none, _entity, ") == 4 and text.count("Exchange") == 4
    assert "IsNotNull(home_score)" in scans(text)[0]


def test_a_single_earlier_row_needs_partial_aggregates_only(warehouse, plan):
    text = plan(analytics.days_rest(warehouse.games))
    assert "WindowGroupLimit" not in text and text.count("partial_max_by") == 1


def test_players_are_shuffled_once_for_all_windows(warehouse, plan):
    w = warehouse
    text = plan(features.player_game_features(w.stats, w.games, w.tracking, w.players))
    assert "hashpartitioning(player_id, season" not in text
    assert "fgm" not in "".join(scans(text))


def test_home_and_away_need_one_scan_and_partial_sums(warehouse, plan):
    text = plan(analytics.home_away_splits(warehouse.games, warehouse.teams))
    assert len([s for s in scans(text) if "home_score" in s]) == 1
    assert "partial_avg" in text


def test_names_are_joined_after_the_filter(warehouse, plan):
    w = warehouse
    text = plan(analytics.player_efficiency_decline(w.stats, w.games, w.players))
    assert text.count("Exchange hashpartitioning(player_id, ") == 2  # names, and the rows that are left
    assert any("GreaterThanOrEqual(minutes,10.0)" in s for s in scans(text))


def test_no_query_puts_all_rows_into_one_partition(spark, warehouse, plan):
    w = warehouse
    for df in (analytics.load_quartiles(w.stats, w.games, w.tracking),
               analytics.rolling_team_win_pct(w.games, w.teams)):
        for line in plan(df).splitlines():
            # only totals, never rows, are brought together
            assert "SinglePartition" not in line


def test_no_python_in_the_plans(spark, plan):
    star = StarDomain(spark, "/root/testdata/sf0.001")
    for name in ("parse_minutes", "parse_bio", "stats_validate", "weekly_metrics", "aging_curve"):
        assert "Python" not in plan(registry.run_on(name, star))
