"""The jobs one after another over one warehouse."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sidelines import __main__ as cli
from sidelines.jobs import Jobs
from sidelines.plans import models
from sidelines.sources.star import StarDomain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def jobs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    jobs, star = Jobs(spark, root), StarDomain(spark, SF_DIR)
    assert jobs.build_features() is None
    jobs.tables["teams"].upsert(star.teams)
    jobs.tables["players"].upsert(star.players)
    # the season type is left out: an upsert of some columns
    jobs.tables["games"].upsert(star.games)
    jobs.tables["player_game_stats"].upsert(star.stats)
    jobs.tables["player_tracking_stats"].upsert(star.tracking)
    return jobs


def test_from_features_to_drift(spark, jobs):
    star = StarDomain(spark, SF_DIR)
    built = jobs.build_features()
    assert built["team_game_features"].count() == 2 * star.games.filter("home_score is not null").count()
    assert built["player_game_features"].count() == star.stats.count()
    assert jobs.build_summaries()["dashboard_back_to_back_fatigue"].count() == 3

    assert jobs.train(models.BASELINE_MODEL).first()["n_rows"] > 0
    assert jobs.train(models.BOOSTED_MODEL, rounds=2).count() == 2
    version = jobs.log_predictions()
    log = jobs.tables["game_predictions"]
    logged = log.read().count()
    assert logged > 800 and jobs.log_predictions() == version and log.read().count() == logged
    # the baseline needs fewer features, so it can predict more contests
    assert jobs.log_predictions(models.BASELINE_MODEL) == version + 1
    assert log.read().count() >= 2 * logged

    jobs.update_monitoring()
    assert log.read().filter("actual_label is null").count() == 0
    weekly = jobs.accuracy_history()
    assert {r[0] for r in weekly.select("model_name").distinct().collect()} == {models.BASELINE_MODEL, models.BOOSTED_MODEL}
    assert weekly.agg(F.sum("n_predictions")).first()[0] == log.read().count()
    before = rows(weekly)
    jobs.update_monitoring()
    assert rows(jobs.accuracy_history()) == before
    with pytest.raises(ValueError):
        jobs.train("unknown")


def test_the_stored_tables_give_the_same_answers(spark, jobs):
    from sidelines import registry
    for name, build in jobs.analytic_queries().items():
        result = build()
        columns = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in result.dtypes]
        direct = registry.queries()[name](spark, SF_DIR)
        if name == "load_next_corr":
            columns = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in result.dtypes]
        assert rows(result.select(*columns)) == rows(direct), name


def test_the_dashboard_over_the_stored_tables(spark, jobs, tmp_path):
    from sidelines import registry
    cli.main(["--root", jobs.root, "dashboard", str(tmp_path / "out")])
    for name, build in jobs.dashboard().items():
        stored = spark.read.parquet(str(tmp_path / "out" / name))
        assert stored.count() == build().count(), name
        if name not in registry.queries():
            continue
        direct = registry.queries()[name](spark, SF_DIR)
        assert stored.columns == direct.columns and rows(registry.rounded(stored)) == rows(registry.rounded(direct)), name
    one = jobs.dashboard()["player_trend"]().first()["full_name"]
    from sidelines.plans import dashboard
    chosen = dashboard.player_trend(jobs.derived("player_game_features"), [one])
    assert {r[0] for r in chosen.select("full_name").distinct().collect()} == {one}


def test_command_line(jobs, capsys):
    cli.main(["--root", jobs.root, "analytics"])
    out = capsys.readouterr().out
    assert "== aging_curve" in out and "== load_quartiles" in out
    with pytest.raises(SystemExit):
        cli.arguments(["--root", "x", "train", "unknown"])
