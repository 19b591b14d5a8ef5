"""Incremental jobs over several micro-batches equal the batch jobs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sidelines.plans import loaders, monitoring
from sidelines.sources import files
from sidelines.streaming import jobs


def land(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in records))


def box(game, player, points):
    return {"GAME_ID": game, "PLAYER_ID": player, "TEAM_ID": 1, "MIN": "30:00", "PTS": points, "FGM": 1, "FGA": 2}


def test_ingest_equals_batch_and_ignores_redelivery(spark, tmp_path):
    landing = tmp_path / "box"
    tables = loaders.WarehouseTables(spark, str(tmp_path / "stream"))
    land(landing, "a", [box("1", 10, 5), box("1", 11, 6), {"GAME_ID": "1", "PLAYER_ID": None}])
    land(landing, "b", [box("1", 10, 7), box("2", 10, 8)])

    def run(checkpoint="progress"):
        stream = jobs.read_landed_stream(spark, str(landing), files.BOX_FEED, files_per_batch=1)
        jobs.ingest_box_scores(stream, tables, str(tmp_path / checkpoint)).awaitTermination()
        return rows(tables["player_game_stats"].read(), "game_id", "player_id", "points")

    first = run()
    assert [r[:2] for r in first] == [("0000000001", 10), ("0000000001", 11), ("0000000002", 10)]
    assert run() == first
    land(landing, "c", [box("1", 11, 60)])
    assert ("0000000001", 11, 60.0) in run()
    assert len(list((tmp_path / "stream" / "player_game_stats").glob("v0*"))) == 3
    # the same delivery once more leaves the table alone
    assert tables["player_game_stats"].has_delivery(f"{tmp_path / 'progress'}#0")


PREDICTIONS = ("game_id string, model_version_id long, predicted_home_win_prob double, predicted_label boolean, "
               "actual_label boolean, predicted_at timestamp")


def stream_of(spark, folder, schema, batches):
    """Write each batch as a file of its own and read the folder one file at a time."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").json(f"{folder}/{i}")
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(str(folder)))


def test_weekly_quality_equals_batch(spark, tmp_path):
    start = datetime(2024, 1, 1, 12)
    events = [(f"g{i}", 1 + i % 2, (i * 37 % 100) / 100, i * 37 % 100 >= 50, i % 3 == 0, start + timedelta(hours=13 * i))
              for i in range(60)]
    late_first = [events[40:], events[:25], events[25:40]]
    stream = stream_of(spark, tmp_path / "in", PREDICTIONS, late_first)
    jobs.weekly_quality(stream, "predicted_at", str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) == 3
    got = jobs.weekly_metrics_of(spark.read.parquet(str(tmp_path / "out")))
    table = spark.createDataFrame(events, PREDICTIONS)
    games = table.select("game_id", F.col("predicted_at").cast("date").alias("game_date"))
    want = monitoring.weekly_metrics(table, games)
    columns = ["model_version_id", "week_start", "n_predictions", *[F.round(c, 9) for c in ("accuracy", "log_loss", "brier_score")]]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_first_deliveries(spark, tmp_path):
    t = datetime(2024, 1, 1)
    schema = "player_id long, game_id string, points int, arrived timestamp"
    batches = [[(1, "a", 5, t + timedelta(days=400)), (2, "a", 6, t), (2, "a", 60, t + timedelta(hours=2))],
               [(1, "a", 50, t), (1, "b", 7, t - timedelta(days=900))], [(2, "a", 8, t), (3, "c", 9, t)]]
    stream = stream_of(spark, tmp_path / "in", schema, batches)
    out = str(tmp_path / "out")
    jobs.first_deliveries(stream, ["player_id", "game_id"], "arrived", out, str(tmp_path / "progress")).awaitTermination()
    want = [(1, "a", 5), (1, "b", 7), (2, "a", 6), (3, "c", 9)]
    assert rows(spark.read.parquet(out), "player_id", "game_id", "points") == want
    # all batches once more, into the same table: each replaces itself
    jobs.first_deliveries(stream, ["player_id", "game_id"], "arrived", out, str(tmp_path / "again")).awaitTermination()
    assert rows(spark.read.parquet(out), "player_id", "game_id", "points") == want


def test_predictions_meet_late_outcomes(spark, tmp_path):
    t = datetime(2024, 1, 1)
    predictions = stream_of(spark, tmp_path / "p", PREDICTIONS, [
        [("a", 1, 0.6, True, None, t), ("a", 2, 0.4, False, None, t)], [("b", 1, 0.5, True, None, t + timedelta(days=1))]])
    outcomes = stream_of(spark, tmp_path / "o", "game_id string, decided_at timestamp, home_win boolean", [
        [("a", t + timedelta(days=2), True)], [("b", t + timedelta(days=30), True), ("c", t, False)]])
    labelled = jobs.label_predictions(predictions, outcomes, "3 days", "14 DAYS")
    jobs.append_to(labelled, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    # the outcome of b comes after the horizon
    assert rows(spark.read.parquet(str(tmp_path / "out")), "game_id", "model_version_id", "actual_label") == [
        ("a", 1, True), ("a", 2, True)]


def test_outcomes_of_any_lateness_find_their_predictions(spark, tmp_path):
    """In any order, with copies, outcomes that come first or a year later, and once more: always the same table."""
    t = datetime(2024, 1, 1)
    asked = [("a", 1, 0.6, True, None, t), ("a", 2, 0.4, False, None, t), ("b", 1, 0.5, True, None, t + timedelta(days=1)),
             ("c", 1, 0.5, True, False, t), ("d", 1, 0.2, False, None, t), ("a", 1, 0.9, True, None, t + timedelta(hours=1)),
             (None, 1, 0.5, True, None, t), ("e", 1, 0.5, True, None, t + timedelta(days=3))]
    decided = [("a", t + timedelta(days=2), True), ("b", t + timedelta(days=400), True), ("c", t, True), ("x", t, False),
               ("a", t + timedelta(days=5), False), ("e", t, True)]
    want = [("a", 1, 0.6, True), ("a", 2, 0.4, True), ("b", 1, 0.5, True), ("c", 1, 0.5, False), ("d", 1, 0.2, None)]
    outcome = "game_id string, decided_at timestamp, home_win boolean"
    for order, horizon in ((1, None), (-1, None), (1, "14 DAYS")):
        folder = tmp_path / f"{order}{horizon is None}"
        labels = jobs.LateLabels(spark, str(folder), horizon)
        predictions = stream_of(spark, folder / "p", PREDICTIONS, [[r] for r in asked[::order]])
        outcomes = stream_of(spark, folder / "o", outcome, [decided[::order][:2], decided[::order][2:]])
        for progress in ("progress", "again"):
            labels.follow(predictions, outcomes, str(folder / progress)).awaitTermination()
            got = rows(labels.labelled.read(), "game_id", "model_version_id", "predicted_home_win_prob", "actual_label")
            # beyond the horizon is the outcome of b, before the prediction that of e
            assert got == ([*want, ("e", 1, 0.5, True)] if horizon is None else
                           [*want[:2], ("b", 1, 0.5, None), *want[3:], ("e", 1, 0.5, None)])


def test_a_batch_of_first_deliveries_lies_by_hash_of_its_keys(spark, tmp_path):
    t = datetime(2024, 1, 1)
    schema = "player_id long, game_id string, points int, arrived timestamp"
    batches = [[(i, "a", 1, t) for i in range(200)], [(7, "a", 2, t), (500, "a", 2, t)]]
    out = str(tmp_path / "out")
    stream = stream_of(spark, tmp_path / "in", schema, batches)
    jobs.first_deliveries(stream, ["player_id", "game_id"], "arrived", out, str(tmp_path / "progress")).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 201 and stored.filter("points = 2").count() == 1
    assert {p.name.split("=")[0] for p in (tmp_path / "out" / "batch=0").iterdir() if p.is_dir()} == {"hash_of_key"}
    assert len(list((tmp_path / "out" / "batch=1").glob("hash_of_key=*"))) == 1


@pytest.fixture
def view(spark):
    spark.range(20).createOrReplaceTempView("numbers")


def test_sql_files(spark, view, tmp_path, capsys):
    from sidelines.plans import sqlfiles

    text = "-- a header; with a semicolon\nSELECT count(*) AS n FROM numbers;\n  -- more\nSELECT * FROM nowhere;\nSELECT 1 AS one\n"
    results = list(sqlfiles.run_text(spark, text))
    assert [n for n, _, _ in results] == [1, 2, 3]
    assert results[0][1].first()["n"] == 20 and results[1][1] is None and "nowhere" in results[1][2]
    (tmp_path / "01.sql").write_text(text)
    (tmp_path / "02.sql").write_text("SELECT id FROM numbers ORDER BY id")
    sqlfiles.run_files(spark, str(tmp_path))
    out = capsys.readouterr().out
    assert "skipped" in out and "14" in out and "|15" not in out
    sqlfiles.run_files(spark, str(tmp_path), only="02.sql")
    assert "01.sql" not in capsys.readouterr().out
