import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sidelines.functions import scalars as S
from sidelines.plans import loaders
from sidelines.schemas import GAMES, KEYS, PARTS, SCHEMAS
from sidelines.sources import files
from sidelines.sources.snapshots import SnapshotTable
from sidelines.sources.warehouse import materialize, preview


@pytest.fixture
def tables(spark, tmp_path):
    return loaders.WarehouseTables(spark, str(tmp_path / "warehouse"))


def write_json(folder, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir()))}.json").write_text("\n".join(json.dumps(r) for r in records))


@pytest.fixture
def bulk(tmp_path):
    folder = tmp_path / "bulk"
    folder.mkdir()
    (folder / "teams.csv").write_text(
        "TEAM_ID,ABBREVIATION,NICKNAME\n1,BOS,Celtics\n2,SEA,Sonics\n3,XXX,Unknowns\n,LAL,Nobody\n")
    (folder / "players.csv").write_text(
        "PLAYER_NAME,PLAYER_ID,TEAM_ID,SEASON\nAnn,10,1,2018\nAnn,10,2,2019\nBob,11,1,2019\n")
    (folder / "games.csv").write_text(
        "GAME_ID,GAME_DATE_EST,SEASON,HOME_TEAM_ID,VISITOR_TEAM_ID,PTS_HOME,PTS_AWAY\n"
        "21900001,2019-10-22,2019,1,2,101.0,99.0\n21900002,2019-10-23,2019,2,2,90,80\n21900003,2019-10-24,2019,2,1,,\n")
    (folder / "games_details.csv").write_text(
        "GAME_ID,TEAM_ID,PLAYER_ID,PLAYER_NAME,START_POSITION,MIN,PTS,REB,AST,FGM,FGA\n"
        "21900001,1,10,Ann,G,18:06,20,5,4,8,15\n21900001,1,12,Cal,,29.000000:24,3,1,,1,2\n"
        "21900001,2,13,Dee,F,12,30,1,1,12,10\n21900001,2,1962936250,Matt Matt,F,12,30,1,1,1,10\n")
    return str(folder)


def test_bulk_load(spark, bulk, tables):
    loaders.load_bulk(spark, bulk, tables)
    assert rows(tables["teams"].read(), "team_id", "conference", "division") == [
        (1, "East", "Atlantic"), (2, "West", "Northwest"), (3, None, None)]
    # the last season's team; players that only the box scores know; no implausible id
    assert rows(tables["players"].read(), "player_id", "full_name", "team_id") == [
        (10, "Ann", 2), (11, "Bob", 1), (12, "Cal", 1), (13, "Dee", 2)]
    assert rows(tables["games"].read(), "game_id", "season", "home_score", "home_win") == [
        ("0021900001", "2019-20", 101, True), ("0021900003", "2019-20", None, None)]
    stats = tables["player_game_stats"].read()
    assert rows(stats.selectExpr("player_id", "cast(minutes as double)", "assists", "started", "steals")) == [
        (10, 18.1, 4.0, True, 0.0), (12, 29.4, 0.0, False, 0.0)]
    # loading the same files again changes nothing
    before = {name: rows(tables[name].read()) for name in ("teams", "players", "games", "player_game_stats")}
    loaders.load_bulk(spark, bulk, tables)
    assert before == {name: rows(tables[name].read()) for name in before}


def test_rows_in_are_rows_kept_and_rows_reported(spark, bulk, tables):
    with open(f"{bulk}/games_details.csv", "a") as file:
        file.write("21900001,1.0,10.0,Ann,G,18:06,20,5,4,8,15\n21900001,1,14.5,Eve,,1,1,1,1,1,1\n,1,10,Ann,,1,1,1,1,1,1\n")
    run = loaders.load_bulk(spark, bulk, tables)
    report = tables.load_report().filter(f"run = '{run}'")
    lost = {(t, r): n for t, r, n in rows(report, "table_name", "reason", "n_rows")}
    assert lost == {("teams", "no conference for XXX"): 0, ("teams", "missing team_id or abbreviation or name"): 1,
                    ("players", "earlier season"): 1,
                    ("games", "home and away team are the same"): 1, ("player_game_stats", "implausible player id"): 1,
                    ("player_game_stats", "fgm > fga"): 1, ("player_game_stats", "repeated key"): 1,
                    ("player_game_stats", "missing player_id or game_id or team_id"): 2}
    assert tables["player_game_stats"].read().count() + sum(n for (t, _), n in lost.items() if t == "player_game_stats") == 7


def test_whole_numbers_may_carry_a_fraction_of_zeros(spark):
    df = spark.createDataFrame([("1610612740.0",), ("7",), ("7.5",), ("x",), (None,), ("1e3",), (" 8 ",)], "v string")
    assert [r[0] for r in df.select(S.whole("v")).collect()] == [1610612740, 7, None, None, None, 1000, 8]


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="teams.csv"):
        files.read_csv(spark, str(tmp_path / "teams.csv"))


def test_first_existing_column_wins(spark):
    df = spark.createDataFrame([(None, "n")], "nickname string, name string")
    pick = df.select(files.col_or(df, ["nickname", "name"]).alias("a"), files.col_or(df, ["x", "name"]).alias("b"),
                     files.col_or(df, "x", 0, "int").alias("c"))
    assert rows(pick) == [(None, "n", 0)]


def test_bio_survives_a_reload(spark, bulk, tables, tmp_path):
    loaders.load_bulk(spark, bulk, tables)
    write_json(tmp_path / "bio", [
        {"PLAYER_ID": 10, "POSITION": "Guard", "BIRTHDATE": "1990-05-01T00:00:00", "HEIGHT": "6-9", "WEIGHT": "220"},
        {"PLAYER_ID": 11, "POSITION": "Center", "BIRTHDATE": "", "HEIGHT": "tall", "WEIGHT": "n/a"}])
    missing = loaders.enrich_players(spark, str(tmp_path / "bio"), tables)
    assert rows(missing, "player_id") == [(12,), (13,)]
    loaders.load_bulk(spark, bulk, tables)
    bios = tables["players"].read().select("player_id", "position", "birth_date", "height_inches", "weight_lbs")
    assert rows(bios)[:2] == [(10, "Guard", date(1990, 5, 1), 81, 220), (11, "Center", None, None, None)]
    assert rows(loaders.bio_backlog(tables["players"].read(), 2), "player_id") == [(11,), (12,)]


def test_landed_load(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    write_json(landing / "header", [
        {"GAME_DATE": "2024-01-05", "GAME_ID": "22300500", "HOME_TEAM_ID": 1, "VISITOR_TEAM_ID": 2},
        {"GAME_DATE": "2024-01-06", "GAME_ID": "22300501", "HOME_TEAM_ID": 2, "VISITOR_TEAM_ID": 1},
        {"GAME_DATE": "2024-01-09", "GAME_ID": "22300502", "HOME_TEAM_ID": 2, "VISITOR_TEAM_ID": 1}])
    write_json(landing / "line_score", [
        {"GAME_DATE": "2024-01-05", "SEQ": 1, "TEAM_ID": 1, "PTS": 1}, {"GAME_DATE": "2024-01-05", "SEQ": 2, "TEAM_ID": 1, "PTS": 100},
        {"GAME_DATE": "2024-01-05", "SEQ": 3, "TEAM_ID": 2, "PTS": 90}])
    write_json(landing / "box", [
        {"GAME_ID": "22300500", "PLAYER_ID": 10, "TEAM_ID": 1, "MIN": "30:30", "PTS": 12, "FGM": 5, "FGA": 9, "START_POSITION": "G"},
        {"GAME_ID": "22300500", "PLAYER_ID": 11, "TEAM_ID": 1, "MIN": None, "START_POSITION": ""},
        {"GAME_ID": "22300502", "PLAYER_ID": 10, "TEAM_ID": 1, "MIN": "30:30", "PTS": 12}])
    write_json(landing / "tracking", [
        {"GAME_ID": "22300500", "PLAYER_ID": 10, "DIST": 2.5, "AVG_SPEED": 4.1},
        {"GAME_ID": "22300500", "PLAYER_ID": 11, "DIST": 25.0, "AVG_SPEED": 4.1},
        {"GAME_ID": "22300500", "PLAYER_ID": 12, "AVG_SPEED": 4.1}, {"GAME_ID": "22300500", "PLAYER_ID": 13, "DIST": None}])
    start, end = files.date_range(days=1, today=date(2024, 1, 6))
    loaders.load_landed(spark, str(landing), tables, start, end)
    assert rows(tables["games"].read(), "game_id", "season", "home_score", "away_score", "home_win") == [
        ("0022300500", "2023-24", 100, 90, True), ("0022300501", "2023-24", None, None, None)]
    stats = tables["player_game_stats"].read()
    assert rows(stats.selectExpr("player_id", "cast(minutes as double)", "points", "started", "plus_minus")) == [
        (10, 30.5, 12.0, True, 0.0), (11, 0.0, 0.0, False, 0.0)]
    tracking = tables["player_tracking_stats"].read()
    assert rows(tracking.selectExpr("player_id", "cast(distance_miles as double)", "touches")) == [(10, 2.5, 0.0), (12, 0.0, 0.0)]
    assert ("player_tracking_stats", "implausible distance", 2) in rows(tables.load_report(), "table_name", "reason", "n_rows")


def day_of(landing, kind, day, records):
    write_json(landing / kind / f"day={day}", records)


def contest(day, game_id, home=1, away=2):
    return {"GAME_DATE": day, "GAME_ID": game_id, "HOME_TEAM_ID": home, "VISITOR_TEAM_ID": away}


def score(day, team, points, seq=1):
    return {"GAME_DATE": day, "SEQ": seq, "TEAM_ID": team, "PTS": points}


def line(game_id, player, points):
    return {"GAME_ID": game_id, "PLAYER_ID": player, "TEAM_ID": 1, "MIN": "30:30", "PTS": points}


def test_landing_folders_by_day_are_pruned(spark, tables, tmp_path, capsys):
    landing = tmp_path / "landing"
    for i, day in enumerate(("2024-01-05", "2024-01-06", "2024-01-07")):
        day_of(landing, "header", day, [contest(day, f"2230050{i}")])
        day_of(landing, "line_score", day, [score(day, 1, 100 + i), score(day, 2, 90)])
        day_of(landing, "box", day, [line(f"2230050{i}", 10, i)])
        day_of(landing, "tracking", day, [{"GAME_ID": f"2230050{i}", "PLAYER_ID": 10, "DIST": 2.5}])
    days = date(2024, 1, 6), date(2024, 1, 6)
    box = files.read_landing(spark, str(landing / "box"), files.BOX_FEED, days=days)
    box.explain("formatted")
    text = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(day" in text and box.count() == 1
    found = loaders.load_landed(spark, str(landing), tables, *days)
    assert rows(found) == [("0022300501",)] and rows(tables["games"].read(), "game_id", "home_score") == [("0022300501", 101)]
    assert rows(tables["player_game_stats"].read(), "game_id", "points") == [("0022300501", 1.0)]


def test_what_lands_is_read_once_and_in_any_order(spark, tables, tmp_path):
    """Box scores before their contest, scores before and after their header, a late correction."""
    from sidelines.streaming import jobs
    landing, seen = tmp_path / "landing", []

    def run():
        seen.clear()
        jobs.ingest_landing(spark, str(landing), tables, str(tmp_path / "progress"),
                            lambda changed: seen.extend(r[0] for r in changed.collect())).awaitTermination()
        return rows(tables["games"].read(), "game_id", "home_score", "away_score")

    day = "2024-01-05"
    day_of(landing, "box", day, [line("22300500", 10, 12), line("22300501", 10, 9)])
    assert run() == [] and tables["player_game_stats"].read().count() == 0 and seen == []
    assert ("player_game_stats", "waits for its contest", 2) in rows(tables.load_report(), "table_name", "reason", "n_rows")
    day_of(landing, "header", day, [contest(day, "22300500")])
    assert run() == [("0022300500", None, None)] and seen == ["0022300500"]
    # the one whose contest has come is there, the other still waits
    assert rows(tables["player_game_stats"].read(), "game_id", "points") == [("0022300500", 12.0)]
    assert rows(tables[f"player_game_stats{loaders.WAITING}"].read(), "game_id") == [("0022300501",)]
    assert ("player_game_stats", "has waited for its contest and is kept now", 1) in rows(
        tables.load_report(), "table_name", "reason", "n_rows")
    day_of(landing, "line_score", day, [score(day, 1, 100)])
    run()
    day_of(landing, "line_score", day, [score(day, 2, 90), score(day, 1, 101, 5)])
    assert run() == [("0022300500", 101, 90)]
    before = tables["games"]._next(tables["games"]._entries())
    assert run() == [("0022300500", 101, 90)] and seen == []
    assert tables["games"]._next(tables["games"]._entries()) == before  # nothing new, nothing written


def test_orphans_of_a_bulk_load_come_with_a_later_one(spark, bulk, tables):
    with open(f"{bulk}/games_details.csv", "a") as file:
        file.write("21900009,1,10,Ann,G,18:06,20,5,4,8,15\n")
    run = loaders.load_bulk(spark, bulk, tables)
    report = rows(tables.load_report().filter(f"run = '{run}'"), "table_name", "reason", "n_rows")
    assert ("player_game_stats", "waits for its contest", 1) in report
    assert "0021900009" not in {r[0] for r in rows(tables["player_game_stats"].read(), "game_id")}
    with open(f"{bulk}/games.csv", "a") as file:
        file.write("21900009,2019-11-22,2019,1,2,80.0,99.0\n")
    loaders.load_bulk(spark, bulk, tables)
    assert "0021900009" in {r[0] for r in rows(tables["player_game_stats"].read(), "game_id")}
    assert tables[f"player_game_stats{loaders.WAITING}"].read().count() == 0


def test_rows_wait_for_teams_and_players(spark, bulk, tables):
    """A player of an unknown team waits, with them their box score; a contest of an unknown team does, with all its rows."""
    with open(f"{bulk}/players.csv", "a") as file:
        file.write("Eve,14,9,2019\nFay,15,,2019\n")
    with open(f"{bulk}/games.csv", "a") as file:
        file.write("21900005,2019-10-25,2019,1,9,80,90\n")
    with open(f"{bulk}/games_details.csv", "a") as file:
        file.write("21900001,1,14,Eve,G,18:06,2,5,4,8,15\n21900005,1,10,Ann,G,18:06,2,5,4,8,15\n"
                   "21900001,9,11,Bob,G,18:06,2,5,4,8,15\n21900001,2,15,Fay,G,18:06,2,5,4,8,15\n")

    def load():
        run = loaders.load_bulk(spark, bulk, tables)
        return {(t, r): n for t, r, n in rows(tables.load_report().filter(f"run = '{run}' and reason like '%wait%'"),
                                              "table_name", "reason", "n_rows")}

    assert load() == {("players", "waits for its team"): 1, ("games", "waits for its team"): 1,
                      ("player_game_stats", "waits for its player"): 1, ("player_game_stats", "waits for its contest"): 1,
                      ("player_game_stats", "waits for its team"): 1}
    assert {r[0] for r in rows(tables["players"].read(), "player_id")} == {10, 11, 12, 13, 15}
    assert {r[0] for r in rows(tables["games"].read(), "game_id")} == {"0021900001", "0021900003"}
    assert {r for r in rows(tables["player_game_stats"].read(), "player_id", "game_id")} == {
        (10, "0021900001"), (12, "0021900001"), (15, "0021900001")}
    # the team comes; the others come with it, also if their files are not delivered again
    with open(f"{bulk}/teams.csv", "a") as file:
        file.write("9,NYK,Knicks\n")
    for name in ("players", "games", "games_details"):
        with open(f"{bulk}/{name}.csv") as file:
            header = file.readline()
        with open(f"{bulk}/{name}.csv", "w") as file:
            file.write(header)
    assert load() == {("players", "has waited for its team and is kept now"): 1, ("games", "has waited for its team and is kept now"): 1,
                      ("player_game_stats", "has waited for its contest or player or team and is kept now"): 3}
    assert tables["players"].read().count() == 6 and tables["games"].read().count() == 3
    assert tables["player_game_stats"].read().count() == 6
    assert all(tables[f"{name}{loaders.WAITING}"].read().count() == 0 for name in ("players", "games", "player_game_stats"))


def test_a_strict_landing_load_holds_rows_against_teams_and_players(spark, tmp_path):
    tables = loaders.WarehouseTables(spark, str(tmp_path / "warehouse"), strict=True)
    landing, day = tmp_path / "landing", "2024-01-05"
    day_of(landing, "header", day, [contest(day, "22300500")])
    day_of(landing, "line_score", day, [score(day, 1, 100), score(day, 2, 90)])
    day_of(landing, "box", day, [line("22300500", 10, 1)])
    day_of(landing, "tracking", day, [{"GAME_ID": "22300500", "PLAYER_ID": 10, "DIST": 2.5}])
    days = date(2024, 1, 5), date(2024, 1, 5)
    assert rows(loaders.load_landed(spark, str(landing), tables, *days)) == []
    tables["teams"].upsert(spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "team_id long, abbreviation string, name string"))
    assert rows(loaders.load_landed(spark, str(landing), tables, *days)) == [("0022300500",)]
    assert tables["player_game_stats"].read().count() == 0
    tables["players"].upsert(spark.createDataFrame([(10, "Ann")], "player_id long, full_name string"))
    loaders.load_landed(spark, str(landing), tables, *days)
    assert rows(tables["player_game_stats"].read(), "player_id") == rows(tables["player_tracking_stats"].read(), "player_id") == [(10,)]


def test_scores_that_land_before_their_header_are_not_lost(spark, tables, tmp_path):
    from sidelines.streaming import jobs
    landing, day = tmp_path / "landing", "2024-01-05"

    def run():
        jobs.ingest_landing(spark, str(landing), tables, str(tmp_path / "progress")).awaitTermination()
        return rows(tables["games"].read(), "game_id", "home_score", "away_score")

    day_of(landing, "line_score", day, [score(day, 1, 100, 2), score(day, 2, 90, 3), {"SEQ": 4, "PTS": 1}])
    assert run() == []
    assert ("line_scores", "missing GAME_DATE or TEAM_ID", 1) in rows(tables.load_report(), "table_name", "reason", "n_rows")
    day_of(landing, "header", day, [contest(day, "22300500")])
    assert run() == [("0022300500", 100, 90)]
    # an earlier line that comes late changes nothing, a later one does
    day_of(landing, "line_score", day, [score(day, 1, 7, 1), score(day, 2, 95, 5)])
    assert run() == [("0022300500", 100, 95)]


def test_damaged_lines_are_reported(spark, tmp_path):
    path = tmp_path / "teams.csv"
    path.write_text('A,B,C\n1,2,3\n4,5\n6,7,8,9\n"x,1,2\n"a ""quoted"" one","with, comma",3\n,,\n')
    good, damaged = files.read_csv_checked(spark, str(path))
    assert good.columns == ["a", "b", "c"]
    assert rows(good) == [("1", "2", "3"), ('a "quoted" one', "with, comma", "3"), (None, None, None)]
    assert rows(damaged) == [("damaged line", 3)]  # too short, too long, a quote that is never closed
    path.write_text("A,B,C\n1,2,3\n")
    assert rows(files.read_csv_checked(spark, str(path))[1]) == []


def test_a_column_the_feed_lacks_counts_as_zero(spark):
    df = spark.createDataFrame([("1", 2, 3, "10")], "GAME_ID string, PLAYER_ID long, TEAM_ID long, MIN string")
    assert rows(files.canonical_box(df), "plus_minus", "points", "started") == [(0.0, 0.0, False)]


def test_date_range():
    assert files.date_range(3, today=date(2024, 1, 4)) == (date(2024, 1, 1), date(2024, 1, 4))
    assert files.date_range(start=date(2024, 1, 1), end=date(2024, 1, 1)) == (date(2024, 1, 1), date(2024, 1, 1))
    with pytest.raises(ValueError):
        files.date_range(start=date(2024, 1, 2), end=date(2024, 1, 1))
    with pytest.raises(ValueError):
        files.date_range(start=date(2024, 1, 2))


def test_calendar(spark):
    assert rows(files.calendar(spark, date(2024, 2, 28), date(2024, 3, 1))) == [
        (date(2024, 2, 28),), (date(2024, 2, 29),), (date(2024, 3, 1),)]


def game(game_id, score):
    return (game_id, date(2024, 1, 1), "2023-24", "Regular Season", 1, 2, score, 1, True)


def test_an_upsert_rewrites_only_the_parts_it_touches(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "games"), GAMES, KEYS["games"], PARTS["games"])
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([game("0022200001", 5), game("0022300001", 6)], GAMES))
    table.upsert(spark.createDataFrame([game("0022300001", 7), game("0022300002", 8)], GAMES))
    assert rows(table.read(), "game_id", "home_score") == [("0022200001", 5), ("0022300001", 7), ("0022300002", 8)]
    assert [p.name for p in sorted((tmp_path / "games" / "v000002").glob("part*"))] == ["part_of_table=00223"]
    # an incoming row without the optional columns keeps them
    table.upsert(spark.createDataFrame([("0022300001", 70)], "game_id string, home_score int"))
    kept = table.read().filter("game_id = '0022300001'").first()
    assert (kept["home_score"], kept["season"]) == (70, "2023-24")
    table.replace(spark.createDataFrame([game("0022400001", 1)], GAMES))
    assert rows(table.read(), "game_id") == [("0022400001",)]


def test_an_unfinished_version_is_ignored(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "games"), GAMES, KEYS["games"], PARTS["games"])
    table.upsert(spark.createDataFrame([game("0022200001", 5)], GAMES))
    spark.createDataFrame([game("0022200009", 9)], GAMES).write.parquet(str(tmp_path / "games" / "v000002"))
    assert table.read().count() == 1
    table.upsert(spark.createDataFrame([game("0022200002", 6)], GAMES))
    assert table.read().count() == 2


def test_insert_if_absent_table(spark, tmp_path):
    name = "game_predictions"
    table = SnapshotTable(spark, str(tmp_path / name), SCHEMAS[name], KEYS[name], PARTS[name])
    first = spark.createDataFrame([("0022200001", 1, 0.6, True)],
                                  "game_id string, model_version_id long, predicted_home_win_prob double, predicted_label boolean")
    table.insert_if_absent(first)
    again = spark.createDataFrame([("0022200001", 1, 0.1, False), ("0022200001", 2, 0.12345, False)], first.schema)
    table.insert_if_absent(again)
    assert [str(r[0]) for r in table.read().orderBy("model_version_id").select("predicted_home_win_prob").collect()] == [
        "0.6000", "0.1235"]


def test_materialize_and_preview(spark, tmp_path):
    df = spark.range(40)
    assert materialize(df, str(tmp_path / "t")).count() == 40
    assert materialize(df.limit(3), str(tmp_path / "t")).count() == 3
    # made from itself; a job that fails leaves the table as it was, and nothing beside it
    assert materialize(spark.read.parquet(str(tmp_path / "t")).filter("id > 0"), str(tmp_path / "t")).count() == 2
    with pytest.raises(Exception, match="broken"):
        materialize(df.selectExpr("raise_error('broken') as id"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert materialize(df, str(tmp_path / "u"), write=False).count() == 40 and not (tmp_path / "u").exists()
    assert preview(df.orderBy("id")).count() == 15


def test_landed_rows_are_shuffled_once_for_their_contests_and_copies(spark):
    from sidelines.operators import quality as Q
    typed = spark.createDataFrame([(1, "a", 5.0), (1, "a", 5.0), (1, "a", 50.0), (2, "a", 1.0), (None, "a", 1.0), (3, "x", 1.0), (4, None, 1.0)],
                                  "player_id long, game_id string, distance_miles double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = loaders._judged_by_contest(typed, spark.createDataFrame([("a",), ("b",)], "game_id string"), Q.tracking_rules(typed),
                                            KEYS["player_tracking_stats"])
        assert judged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # rows, contests
        assert rows(judged.filter("reason is null and copy = 1"), "player_id", "game_id", "distance_miles") == [(1, "a", 5.0), (2, "a", 1.0)]
        assert rows(Q.judged_report(judged)) == [("implausible distance", 1), ("missing player_id or game_id", 1), ("repeated key", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rows_that_never_waited_are_not_taken_out_of_the_waiting(spark, bulk, tables):
    loaders.load_bulk(spark, bulk, tables, through="games")
    assert {e["version"] for e in tables["games_waiting"]._entries()} == {1}


def test_rows_with_references_are_staged_once_more_after_their_file(spark, bulk, tables, monkeypatch):
    names, stage = [], loaders.written
    monkeypatch.setattr(loaders, "written", lambda df, name: names.append(name) or stage(df, name))
    loaders.load_bulk(spark, bulk, tables)
    for table in ("games", "player_game_stats"):
        assert [name for name in names if name.endswith(f"-{table}")] == [f"sound-{table}"]


def test_contests_and_copies_share_a_shuffle(spark, bulk, tables, monkeypatch):
    """Without a broadcast the rows of box scores move once by their contest, and not by player and contest besides."""
    plans, stage = {}, loaders.written

    def staged(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(loaders, "written", staged)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loaders.load_bulk(spark, bulk, tables)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plans["sound-player_game_stats"].splitlines() if "Exchange hashpartitioning(" in line]
    by = [line.split("hashpartitioning(")[1].split("#")[0] for line in shuffles]
    assert by.count("game_id") == 1 and not any("player_id#" in line and "game_id#" in line.split("),")[0] for line in shuffles)
    assert tables["player_game_stats"].read().count() == 2


def test_a_load_up_to_the_contests_stages_the_players_of_box_scores_only(spark, bulk, tables, monkeypatch):
    with open(f"{bulk}/games_details.csv", "a") as file:
        file.write("21900001,1,10,Short\n21900001,1,10,Ann,G,18:06,20,5,4,8,15,too long\n")
    columns, stage = [], files.written
    monkeypatch.setattr(files, "written", lambda df, name: columns.append(df.columns) or stage(df, name))
    run = loaders.load_bulk(spark, bulk, tables, through="games")
    assert columns[0] == ["player_id", "team_id", "player_name", files.DAMAGED]
    report = tables.load_report().filter(f"run = '{run}' and table_name = 'player_game_stats'")
    assert rows(report, "reason", "n_rows") == [("damaged line", 2)]  # held against the whole header
    assert rows(tables["players"].read(), "player_id", "full_name", "team_id") == [
        (10, "Ann", 2), (11, "Bob", 1), (12, "Cal", 1), (13, "Dee", 2)]


ODD_LINES = ['{"PTS":NaN,"GAME_ID":1}', '{"PTS":"abc","FGM":2}', '[{"PTS":1}]', '{"PTS":1} x', "", "x", None, '{"PTS":null,"FGM":3}',
             '{ "PTS" : 1, "MIN":"1:2"}', r'{"P\u0054S":4,"MIN":"1\u003a2"}', "{'PTS':3}", '{"PTS":1,"PTS":2}', '{"PTS":1',
             '{"MIN":{"a":1},"PTS":2}', '{"Q":{"REB":5},"PTS":2}', '{"MIN":"REB:1","PTS":1,"START_POSITION":"a:b"}',
             r'{"PTS":1,"MIN":"\u003a","REB":null}', '{"PTS":Infinity}', "{}", '{"GAME_ID":"7:1","REB":null,"PTS":5,"MIN":"1"}']


def test_what_a_record_lacks_is_told_as_by_its_keys(spark):
    lines = spark.createDataFrame([(i, line) for i, line in enumerate(ODD_LINES)], "i int, value string")
    own = F.from_json("value", files.BOX_FEED).alias("row")
    keyed = lines.select("i", "value", own, F.json_object_keys("value").alias("there"))
    names = files.BOX_FEED.names
    wanted = [F.when(F.col("there").isNotNull() & ~F.array_contains("there", n), F.lit(0.0)).otherwise(F.col(f"row.{n}")).alias(n)
              if n in files.BOX_COLUMNS else F.col(f"row.{n}") for n in names]
    found = files.from_lines(lines.select("value"), files.BOX_FEED, files.BOX_COLUMNS)
    text = [F.col(n).cast("string") for n in names]
    assert rows(found.select(*text)) == rows(keyed.select(*wanted).select(*text))


def test_keys_are_read_again_only_of_records_that_are_not_full(spark, capsys):
    """Whether columns are absent follows from the number of values; a second pass over each line made up a third of the parsing."""
    lines = spark.createDataFrame([('{"GAME_ID":1,"MIN":"1:30","PTS":2}',)], "value string")
    files.from_lines(lines, files.BOX_FEED, files.BOX_COUNTS).explain("formatted")
    text = capsys.readouterr().out
    assert "CASE WHEN NOT full" in text and set(files.BOX_COUNTS) == {"OREB", "DREB", "PLUS_MINUS"}


def test_plain_clocks_are_read_as_the_pattern_reads_them(spark):
    clocks = ["35:39", ":30", "3:", ":", "00:00", "7:5", "99999999999:1", "1:99999999999", "1:2:3", " 1:2", "+1:02", "-1:30", "12.5", "x", None]
    minutes = dict(rows(spark.createDataFrame([(c,) for c in clocks], "c string").select("c", S.parse_minutes("c", live=True).alias("m"))))
    assert minutes == {"35:39": 35.65, ":30": 0, "3:": 0, ":": 0, "00:00": 0, "7:5": 7.08, "99999999999:1": 0, "1:99999999999": 0,
                       "1:2:3": 0, " 1:2": 1.03, "+1:02": 1.03, "-1:30": -0.5, "12.5": 12.5, "x": 0, None: 0}


def staged_rows(spark, name):
    """The names of the folders staged so far that hold rows of a table."""
    from pathlib import Path
    from sidelines.session import shared_dir
    return {p.name for p in Path(shared_dir(spark)).iterdir() if p.name.startswith((f"load-{name}-", f"sound-{name}-", f"judged-{name}-"))}


def test_rows_of_contests_go_into_their_table_in_the_job_that_reads_them(spark, tables, tmp_path):
    landing, day = tmp_path / "landing", "2024-01-05"
    write_json(landing / "header", [contest(day, "22300500")])
    write_json(landing / "line_score", [score(day, 1, 100), score(day, 2, 90)])
    # a copy, a row without a player, one of a contest of another day
    write_json(landing / "box", [line("22300500", 10, 12), line("22300500", 10, 12), line("22300500", None, 3), line("22300999", 10, 9)])
    write_json(landing / "tracking", [{"GAME_ID": "22300500", "PLAYER_ID": 10, "DIST": d} for d in (2.5, 2.5, 99.0)])
    before = {name: staged_rows(spark, name) for name in ("player_game_stats", "player_tracking_stats")}
    loaders.load_landed(spark, str(landing), tables, date(2024, 1, 1), date(2024, 1, 31))
    assert before == {name: staged_rows(spark, name) for name in before}
    assert rows(tables["player_game_stats"].read(), "game_id", "player_id", "points") == [("0022300500", 10, 12.0)]
    assert rows(tables["player_tracking_stats"].read().selectExpr("player_id", "cast(distance_miles as double)")) == [(10, 2.5)]
    report = rows(tables.load_report(), "table_name", "reason", "n_rows")
    assert [r for r in report if r[0] != "games"] == [
        ("player_game_stats", "missing player_id or game_id or team_id", 1), ("player_game_stats", "repeated key", 1),
        ("player_tracking_stats", "implausible distance", 1), ("player_tracking_stats", "repeated key", 1)]
    # a later load keeps what it does not know, and what it leaves out is in no table
    tables["player_game_stats"].upsert(spark.createDataFrame([(10, "0022300500", 7.5)], "player_id long, game_id string, usage_rate double"))
    loaders.load_landed(spark, str(landing), tables, date(2024, 1, 1), date(2024, 1, 31))
    stats = tables["player_game_stats"].read().selectExpr("player_id", "points", "cast(usage_rate as double)")
    assert rows(stats) == [(10, 12.0, 7.5)]
