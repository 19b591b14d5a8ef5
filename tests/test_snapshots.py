"""Keyed tables: what a write touches, what a reader sees, what upkeep removes."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sidelines.schemas import BUCKETS, GAMES, KEYS, PARTS
from sidelines.sources.snapshots import SnapshotTable


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "games"), GAMES, KEYS["games"], PARTS["games"], BUCKETS["games"])


def game(game_id, score):
    return (game_id, date(2024, 1, 1), "2023-24", "Regular Season", 1, 2, score, 1, True)


def frame(spark, found):
    return spark.createDataFrame([game(g, s) for g, s in found], GAMES)


def files(table):
    from pathlib import Path
    return {str(p.relative_to(table.root)) for p in Path(table.root).glob("v0*/**/*.parquet")}


def scores(table):
    return dict(rows(table.read(), "game_id", "home_score"))


def test_an_evening_writes_only_its_own_rows(spark, table):
    seasons = [f"00{s}{n:05d}" for s in (221, 222, 223) for n in range(400)]
    table.replace(frame(spark, [(g, 1) for g in seasons]))
    before = files(table)
    assert 3 <= len({f.split("/")[1] for f in before}) and len({tuple(f.split("/")[1:3]) for f in before}) == 48
    evening = [("0022300399", 7), ("0022300400", 8), ("0022300401", 9)]
    table.upsert(frame(spark, evening))
    new = files(table) - before
    assert files(table) >= before and len(new) <= len(evening) and all("part_of_table=00223" in f for f in new)
    assert spark.read.schema(GAMES).parquet(*[f"{table.root}/{f}" for f in new]).count() == 3
    found = scores(table)
    assert len(found) == 1202 and [found[g] for g, _ in evening] == [7, 8, 9] and found["0022100001"] == 1


def test_reading_merges_only_the_buckets_with_deltas(spark, table, capsys):
    table.replace(frame(spark, [(f"0022300{n:03d}", 1) for n in range(500)]))
    table.read().explain()
    assert "Window" not in capsys.readouterr().out
    table.upsert(frame(spark, [("0022300001", 2)]))
    table.read().explain()
    text = capsys.readouterr().out
    assert text.count("FileScan") == 2 and "WindowGroupLimit" in text
    layered = table._files(table._entries())
    assert sum(bool(f.deltas) for f in layered.values()) == 1


def test_any_order_of_writes_equals_a_dictionary(spark, table):
    random.seed(3)
    ids = [f"0022{s}{n:05d}" for s in (1, 2) for n in range(30)]
    want = {}
    for step in range(14):
        some = random.sample(ids, 8)
        kind = random.choice(["upsert", "upsert", "insert", "delete", "part of the columns", "compact", "vacuum", "replace"])
        if kind == "upsert":
            table.upsert(frame(spark, [(g, step) for g in some]))
            want |= dict.fromkeys(some, step)
        elif kind == "insert":
            table.insert_if_absent(frame(spark, [(g, step) for g in some]))
            want = dict.fromkeys(some, step) | want
        elif kind == "delete":
            table.delete(spark.createDataFrame([(g,) for g in some], "game_id string"))
            want = {g: s for g, s in want.items() if g not in some}
        elif kind == "part of the columns":
            table.upsert(spark.createDataFrame([(g, step) for g in some], "game_id string, home_score int"))
            want |= dict.fromkeys(some, step)
        elif kind == "compact":
            table.compact(most_deltas=1)
            assert all(len(f.deltas) <= 1 for f in table._files(table._entries()).values()) or want == {}
        elif kind == "vacuum":
            table.vacuum(keep_versions=random.choice([1, 2]))
        else:
            table.replace(frame(spark, [(g, step) for g in some]))
            want = dict.fromkeys(some, step)
        assert scores(table) == want, (step, kind)


def test_compaction_and_retention(spark, table):
    for step in range(6):
        table.upsert(frame(spark, [(f"0022300{n:03d}", step) for n in range(step, 40)]), delivery=f"stream#{step}")
    want = scores(table)
    assert len(table._entries()) > 60
    assert table.compact(most_deltas=4) == len(table._files(table._entries())) and table.compact(most_deltas=4) == 0
    assert scores(table) == want and not any(f.deltas for f in table._files(table._entries()).values())
    gone = table.vacuum()
    assert len(gone) == 6 and {f.split("/")[0] for f in files(table)} == {"v000007"} and scores(table) == want
    # the log is as short as the table needs, and the stream's last delivery is still known
    assert len(table._entries()) <= 16 + 3 and table.has_delivery("stream#5")
    table.upsert(frame(spark, [("0022300001", 100)]))
    assert scores(table) == want | {"0022300001": 100}
    assert table.vacuum(keep_versions=2) == []


def test_a_version_that_is_kept_can_be_read_by_its_files(spark, table):
    table.upsert(frame(spark, [("0022300001", 1)]))
    table.upsert(frame(spark, [("0022300001", 2)]))
    before = table._files([e for e in table._entries() if e["version"] == 1])
    table.compact(most_deltas=0)
    assert table.vacuum(keep_versions=3) == []
    assert rows(table._merged(before.values()), "home_score") == [(1,)] and scores(table) == {"0022300001": 2}


def test_only_touched_buckets_are_read(spark, table):
    table.replace(frame(spark, [(f"0022300{n:03d}", 1) for n in range(500)]))
    one = spark.createDataFrame([("0022300007",)], "game_id string")
    found = table.read_where(one)
    assert found.filter("game_id = '0022300007'").count() == 1 and found.count() < 80
    assert len(found.inputFiles()) == 1


def test_a_null_in_the_part_and_empty_writes(spark, table):
    table.upsert(frame(spark, []))
    assert table.read().count() == 0 and table._next(table._entries()) == 2
    table.delete(spark.createDataFrame([("x",)], "game_id string"))
    assert table.read().count() == 0 and table.vacuum() == [] and table.compact(0) == 0
    assert table.read().select(F.count("*")).first()[0] == 0


def test_a_first_write_of_unique_rows_is_read_without_a_shuffle(spark, table):
    def shuffles():
        return table.read()._jdf.queryExecution().executedPlan().toString().count("Exchange")

    table.upsert(frame(spark, [("0022300001", 1), ("0022300002", 2)]), unique=True)
    assert shuffles() == 0
    assert [r[0] for r in table.keys_among(frame(spark, [("0022300002", 5), ("0022300009", 5)])).select("game_id").collect()] == ["0022300002"]
    table.upsert(frame(spark, [("0022300001", 3)]), unique=True)  # on top of what is there
    assert shuffles() > 0
    assert sorted((r["game_id"], r["home_score"]) for r in table.read().collect()) == [("0022300001", 3), ("0022300002", 2)]


def roots(df):
    return list(df._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths().mkString("|").split("|"))


def test_a_part_that_is_read_whole_is_one_path(spark, table):
    """A path for each bucket made as many tasks list them, at every read."""
    seasons = [f"00{s}{n:05d}" for s in (221, 222, 223) for n in range(400)]
    table.upsert(frame(spark, [(g, 1) for g in seasons]), unique=True)
    assert len(roots(table.read())) == 3 and table.read().count() == 1200
    table.upsert(frame(spark, [("0022300399", 7)]))  # one bucket of a part is merged now, the other fifteen are not
    assert len(table._files(table._entries())) == 48 and table.read().count() == 1200 and scores(table)["0022300399"] == 7
    assert len(roots(table.read_where(frame(spark, [("0022100001", 0)])))) == 1


def test_rows_set_aside_are_told_and_are_not_in_the_table(spark, table):
    told = []
    judged = table.placed(frame(spark, [("0022300001", 1), ("0022300002", 2), ("0022100001", 3)])).withColumn("reason", F.when(F.col("home_score") == 2, "odd"))
    kept = table.upsert_placed(judged, "reason is null", lambda left: told.extend(rows(left, "game_id", "reason")))
    assert told == [("0022300002", "odd")] and rows(kept, "game_id") == [("0022100001",), ("0022300001",)]
    assert scores(table) == {"0022300001": 1, "0022100001": 3}
    table.upsert(frame(spark, [("0022300001", 5)]))
    assert scores(table) == {"0022300001": 5, "0022100001": 3}
    table.compact(0)
    table.vacuum()
    assert scores(table) == {"0022300001": 5, "0022100001": 3}
