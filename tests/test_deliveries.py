"""The files that the loads and streams of the test data are given: as many as their rows need."""

from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from conftest import rows
from sidelines import registry
from sidelines.operators import quality as Q
from sidelines.sources import deliveries
from sidelines.sources.star import StarDomain


def _star(spark, folder) -> StarDomain:
    n = F.col("id")
    (spark.range(0, 400, 1, 16).select(
        F.floor(n / 4).alias("l_orderkey"), (n % 30).alias("l_partkey"), (n % 7).alias("l_suppkey"), (n % 4 + 1).cast("int").alias("l_linenumber"),
        (n % 50).cast("double").alias("l_quantity"), (n * 3.0).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.lit("A").alias("l_returnflag"), F.lit("1997-03-04").cast("timestamp").alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet"))
    (spark.range(100).select(n.alias("o_orderkey"), F.lit("1997-03-01").cast("timestamp").alias("o_orderdate"))
     .write.parquet(f"{folder}/orders.parquet"))
    return StarDomain(spark, str(folder))


def _files(folder) -> list[str]:
    return [p.name for p in Path(folder).iterdir() if p.name.startswith("part-")]


def test_landed_files_grow_with_the_order_lines(spark, tmp_path):
    d = _star(spark, tmp_path / "star")
    deliveries.landed_files(d, str(tmp_path / "landing"))
    for kind in ("header", "line_score"):
        names = _files(tmp_path / "landing" / kind)
        assert len(names) > 3 and len(names) % 3 == 0 and all(name.endswith(".json.gz") for name in names)
    assert spark.read.json(str(tmp_path / "landing" / "header")).count() == d.games.count() == 100
    assert spark.read.json(str(tmp_path / "landing" / "box")).count() == d.stats.count()


def test_a_streams_files_grow_with_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "new_folder", lambda _, name: str(tmp_path / name))
    for parts, n_files in ((1, 9), (16, 36)):
        table = spark.range(0, 1000, 1, parts).toDF("k")
        registry._in_batches(SimpleNamespace(spark=spark), table, f"in{parts}")
        assert len(_files(tmp_path / f"in{parts}")) == n_files
        assert rows(spark.read.parquet(str(tmp_path / f"in{parts}"))) == rows(table)


def test_repeated_keys_are_counted_without_a_shuffle_of_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a"), (None, "a")], "k long, v string")
    kept = spark.createDataFrame([(1, "a"), (2, "a")], "k long, v string")
    report = Q.load_report(df, [Q.required("k")], kept)
    assert rows(report) == [("missing k", 1), ("repeated key", 2)]
    assert rows(Q.load_report(kept, [Q.required("k")], kept)) == rows(Q.load_report(kept.limit(0), [Q.required("k")], kept.limit(0))) == []
    shuffles = [line for line in report._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
    assert shuffles and not any("hashpartitioning(k#" in line for line in shuffles)


def test_box_scores_move_as_numbers(spark, tmp_path, monkeypatch):
    """The first line of a player and contest is picked before its text is made."""
    d, picked, first = _star(spark, tmp_path / "star"), [], deliveries.keyed.first_per_key
    (spark.range(7).select(F.col("id").alias("s_suppkey"), F.lit("name").alias("s_name")).write.parquet(str(tmp_path / "star/supplier.parquet")))
    monkeypatch.setattr(deliveries.keyed, "first_per_key", lambda df, keys, order: picked.append(df.dtypes) or first(df, keys, order))
    deliveries.bulk_files(d, str(tmp_path / "bulk"))
    assert {kind for name, kind in picked[-1] if name in ("l_partkey", "l_orderkey", *deliveries._LINE_ORDER)} <= {"bigint", "int", "double"}
    assert "game_id" not in dict(picked[-1])
    kept = spark.read.option("header", True).csv(str(tmp_path / "bulk/games_details.csv"))
    expected = first(d.raw_stats, ["player_id", "game_id"], [F.col(c).asc_nulls_last() for c in deliveries._RAW_ORDER])
    assert rows(kept.selectExpr("cast(PLAYER_ID as long)", "cast(GAME_ID as long)", "MIN").distinct()) == rows(
        expected.selectExpr("player_id", "cast(game_id as long)", "minutes"))
    players = spark.read.option("header", True).csv(str(tmp_path / "bulk/players.csv"))
    named = d.raw_players.filter("player_id % 16 != 1").groupBy("player_id", "season").agg(F.min("full_name"), F.min("team_id"))
    assert rows(players.selectExpr("cast(PLAYER_ID as long)", "cast(SEASON as int)", "PLAYER_NAME", "cast(TEAM_ID as long)")) == rows(named)


def test_contests_move_once_by_their_id(spark, tmp_path):
    plan = _star(spark, tmp_path / "star").games._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan
    assert "l_suppkey" not in " ".join(line.split("200")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line)
