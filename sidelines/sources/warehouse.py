"""The warehouse as a folder of Parquet tables, with the same table names as ``StarDomain``."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sidelines.operators.schedule import team_long
from sidelines.session import move_folder

TABLES = ("teams", "games", "players", "stats", "tracking", "predictions", "model_versions")


def materialize(df: DataFrame, path: str, write: bool = True) -> DataFrame:
    """Replace a derived table as a whole. With ``write=False`` it is only built.

    The new table is written beside the old one and takes its place when it is complete, so that a failed job leaves the old
    one, and ``df`` may read it.
    """
    if not write:
        return df
    path = path.rstrip("/")
    beside = f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(beside)
    move_folder(df.sparkSession, beside, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def preview(df: DataFrame, rows: int = 15) -> DataFrame:
    """The first rows of a result, after its own ordering."""
    return df.limit(rows)


def write_records(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.root}/{name}")
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def team_keys(self) -> DataFrame:
        return team_long(self.games).select("team_id")

    @cached_property
    def player_keys(self) -> DataFrame:
        return self.stats.select("player_id")

    def register_views(self, names: Iterable[str]) -> None:
        for name in names:
            self.table(name).createOrReplaceTempView(name)

    @classmethod
    def build(cls, domain, root: str, names: Iterable[str] = TABLES) -> "Warehouse":
        """Write the domain tables, each replaced as a whole."""
        warehouse = cls(domain.spark, root)
        for name in names:
            warehouse._tables[name] = materialize(getattr(domain, name), f"{warehouse.root}/{name}")
        return warehouse


def read_database_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a live database. Give partitionColumn, lowerBound, upperBound and numPartitions for a large one."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
