"""Operators on tables with a key: dedupe, upsert, insert-if-absent, key and reference checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], few: bool = False) -> DataFrame:
    """Keep the first row of each key in a stated order.

    Spark limits each key to one row before the shuffle (WindowGroupLimit), so a key with very many copies
    sends one row per input task. It sorts all rows for that, which ``few`` copies, in number bounded by the caller, are not worth.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    # a limit is found in a comparison with a literal only
    first = F.col("_rank") == F.least("_rank", F.lit(1)) if few else F.col("_rank") == 1
    return df.withColumn("_rank", F.row_number().over(window)).filter(first).drop("_rank")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after inserting or overwriting by key.

    An incoming NULL overwrites. Columns that the incoming rows do not have keep their value. The incoming
    rows must be unique on the key.
    """
    old, new = existing.alias("old"), incoming.withColumn("_new", F.lit(True)).alias("new")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"old.{key}") == F.col(f"new.{key}"))
    arrived = F.col("new._new").isNotNull()
    columns = []
    for field in existing.schema.fields:
        name = field.name
        if name not in incoming.columns:
            columns.append(F.col(f"old.{name}"))
        elif name in keys:
            columns.append(F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}")).cast(field.dataType).alias(name))
        else:
            columns.append(F.when(arrived, F.col(f"new.{name}").cast(field.dataType))
                           .otherwise(F.col(f"old.{name}")).alias(name))
    return old.join(new, on, "full_outer").select(*columns)


def absent_from(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming rows whose key the table does not hold yet."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after inserting only new keys: the first version of a row is kept for ever."""
    return existing.unionByName(absent_from(incoming, existing, keys).select(*existing.columns))


def missing_references(df: DataFrame, column: str, referenced: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is set and leads nowhere."""
    return (df.filter(F.col(column).isNotNull())
            .join(referenced.select(F.col(key).alias(column)), column, "left_anti"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
