"""Positions in a global order without a single-task window.

``row_number`` over an unpartitioned window, or over a key that holds a large part of the data, sorts
everything in one task. Here the rows are range-partitioned by the order, so every partition is one
contiguous stretch of it, and a row's position is its place inside the partition plus the number of rows in
the partitions before. The placed rows are written out first: range bounds are sampled, and a second
evaluation could cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sidelines.session import written

_AT = "_at"
_PART = "_part"
# monotonically_increasing_id keeps the position inside the partition in its lower 33 bits.
_PART_SHIFT = 33
_CELLS_PER_DOUBLING = 4096  # numbers are counted in cells, texts by their first characters
_FIRST_CHARACTERS = 4



def ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which NULL is a value like any other."""
    right = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    joined = left.join(right, condition, how)
    return joined.drop(*[f"_right_{key}" for key in keys])


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    by = ascending(order)
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    at = ordered.withColumn(_AT, F.monotonically_increasing_id())
    return written(at, "placed").withColumn(_PART, F.shiftright(_AT, _PART_SHIFT))


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_index") -> DataFrame:
    """Add the 0-based position of each row among the rows of its key (of all rows if there is no key).

    ``order`` must identify a row within its key. Beside the range shuffle there is only one more table,
    with a row per partition and key that meets in it; Spark broadcasts it if it is small.
    """
    rows = _placed(df, [*keys, *order])
    stretches = rows.groupBy(*keys, _PART).agg(F.min(_AT).alias("_first"), F.count("*").alias("_rows"))
    earlier = W.partitionBy(*keys).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    shifts = stretches.select(
        *keys, _PART,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = join_keys(rows, shifts, [*keys, _PART], "inner")
    return joined.select(*df.columns, (F.col(_AT) + F.col("_shift")).alias(name))


def prefix_sums(df: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """For every value column add ``<value>_before``: its sum over all rows earlier in the order."""
    rows = _placed(df, order)
    totals = rows.groupBy(_PART).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    earlier_parts = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        _PART, *[F.coalesce(F.sum(f"_{v}").over(earlier_parts), F.lit(0)).alias(f"_{v}") for v in values])
    earlier_rows = W.partitionBy(_PART).orderBy(_AT).rowsBetween(W.unboundedPreceding, -1)
    return (rows.join(offsets, _PART)
            .select(*df.columns,
                    *[(F.col(f"_{v}") + F.coalesce(F.sum(v).over(earlier_rows), F.lit(0))).alias(f"{v}_before")
                      for v in values]))


def _cell(column: Column, kind: T.DataType) -> Column:
    """A coarse number (of a text: its beginning) that never falls while the column grows; NULL has a cell of its own."""
    if isinstance(kind, T.StringType):
        return F.substring(column, 1, _FIRST_CHARACTERS)
    if not isinstance(kind, T.NumericType):
        return F.when(column.isNotNull(), F.lit(0))
    x = column.cast("double")
    infinite, middle = F.abs(x) == float("inf"), 2_000 * _CELLS_PER_DOUBLING  # doubles have some 2,100 doublings
    size = middle + F.floor(F.log2(F.when(~infinite & (x != 0), F.abs(x)).otherwise(F.lit(1.0))) * _CELLS_PER_DOUBLING)
    size = F.when(x == 0, F.lit(0)).when(infinite, F.lit(2 * middle)).otherwise(size)
    return F.when(F.isnan(x), F.lit(3 * middle)).when(x < 0, -size).when(x.isNotNull(), size)


def _reached(counts: DataFrame, order: str) -> DataFrame:
    """Of each boundary's counted values the one that its rank falls into; the rank is then the one within that value."""
    earlier = W.partitionBy("_k").orderBy(F.col(order).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    inside = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_rows"))
    return placed.filter(inside).withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_before", "_rows")


def _at(rows: DataFrame, edges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that agree with a boundary in these columns. There is one edge per boundary, so they are broadcast."""
    here = F.broadcast(edges.withColumnsRenamed({c: f"_edge{c}" for c in columns}))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_edge{c}"))
    return rows.join(here, same).drop(*[f"_edge{c}" for c in columns])


def _ordered(columns: Sequence[Column]) -> Column:
    """A struct that compares like rows ordered by these columns, NULL last."""
    return F.struct(*[f.alias(f"f{i}") for i, f in enumerate(g for c in columns for g in (c.isNull(), c))])


def ntile(df: DataFrame, buckets: int, value: str, ties: Sequence[str], name: str) -> DataFrame:
    """NTILE over all rows ordered by ``value`` (NULL last); ``ties`` order the rows of one value, and must tell them apart.

    Bucket sizes differ by at most one and the larger buckets come first. The first row of each later bucket is found by
    counting: rows per cell of the value, then per value of the cells that a bucket begins in, and, where it begins among
    the rows of a value, these per cell of the first tie; only the rows of such a cell are ordered. Then every row is compared
    with the few first rows. Building the plan starts no job and no rows are copied; ``df`` must give the same rows each time.
    """
    if buckets == 1:
        return df.withColumn(name, F.lit(1))
    kinds = {c: df.schema[c].dataType for c in (value, *ties)}
    rows = F.sum("_rows").alias("_rows")
    counts = (df.groupBy(value).agg(F.count("*").alias("_rows"))
              .withColumn("_cell", _cell(F.col(value), kinds[value])))
    cells = (counts.groupBy("_cell").agg(rows)
             .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(buckets - 1))))
             .withColumn("_all", F.sum("_rows").over(W.partitionBy("_k")))
             .withColumn("_rank", F.expr(f"_k * (_all div {buckets}) + least(_k, _all % {buckets})")).drop("_all"))
    edges = _reached(_at(counts, _reached(cells, "_cell"), ["_cell"]).drop("_cell"), value)

    # a bucket that begins with the first row of a value needs no ties: a NULL that is not told as one is before all others
    none = [f.alias(f"f{2 + i}") for i, f in enumerate(g for c in ties for g in (F.lit(False), F.lit(None).cast(kinds[c])))]
    whole = edges.filter("_rank = 0").select(
        "_k", F.struct(F.col(value).isNull().alias("f0"), F.col(value).alias("f1"), *none).alias("_edge"))
    tied = df.select(value, *ties, _cell(F.col(ties[0]), kinds[ties[0]]).alias("_cell"))
    per_cell = (_at(tied, edges.filter("_rank > 0"), [value]).groupBy("_k", "_rank", value, "_cell")
                .agg(F.count("*").alias("_rows")))
    beside = _at(tied, _reached(per_cell, "_cell"), [value, "_cell"])
    cut = (beside.withColumn("_at", F.row_number().over(W.partitionBy("_k").orderBy(*ascending(ties))))
           .filter(F.col("_at") == F.col("_rank") + 1)
           .select("_k", _ordered([F.col(c) for c in (value, *ties)]).alias("_edge")))
    firsts = whole.unionByName(cut).groupBy(F.lit("all")).agg(F.struct(*[
        F.max(F.when(F.col("_k") == k, F.col("_edge"))).alias(f"k{k}") for k in range(1, buckets)]).alias("_firsts"))

    row = _ordered([F.col(c) for c in (value, *ties)])
    reached = [F.coalesce((row >= F.col(f"_firsts.k{k}")).cast("int"), F.lit(0)) for k in range(1, buckets)]
    return (df.withColumn("_firsts", firsts.select("_firsts").scalar())
            .withColumn(name, sum(reached, F.lit(1))).drop("_firsts"))
