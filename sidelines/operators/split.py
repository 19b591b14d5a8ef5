"""An exact stratified train/test split without sorting the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# The top bits of the hash choose a slice; there are this many slices per label.
_SLICE_BITS = 16


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Add ``is_test``: true for exactly ``round(test_share * n)`` rows of each label.

    Rows are ordered by a seeded hash of their key. Counting per slice of the hash shows in which slice the
    last test row of a label lies; only the rows of that one slice (a 65536th of the label's rows) have to
    be ranked. The result depends on the rows and the seed alone, not on their partitioning.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *keys)).withColumn(
        "_slice", F.shiftright("_hash", 64 - _SLICE_BITS))
    through = W.partitionBy(label).orderBy("_slice")
    whole = W.partitionBy(label)
    slices = (hashed.groupBy(label, "_slice").agg(F.count("*").alias("_rows"))
              .withColumn("_through", F.sum("_rows").over(through))
              .withColumn("_wanted", F.round(F.sum("_rows").over(whole) * test_share).cast("long")))
    # one row per label: the slice in which the last wanted row lies
    edge = (slices.filter((F.col("_through") >= F.col("_wanted"))
                          & (F.col("_through") - F.col("_rows") < F.col("_wanted")))
            .select(label, F.col("_slice").alias("_edge"),
                    (F.col("_wanted") - F.col("_through") + F.col("_rows")).alias("_from_edge")))
    joined = hashed.join(F.broadcast(edge), label, "left")
    at_edge = F.col("_slice") == F.col("_edge")
    rank = F.row_number().over(W.partitionBy(label, "_slice").orderBy("_hash", *keys))
    ranked = joined.filter(at_edge).withColumn("is_test", rank <= F.col("_from_edge"))
    others = (joined.filter(~F.coalesce(at_edge, F.lit(False)))
              .withColumn("is_test", F.coalesce(F.col("_slice") < F.col("_edge"), F.lit(False))))
    return ranked.unionByName(others).select(*df.columns, "is_test")
