"""What several operators share: whole rows beside working columns, ASCII case, components of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sidelines.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The white space that separates words.
WHITE = " \t\n\x0b\x0c\r"
_ROW = "_row"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def beside_row(df: DataFrame, **needed: Column) -> DataFrame:
    """The needed columns beside the whole row, which is one column: names in the row can't clash with others."""
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(_ROW)
    return df.select(row, *[column.alias(name) for name, column in needed.items()])


def row_with(rows: DataFrame, columns: list[str], **results: Column) -> DataFrame:
    """The row's columns again, with results added; a result takes the place of a column of the same name."""
    taken = {name.lower(): name for name in results}
    kept = [results[taken[c.lower()]].alias(c) if c.lower() in taken else F.col(f"{_ROW}.{quoted(c)}").alias(c)
            for c in columns]
    present = {c.lower() for c in columns}
    return rows.select(*kept, *[column.alias(name) for name, column in results.items() if name.lower() not in present])


def components(links: DataFrame) -> DataFrame:
    """Connected components: ``links(a, b)`` of longs to ``(node, root)``, root being the component's smallest node.

    Large-star and small-star in turn: every node points its larger neighbours, then its smaller ones, to the smallest
    node it knows. Each round shuffles the links once for each star and is written to the shared folder; the number
    of rounds follows the logarithm of the longest path. A node with very many neighbours is never gathered: its
    smallest neighbour is an aggregate, which joins back to the links.
    """
    def star(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        return edges.join(least, "a")

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    before, now = None, state(edges)
    while before != now:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        large = (star(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        small = star(large)
        pointed = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(pointed.union(small.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, now = now, state(edges)
    # now every node but the roots has one link, to its root
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
