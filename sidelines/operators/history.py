"""Columns computed over the time-ordered rows of an entity (a team's or a player's contests).

A window over an entity sorts all of its rows in one task, which fails when one entity holds a large part of the table.
So every history is cut into blocks of time (years, unless told otherwise), and an entity and block is what a task
sorts. What a row needs from earlier blocks is small and comes from one row per entity and block: the last few rows
before the block, the first one after it, and totals. Sums are exact (whole numbers or fixed-scale decimals), so the
values do not depend on where the blocks are cut or in which order anything is added.

Where the rows are costly to make they are staged first, and an entity that has few of them is not cut: a window over it
sorts no more than a task can hold, and nothing has to be summarised, sent and joined for it (``over_staged``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sidelines.operators.ranking import ascending
from sidelines.session import HISTORY_BLOCK, setting, written

# Of an entity and block; NULL is a value like any other, for which a flag stands beside a filler.
_ENTITY, _BLOCK = ("_entity_none", "_entity"), ("_block_none", "_block")
_KEY = KEY = [*_ENTITY, *_BLOCK]
_AT, _NEXT, _BEFORE, _WITHIN = "_edge_at", "_edge_next", "_edge_before", "_edge_within"
_LAST, _SUMS, _COUNTS = "_edge_last", "_edge_sums", "_edge_counts"
# Fractions are added to twelve places.
_FIXED, _TOTAL = "decimal(24,12)", "decimal(34,12)"  # with more digits an addition would round
MOST_WHOLE = 100_000  # rows of an entity that one task sorts; one that has more is cut into blocks


@dataclass(frozen=True)
class Rolling:
    """Mean of the last ``rows`` rows, of which the current row is one unless ``current`` is false."""

    value: str
    rows: int
    current: bool = True
    min_count: int = 1

    @property
    def lookback(self) -> int:
        return self.rows - 1 if self.current else self.rows


@dataclass(frozen=True)
class RowsInFrame:
    """How many rows the rolling frame holds, the current one included."""

    rows: int
    lookback = 0


@dataclass(frozen=True)
class Previous:
    value: str
    lookback = 1


@dataclass(frozen=True)
class Following:
    value: str
    lookback = 0


@dataclass(frozen=True)
class Running:
    """Mean of everything so far, with or without the current row; starts anew for each value of ``within``."""

    value: str
    current: bool = True
    min_count: int = 1
    within: tuple[str, ...] = ()
    alone: bool = False  # no other block has rows that count
    lookback = 0


Spec = Rolling | RowsInFrame | Previous | Following | Running


def _zero(kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.lit("1970-01-01").cast(kind)
    return (F.lit("") if isinstance(kind, T.StringType) else F.lit(0)).cast(kind)


def _flagged(value: Column, kind: T.DataType, names: tuple[str, str]) -> list[Column]:
    """Whether the value is NULL (which sorts last), and the value without NULL."""
    return [value.isNull().alias(names[0]), F.coalesce(value, _zero(kind)).alias(names[1])]


class _Exact:
    """Sums of a column without rounding: of whole numbers as longs, of others as decimals of twelve places."""

    def __init__(self, df: DataFrame, value: str):
        whole = isinstance(df.schema[value].dataType, (T.IntegralType, T.BooleanType))
        self.value, self.total = value, "bigint" if whole else _TOTAL
        self.term = (lambda c: c.cast("bigint")) if whole else (lambda c: c.cast(_FIXED))

    def sum(self, column: Column) -> Column:
        return F.sum(self.term(column))

    def mean(self, total: Column, n: Column) -> Column:
        """Decimals are divided as such: a cast to double first would depend on how Spark happens to hold them."""
        return total / n if self.total == "bigint" else (total / n).cast("double")

    def zero(self) -> Column:
        return F.lit(0).cast(self.total)

    def plus(self, a: Column, b: Column) -> Column:
        a, b = (F.coalesce(c.cast(self.total), self.zero()) for c in (a, b))
        return (a + b).cast(self.total)


class History:
    """Columns over the rows of each entity in ``order`` (ascending, NULL last), and what they need of other blocks.

    ``order`` must identify a row within the entity (a date alone does not: two contests can share it). ``block`` must not
    fall while the order rises; left out, it is the year (or what ``spark.sidelines.historyBlock`` says) of the first
    column of the order, a date. A mean that starts anew within the column that is the block needs nothing from others.
    ``like`` has the columns of the rows.
    """

    def __init__(self, like: DataFrame, entity: str, order: Sequence[str], columns: Mapping[str, Spec],
                 block: Column | str | None = None):
        self.entity, self.order, self._block = entity, list(order), block
        self.columns = {name: replace(spec, alone=True)
                        if isinstance(block, str) and isinstance(spec, Running) and spec.within == (block,) else spec
                        for name, spec in columns.items()}
        if block is None:
            block = _stretch(order[0], setting(like.sparkSession, HISTORY_BLOCK))
        elif isinstance(block, str):
            block = F.col(block)
        kind = like.select(block.alias("b")).schema["b"].dataType
        self._flags = [*_flagged(F.col(entity), like.schema[entity].dataType, _ENTITY), *_flagged(block, kind, _BLOCK)]
        self._exact = {spec.value: _Exact(like, spec.value) for spec in self.columns.values() if isinstance(spec, (Rolling, Running))}
        self._need = _Needed.of(self.columns)

    def keyed(self, rows: DataFrame) -> DataFrame:
        """The rows with the key of their entity and block."""
        return rows.select("*", *self._flags)

    def summaries(self, keyed: DataFrame) -> DataFrame:
        """A row per entity and block with what other blocks may need of it."""
        return block_summaries(keyed, self.order, self._need, self._exact)

    def edges(self, summaries: DataFrame) -> DataFrame:
        """A row per entity and block with what it needs of the others, from the summaries of all blocks of the entity."""
        return edges_between(summaries, self._need, self.columns, self._exact)

    def values(self, keyed: DataFrame, edges: DataFrame) -> DataFrame:
        """The rows of some blocks, all of each, with the columns."""
        in_block = W.partitionBy(*_KEY).orderBy(*ascending(self.order))
        local: dict[str, Column] = {_AT: F.row_number().over(in_block)}
        for name, spec in self.columns.items():
            local |= _local(name, spec, self._exact, in_block)
        rows = keyed.select("*", *[column.alias(name) for name, column in local.items()])
        own = [c for c in keyed.columns if c not in _KEY]
        return rows.join(edges, _KEY, "left").select(
            *own, *[_value(name, spec, self._exact).alias(name) for name, spec in self.columns.items()])

    def over_staged(self, rows: DataFrame) -> DataFrame:
        """Like ``over``, but stages the rows first; only entities of more than ``MOST_WHOLE`` rows go block by block."""
        staged = written(rows, "history")
        large = (staged.groupBy(F.col(self.entity).alias("_large")).agg(F.count("*").alias("_rows"))
                 .filter(F.col("_rows") > MOST_WHOLE).drop("_rows"))
        if large.isEmpty():
            return self.whole(staged)
        # there is at most one for every so many rows
        large, same = F.broadcast(large), F.col(self.entity).eqNullSafe(F.col("_large"))
        return (self.whole(staged.join(large, same, "left_anti"))
                .unionByName(self.over(staged.join(large, same, "left_semi"))))

    def whole(self, rows: DataFrame) -> DataFrame:
        """The rows with the columns, by a window over all rows of each entity."""
        # a block never falls while the order rises, so that rows sorted by both serve the means within a block, too
        order = ascending([*([self._block] if isinstance(self._block, str) else []), *self.order])
        local: dict[str, Column] = {_AT: F.row_number().over(W.partitionBy(self.entity).orderBy(*order))}
        for name, spec in self.columns.items():
            within = spec.within if isinstance(spec, Running) else ()
            local |= _local(name, spec, self._exact, W.partitionBy(self.entity, *within).orderBy(*order), anew=False)
        return rows.select("*", *[column.alias(name) for name, column in local.items()]).select(
            *rows.columns, *[_own_value(name, spec, self._exact).alias(name) for name, spec in self.columns.items()])

    def over(self, rows: DataFrame) -> DataFrame:
        """The rows with the columns, block by block. Building this starts no job."""
        keyed = self.keyed(rows)
        edges = self.edges(self.summaries(keyed))
        for names in self._need.within:
            edges = edges.join(_totals_within(keyed, names, self._need.known, self._exact), _KEY, "left")
        return self.values(keyed, edges)


def with_history(df: DataFrame, entity: str, order: Sequence[str], columns: Mapping[str, Spec],
                 block: Column | str | None = None) -> DataFrame:
    """Add ``columns`` computed over each entity's rows (see ``History``)."""
    return History(df, entity, order, columns, block).over(df)


def with_staged_history(df: DataFrame, entity: str, order: Sequence[str], columns: Mapping[str, Spec],
                        block: Column | str | None = None) -> DataFrame:
    """The same over rows that are made once and staged; only entities with very many rows are cut into blocks."""
    return History(df, entity, order, columns, block).over_staged(df)


def _stretch(date: str, unit: str) -> Column:
    """The decade, year, quarter or month of a date."""
    return F.floor(F.year(date) / 10) if unit == "decade" else F.trunc(date, unit)


def _within(names: tuple[str, ...]) -> str:
    return "_".join((_WITHIN, *names))


def _parts(name: str) -> tuple[str, str]:
    return f"_sum_{name}", f"_count_{name}"


def _local(name: str, spec: Spec, exact: dict[str, _Exact], in_block, anew: bool = True) -> dict[str, Column]:
    """What the rows of the window itself give. One that does not start anew for a mean does so already."""
    if isinstance(spec, RowsInFrame):
        return {}
    if isinstance(spec, Previous):
        return {f"_own_{name}": F.lag(spec.value).over(in_block)}
    if isinstance(spec, Following):
        return {f"_own_{name}": F.lead(spec.value).over(in_block), f"_last_{name}": F.lead(F.lit(True)).over(in_block).isNull()}
    begin = -spec.lookback if isinstance(spec, Rolling) else W.unboundedPreceding
    window = in_block if isinstance(spec, Rolling) or spec.alone or not anew else _starting_anew(in_block, spec.within)
    frame = window.rowsBetween(begin, 0 if spec.current else -1)
    term = exact[spec.value].term(F.col(spec.value))
    total, count = _parts(name)
    return {total: F.sum(term).over(frame), count: F.count(term).over(frame)}


def _starting_anew(in_block, within: tuple[str, ...]):
    return in_block.partitionBy(*_KEY, *within) if within else in_block


@dataclass(frozen=True)
class _Needed:
    """What the specifications ask of other blocks."""

    rows: bool
    lookback: int
    back: list[str]
    ahead: list[str]
    known: list[str]
    within: list[tuple[str, ...]]

    @classmethod
    def of(cls, columns: Mapping[str, Spec]) -> _Needed:
        specs = list(columns.values())
        running = [s for s in specs if isinstance(s, Running) and not s.alone]
        return cls(any(isinstance(s, RowsInFrame) for s in specs), max(s.lookback for s in specs), sorted({s.value for s in specs if isinstance(s, (Rolling, Previous))}),
                   sorted({s.value for s in specs if isinstance(s, Following)}), sorted({s.value for s in running}),
                   sorted({s.within for s in running if s.within}))


def block_summaries(keyed: DataFrame, order: Sequence[str], need: _Needed, exact: dict[str, _Exact]) -> DataFrame:
    """A row per entity and block: its number of rows, its exact sums, its first row and its last few.

    Each of these can be merged, and is, before anything is shuffled: counts, sums, the first row and a single last one
    as partial aggregates, several last rows by a limit for each entity and block within every input partition.
    """
    found = [F.count("*").alias("_rows")] if need.rows else []
    at = F.struct(*_nulls_last(keyed, order))
    if need.ahead:
        found.append(F.min_by(F.struct(*need.ahead), at).alias("_first"))
    if need.lookback == 1:
        found.append(F.max_by(F.struct(*need.back), at).alias("_own"))
    for v in need.known:
        term = exact[v].term(F.col(v))
        found += [F.sum(term).alias(f"_s_{v}"), F.count(term).alias(f"_c_{v}")]
    blocks = keyed.groupBy(*_KEY).agg(*found) if found else None
    if need.lookback > 1:
        latest_first = W.partitionBy(*_KEY).orderBy(*[F.col(c).desc_nulls_first() for c in order])
        last = (keyed.select(*_KEY, *dict.fromkeys([*order, *need.back])).withColumn("_from_end", F.row_number().over(latest_first))
                .filter(F.col("_from_end") <= need.lookback)
                .groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("_from_end", *need.back)), asc=False).alias("_own")))
        blocks = last if blocks is None else blocks.join(last, _KEY)
    return keyed.select(*_KEY).distinct() if blocks is None else blocks


def _nulls_last(df: DataFrame, order: Sequence[str]) -> list[Column]:
    return [c for name in order for c in _flagged(F.col(name), df.schema[name].dataType, (f"_none_{name}", f"_at_{name}"))]


def edges_between(blocks: DataFrame, need: _Needed, columns: Mapping[str, Spec], exact: dict[str, _Exact]) -> DataFrame:
    """What each block needs of the others of its entity, from the summaries of all of them."""
    by_time = W.partitionBy(*_ENTITY).orderBy(*_BLOCK)
    earlier = by_time.rowsBetween(W.unboundedPreceding, -1)
    found = [F.sum("_rows").over(earlier).alias(_BEFORE)] if need.rows else []
    if need.ahead:
        found.append(F.lead("_first").over(by_time).alias(_NEXT))
    # every block has a row, so these blocks hold enough
    if need.lookback == 1:
        found.append(F.array(F.lag("_own").over(by_time)).alias("_tail"))
    elif need.lookback:
        found.append(F.flatten(F.collect_list("_own").over(by_time.rowsBetween(-need.lookback, -1))).alias("_tail"))
    found += [F.sum(f"_{k}_{v}").over(earlier).alias(f"_{k}_before_{v}") for v in need.known for k in "sc"]
    edges = blocks.select(*_KEY, *found)
    if need.lookback:
        edges = edges.select("*", *_of_tail(columns, exact)).drop("_tail")
    return edges


def _of_tail(columns: Mapping[str, Spec], exact: dict[str, _Exact]) -> list[Column]:
    """The last values before the block, and the sums and counts of the last 0, 1, 2, ... of them as arrays.

    They are running sums over an array: a column for each would make an expression that takes longer to plan than to run.
    """
    latest = F.reverse("_tail")
    found = [F.get(latest, F.lit(0))[v].alias(f"{_LAST}_{v}")
             for v in sorted({s.value for s in columns.values() if isinstance(s, Previous)})]
    for v in sorted({s.value for s in columns.values() if isinstance(s, Rolling)}):
        rows = max(s.lookback for s in columns.values() if isinstance(s, Rolling) and s.value == v)
        terms = F.transform(F.slice(latest, 1, rows), lambda row: exact[v].term(row[v]))  # noqa: B023
        found += [F.aggregate(terms, F.array(exact[v].zero()), lambda sums, x: F.concat(
                      sums, F.array(exact[v].plus(F.element_at(sums, -1), x)))).alias(f"{_SUMS}_{v}"),  # noqa: B023
                  F.aggregate(terms, F.array(F.lit(0).cast("bigint")), lambda counts, x: F.concat(
                      counts, F.array(F.element_at(counts, -1) + x.isNotNull().cast("bigint")))).alias(f"{_COUNTS}_{v}")]
    return found


def _totals_within(keyed: DataFrame, within: tuple[str, ...], known: list[str], exact: dict[str, _Exact]) -> DataFrame:
    """Per entity and block the totals up to it for each value of ``within`` that occurs in the block."""
    sums = [column for v in known for column in (exact[v].sum(F.col(v)).alias(f"_s_{v}"),
                                                 F.count(exact[v].term(F.col(v))).alias(f"_c_{v}"))]
    parts = keyed.groupBy(*_KEY, *within).agg(*sums)
    earlier = W.partitionBy(*_ENTITY, *within).orderBy(*_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(*_KEY, *within, *[F.sum(f"_{k}_{v}").over(earlier).alias(f"_{k}_before_{v}")
                                             for v in known for k in "sc"])
    return carried.groupBy(*_KEY).agg(F.collect_list(F.struct(
        F.struct(*within).alias("of"), *[f"_{k}_before_{v}" for v in known for k in "sc"])).alias(_within(within)))


def _own_value(name: str, spec: Spec, exact: dict[str, _Exact]) -> Column:
    """What a window over all rows of the entity gives."""
    if isinstance(spec, RowsInFrame):
        return F.least(F.lit(spec.rows).cast("bigint"), F.col(_AT))
    if isinstance(spec, (Previous, Following)):
        return F.col(f"_own_{name}")
    total, count = _parts(name)
    how = exact[spec.value]
    return F.when(F.col(count) >= max(spec.min_count, 1), how.mean(how.plus(F.col(total), F.lit(None)), F.col(count)))


def _value(name: str, spec: Spec, exact: dict[str, _Exact]) -> Column:
    """What the block and the edge before or after it give together."""
    at = F.col(_AT)
    if isinstance(spec, RowsInFrame):
        return F.least(F.lit(spec.rows).cast("bigint"), at + F.coalesce(_BEFORE, F.lit(0)))
    if isinstance(spec, Previous):
        return F.when(at == 1, F.col(f"{_LAST}_{spec.value}")).otherwise(F.col(f"_own_{name}"))
    if isinstance(spec, Following):
        return F.when(F.col(f"_last_{name}"), F.col(_NEXT)[spec.value]).otherwise(F.col(f"_own_{name}"))
    how = exact[spec.value]
    if isinstance(spec, Rolling):
        before = F.greatest(spec.lookback + 1 - at, F.lit(0))  # rows of the frame that lie before the block
        sums, counts = F.col(f"{_SUMS}_{spec.value}"), F.col(f"{_COUNTS}_{spec.value}")
        before = F.least(before, F.size(sums) - 1)  # where there are fewer, all of them
        carried = F.get(sums, before), F.get(counts, before)
    elif spec.alone:
        carried = F.lit(None), F.lit(None)
    elif spec.within:
        rows = F.filter(_within(spec.within), lambda x: x["of"].eqNullSafe(F.struct(*spec.within)))
        row = F.get(rows, F.lit(0))
        carried = row[f"_s_before_{spec.value}"], row[f"_c_before_{spec.value}"]
    else:
        carried = F.col(f"_s_before_{spec.value}"), F.col(f"_c_before_{spec.value}")
    total, count = _parts(name)
    n = F.col(count) + F.coalesce(carried[1], F.lit(0))
    return F.when(n >= max(spec.min_count, 1), how.mean(how.plus(F.col(total), carried[0]), n))
