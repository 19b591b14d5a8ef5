"""A keyed Parquet table whose writes add files and never copy what they do not touch.

Rows lie in parts (an expression of the key: for contests the leading digits of the id, which stand for the season)
and, within a part, in a fixed number of hash buckets. An upsert writes its own rows, and nothing else, as a delta of the
buckets they belong to; it reads stored rows only where incoming rows lack columns. Readers take the newest row of a key
in the buckets that have deltas, and the files as they are in all others. ``compact`` turns a bucket's deltas into a new base,
``vacuum`` removes the files that no kept version needs, and shortens the log.

A write counts once its rows are in the log of versions, so that a failed job leaves the table as it was. One writer at
a time. ``delivery`` names what a version was made from, so that the same streaming batch is not applied twice.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sidelines.operators import keyed
from sidelines.session import remove_folder, written

_LOG = "version long, kind string, part string, bucket int, path string, delivery string"
# What a version is: all of the table, new bases of some buckets, deltas. A shortened log begins with a mark.
_WHOLE, _BASE, _DELTA, _MARK = "whole", "base", "delta", "log"
_PART, _BUCKET = PLACE = "part_of_table", "bucket_of_part"
_VERSION, _GONE = "_version", "_gone"  # of a stored row
_ASIDE = "-"  # in place of a part: rows of a version's folder that are not in the table; no part has this name

Bucket = tuple[str, int]


@dataclass
class _Files:
    """Where the rows of a bucket are: a base, if there is one, and the deltas after it."""

    base: str | None = None
    deltas: list[str] = field(default_factory=list)

    def paths(self) -> list[str]:
        return [p for p in (self.base, *self.deltas) if p is not None]


def _all_nullable(schema: T.StructType) -> T.StructType:
    """What files can give back: also within structs and arrays nothing is known not to be null."""
    text = schema.json()
    for what in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{what}":false', f'"{what}":true')
    return T.StructType.fromJson(json.loads(text))


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str],
                 part: str = "'all'", buckets: int = 1, bucket_by: Sequence[str] | None = None):
        """``part`` is an SQL expression over the key columns; ``bucket_by`` are key columns (all, if left out)."""
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), _all_nullable(schema), list(keys)
        self.part = F.regexp_replace(F.coalesce(F.expr(part).cast("string"), F.lit("none")), "[^0-9A-Za-z]", "_")
        self.bucket = F.pmod(F.xxhash64(*(bucket_by or keys)), F.lit(buckets)).cast("int")
        self.stored = T.StructType([*self.schema.fields, T.StructField(_VERSION, T.LongType()), T.StructField(_GONE, T.BooleanType())])

    # --- the log ---

    def _entries(self) -> list[Row]:
        """The log: a row per write and bucket, from the last time it was shortened."""
        try:
            rows = self.spark.read.schema(f"{_LOG}, n long").parquet(f"{self.root}/versions").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        since = max((r["n"] for r in rows if r["kind"] == _MARK), default=0)
        return sorted((r for r in rows if r["n"] >= since), key=lambda r: (r["version"], r["kind"] == _MARK))

    @staticmethod
    def _files(entries: Iterable[Row]) -> dict[Bucket, _Files]:
        found: dict[Bucket, _Files] = defaultdict(_Files)
        for e in entries:
            if e["kind"] == _WHOLE and e["path"] is None:
                found.clear()
            if e["path"] is None:
                continue
            bucket = e["part"], e["bucket"]
            if e["kind"] == _DELTA:
                found[bucket].deltas.append(e["path"])
            else:
                found[bucket] = _Files(e["path"])
        return dict(found)

    def _next(self, entries: Sequence[Row]) -> int:
        return max((e["version"] for e in entries), default=0) + 1

    def _log(self, version: int, rows: Sequence[tuple]) -> None:
        self.spark.createDataFrame(list(rows), _LOG).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/versions/n={version}")

    def has_delivery(self, delivery: str) -> bool:
        return any(e["delivery"] == delivery for e in self._entries())

    # --- reading ---

    def read(self) -> DataFrame:
        entries = self._entries()
        return self._merged(self._files(entries).values(), entries)

    def holds_rows(self) -> bool:
        """Whether any rows have been stored, or have been taken out again and are not yet compacted."""
        return bool(self._files(self._entries()))

    def read_where(self, keys: DataFrame) -> DataFrame:
        """The rows of the buckets that ``keys`` (a few rows with the key columns) fall into."""
        return self._in(self._touched(keys))

    def keys_among(self, rows: DataFrame) -> DataFrame | None:
        """Those of ``rows``, which have the key columns, whose key is stored or has been; None of a table without files."""
        entries = self._entries()
        paths = [path for files in self._files(entries).values() for path in files.paths()]
        if not paths:
            return None
        return rows.join(self._files_at(self.stored, paths, entries).select(*self.keys).distinct(), self.keys, "left_semi")

    def _in(self, touched: set[Bucket]) -> DataFrame:
        entries = self._entries()
        return self._merged((files for bucket, files in self._files(entries).items() if bucket in touched), entries)

    def _touched(self, rows: DataFrame) -> set[Bucket]:
        return {(r[0], r[1]) for r in rows.select(self.part, self.bucket).distinct().collect()}

    def _files_at(self, schema: T.StructType, paths: Iterable[str], entries: Iterable[Row]) -> DataFrame:
        """The rows of these buckets. A part of a version that is wanted whole is one path: there is one to list for each."""
        wanted, parts = set(paths), defaultdict(set)
        for e in entries:
            if e["path"] is not None:
                parts[e["path"].rpartition("/")[0]].add(e["path"])
        whole = {part for part, there in parts.items() if there <= wanted}
        paths = sorted({part if (part := path.rpartition("/")[0]) in whole else path for path in wanted})
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def _merged(self, buckets: Iterable[_Files], entries: Iterable[Row] = ()) -> DataFrame:
        """The newest row of each key; buckets without deltas are read as they are."""
        plain, layered = [], []
        for files in buckets:
            if files.deltas:
                layered += files.paths()
            elif files.base is not None:
                plain.append(files.base)
        found = [self._files_at(self.schema, plain, entries)] if plain else []
        if layered:
            newest = keyed.first_per_key(self._files_at(self.stored, layered, entries), self.keys, [F.col(_VERSION).desc()])
            found.append(newest.filter(~F.col(_GONE)).select(*self.schema.names))
        if not found:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    # --- writing ---

    def _publish(self, rows: DataFrame, kind: str, delivery: str | None = None, gone: bool = False, unique: bool = False,
                 kept: str | None = None, told: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Write ``rows`` as a version and put it into the log; the rows of a bucket come together. Rows known to be ``unique``
        are the base of a bucket that has held nothing, so that reading it merges nothing. Returns the version's rows.

        With ``kept``, a condition, the rows lie by part and bucket already (see ``placed``). Those that it does not hold for are
        written beside the others, with the columns that only they need, and given to ``told`` before the version counts.
        """
        entries = self._entries()
        held = self._files(entries)
        version = self._next(entries)
        folder = f"{self.root}/v{version:06d}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in self.schema.fields]
        marks = [F.lit(version).cast("long").alias(_VERSION), F.lit(gone).alias(_GONE)]
        if kept is None:
            more = []
            stored = (rows.select(*columns).select("*", *marks, self.part.alias(_PART), self.bucket.alias(_BUCKET))
                      .hint("rebalance", F.col(_PART), F.col(_BUCKET)))
        else:
            more = [f for f in rows.schema.fields if f.name not in (*self.schema.names, _PART, _BUCKET)]
            # those aside in one file of a task
            place = [F.when(F.expr(kept), F.col(c)).otherwise(F.lit(other)).alias(c) for c, other in ((_PART, _ASIDE), (_BUCKET, 0))]
            stored = rows.select(*columns, *[f.name for f in more], *marks, *place)
        # a version without a row in the log is the rest of a failed attempt
        stored.write.mode("overwrite").partitionBy(_PART, _BUCKET).parquet(folder)
        layout = T.StructType([*self.stored.fields, *more, T.StructField(_PART, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])
        there = self.spark.read.schema(layout).parquet(folder)
        if told is not None:
            told(there.filter(F.col(_PART) == _ASIDE))
        places = {(found[1], int(found[2])) for found in (re.search(f"/{_PART}=([^/]*)/{_BUCKET}=([0-9]+)/[^/]*$", file)
                                                          for file in there.inputFiles()) if found and found[1] != _ASIDE}
        log = [(version, _BASE if unique and (part, bucket) not in held else kind, part, bucket, f"{folder}/{_PART}={part}/{_BUCKET}={bucket}", delivery)
               for part, bucket in sorted(places)]
        if kind == _WHOLE or not log:  # nothing of what was there before; a write without rows still counts as a version
            log.insert(0, (version, kind, None, None, None, delivery))
        self._log(version, log)
        return there.filter(F.col(_PART) != _ASIDE).select(*self.schema.names)

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have the columns that part and bucket follow from, with both, shuffled by them."""
        return rows.withColumns({_PART: self.part, _BUCKET: self.bucket}).repartition(_PART, _BUCKET)

    def lacks(self, rows: DataFrame) -> list[str]:
        """The columns that an upsert of ``rows`` would have to look up: those that they do not have, unless nothing is stored."""
        lacking = [name for name in self.schema.names if name not in rows.columns]
        return lacking if lacking and self.holds_rows() else []

    def upsert_placed(self, rows: DataFrame, kept: str, told: Callable[[DataFrame], None], delivery: str | None = None) -> DataFrame:
        """Upsert the ``placed`` rows that ``kept`` holds for, in the job that makes them; ``told`` gets the others, as written,
        before the upsert counts. The kept ones must be unique on the key, and lack nothing (see ``lacks``). Returns these."""
        return self._publish(rows, _DELTA, delivery, unique=True, kept=kept, told=told)

    def replace(self, df: DataFrame, delivery: str | None = None) -> None:
        self._publish(df, _WHOLE, delivery)

    def upsert(self, incoming: DataFrame, delivery: str | None = None, unique: bool = False) -> None:
        """Insert or overwrite by key. The incoming rows must be unique on the key; columns that they lack keep their value.
        With ``unique`` the caller has made sure of it, and a first write need not be merged when it is read."""
        lacking = self.lacks(incoming)
        if lacking:  # an empty table has no values to keep
            staged = written(incoming, "staged")
            held = self._in(self._touched(staged)).select(*self.keys, *lacking)
            incoming = staged.join(held, self.keys, "left")
        self._publish(incoming, _DELTA, delivery, unique=unique)

    def insert_if_absent(self, incoming: DataFrame, delivery: str | None = None) -> None:
        """Rows whose key is stored already are passed over; only the keys of the touched buckets are read."""
        staged = written(incoming, "staged")
        self._publish(keyed.absent_from(staged, self._in(self._touched(staged)), self.keys), _DELTA, delivery)

    def delete(self, keys: DataFrame, delivery: str | None = None) -> None:
        """Take out the rows of these keys."""
        self._publish(keys.select(*self.keys), _DELTA, delivery, gone=True)

    # --- upkeep ---

    def compact(self, most_deltas: int = 8) -> int:
        """Merge the buckets that have more deltas than this into new bases. Returns how many got one; a bucket whose rows
        are all gone gets none."""
        entries = self._entries()
        crowded = [f for f in self._files(entries).values() if len(f.deltas) > most_deltas]
        if not crowded:
            return 0
        self._publish(self._merged(crowded, entries), _BASE)
        entries = self._entries()
        return sum(e["version"] == entries[-1]["version"] and e["path"] is not None for e in entries)

    def vacuum(self, keep_versions: int = 1) -> list[str]:
        """Remove the folders that none of the newest ``keep_versions`` versions needs, and the log up to there.

        What a stream has delivered last stays known. Not while a job still reads an older version.
        """
        entries = self._entries()
        versions = sorted({e["version"] for e in entries})
        if not versions:
            return []
        oldest = versions[-min(keep_versions, len(versions))]
        base = [e for e in entries if e["version"] <= oldest]
        needed = {path for files in self._files(base).values() for path in files.paths()}
        kept = [e for e in base if e["path"] in needed] + [e for e in entries if e["version"] > oldest and e["kind"] != _MARK]
        folders = {path.split(f"/{_PART}=")[0] for path in (e["path"] for e in entries) if path}
        in_use = {e["path"].split(f"/{_PART}=")[0] for e in kept if e["path"]}
        deliveries = {}
        for e in entries:
            if e["delivery"]:
                deliveries[e["delivery"].rpartition("#")[0]] = e
        version = self._next(entries)
        columns = ("version", "kind", "part", "bucket", "path", "delivery")
        # the version before a kept one may have replaced the table: what is left begins from nothing
        log = [(version, _MARK, None, None, None, None), (0, _WHOLE, None, None, None, None)]
        log += [(0, _DELTA, None, None, None, e["delivery"]) for e in deliveries.values()]
        log += [tuple(e[c] for c in columns) for e in kept]
        self._log(version, log)
        for n in sorted({e["n"] for e in entries}):
            remove_folder(self.spark, f"{self.root}/versions/n={n}")
        gone = sorted(folders - in_use)
        for folder in gone:
            remove_folder(self.spark, folder)
        return gone
