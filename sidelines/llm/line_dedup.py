"""Reversible line dedup: exact counts of the documents that hold a line, with sharded cuckoo filters before them.

An index is a folder with three tables, to which every insertion and deletion of documents appends:

* ``postings``: one row per line key and document, taken back by a row with the opposite sign;
* ``refs``: how many documents hold a key, and the smallest of them; the row of the last batch counts;
* ``filters``: a cuckoo filter over the keys of each shard. What a filter has not seen is new for certain; only the
  other keys are looked up in the exact tables. Shards multiply as the keys do.

A batch counts once its row in ``log`` is written, so that one that broke off leaves no trace.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, row_with
from sidelines.llm.cuckoo import CuckooFilter
from sidelines.session import written

POSTINGS = "k1 long, k2 long, doc_id long, n_lines long, sign int, batch int"
REFS = "k1 long, k2 long, n_docs long, first_doc long, batch int"
FILTERS = "shard int, layer int, slots binary, batch int"
LOG = "kind string, shards int, keys long, batch int"
KEYS_PER_SHARD = 500_000
STEP = 512  # documents whose lines are in memory at a time
KEY = ["k1", "k2"]


def line_key(line: str, min_chars: int) -> bytes | None:
    """128 bits for a line without white space at its ends and with A-Z in lower case; None for a short one."""
    key = line.encode().strip().lower()  # on bytes: ASCII only
    if len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(documents: DataFrame, min_chars: int) -> DataFrame:
    """``(k1, k2, doc_id, n_lines)``: the keys of every row's lines; rows with a null doc_id have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, STEP) for b in batches for i in range(0, len(b), STEP)):
            keys, docs, counts = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if doc_id is None or not text:
                    continue
                own: dict[bytes, int] = {}
                for line in text.split("\n"):
                    key = line_key(line, min_chars)
                    if key:
                        own[key] = own.get(key, 0) + 1
                keys += own
                docs += [doc_id] * len(own)
                counts += own.values()
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(docs, pa.int64()),
                                              pa.array(counts, pa.int64())], ["k1", "k2", "doc_id", "n_lines"])

    return documents.select("doc_id", "text").mapInArrow(run, "k1 long, k2 long, doc_id long, n_lines long")


class LineIndex:
    """The index in ``folder``; ``insert`` and ``delete`` write a batch each, ``clean`` removes repeated lines."""

    def __init__(self, spark: SparkSession, folder: str, min_chars: int = 10):
        self.spark, self.folder, self.min_chars = spark, folder, min_chars
        self.kinds: list[str] = []
        self.shards = self.keys = 0
        self.since = 0  # the batch from which on there are that many shards

    @classmethod
    def open(cls, spark: SparkSession, folder: str, min_chars: int = 10) -> LineIndex:
        """An index that was written before."""
        index = cls(spark, folder, min_chars)
        log = spark.read.schema(LOG).parquet(f"{folder}/log").orderBy("batch").collect()  # a row per batch
        index.kinds, index.shards, index.keys = [row["kind"] for row in log], log[-1]["shards"], log[-1]["keys"]
        index.since = next(i for i, row in enumerate(log) if row["shards"] == index.shards)
        return index

    def _table(self, name: str, schema: str) -> DataFrame:
        """What finished batches wrote."""
        if not self.kinds:
            return self.spark.createDataFrame([], schema)
        base = f"{self.folder}/{name}"
        paths = [f"{base}/batch={i}" for i in range(len(self.kinds))]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _write(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}/batch={len(self.kinds)}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _finish(self, kind: str) -> None:
        row = self.spark.createDataFrame([(kind, self.shards, self.keys)], "kind string, shards int, keys long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/log/batch={len(self.kinds)}")
        self.kinds.append(kind)

    def postings(self) -> DataFrame:
        """``(k1, k2, doc_id)`` of the documents that are in the index."""
        rows = self._table("postings", POSTINGS)
        if "delete" in self.kinds:
            rows = rows.groupBy(*KEY, "doc_id").agg(F.sum("sign").alias("held")).filter("held > 0")
        return rows.select(*KEY, "doc_id")

    def refs(self) -> DataFrame:
        """``(k1, k2, n_docs, first_doc)`` of the keys that are in the index."""
        rows = self._table("refs", REFS)
        if len(self.kinds) > 1:
            last = F.max(F.struct("batch", "n_docs", "first_doc")).alias("last")
            rows = rows.groupBy(*KEY).agg(last).select(*KEY, "last.n_docs", "last.first_doc")
        return rows.select(*KEY, "n_docs", "first_doc").filter("n_docs > 0")

    def _shard(self) -> Column:
        return F.pmod(F.col("k1"), F.lit(self.shards)).cast("int").alias("shard")

    def _filters(self) -> DataFrame:
        """The filters after the last batch: each batch writes all layers of the shards that it touched."""
        rows = self._table("filters", FILTERS).filter(F.col("batch") >= self.since)
        newest = rows.groupBy("shard").agg(F.max("batch").alias("batch"))
        return rows.join(newest, ["shard", "batch"]).select("shard", "layer", "slots")

    def maybe_held(self, keys: DataFrame) -> DataFrame:
        """The ``(k1, k2)`` that the filters may have seen; the others are certainly not in the index."""

        def probe(keys: pa.Table, layers: pa.Table) -> pa.Table:
            seen = _filter_of(layers).contains(*_key_arrays(keys))
            return keys.select(KEY).filter(pa.array(seen))

        return (keys.select(*KEY, self._shard()).groupBy("shard")
                .cogroup(self._filters().groupBy("shard")).applyInArrow(probe, "k1 long, k2 long"))

    def _update_filters(self, keys: DataFrame, delete: bool = False) -> None:
        """Write the filters of the shards that ``keys`` (each once) touch, with these keys put in or taken out."""
        def change(keys: pa.Table, layers: pa.Table) -> pa.Table:
            held = _filter_of(layers)
            if keys.num_rows:
                (held.delete if delete else held.insert)(*_key_arrays(keys))
            tables = held.to_bytes() if keys.num_rows else []
            shard = keys["shard"][0].as_py() if keys.num_rows else 0
            return pa.table({"shard": pa.array([shard] * len(tables), pa.int32()),
                             "layer": pa.array(range(len(tables)), pa.int32()), "slots": pa.array(tables, pa.binary())})

        rows = (keys.select(*KEY, self._shard()).groupBy("shard")
                .cogroup(self._filters().groupBy("shard")).applyInArrow(change, "shard int, layer int, slots binary"))
        self._write(rows, "filters")

    def _grow(self, fresh: DataFrame) -> bool:
        """Take ``fresh`` keys into account. Where a shard would hold more than ``KEYS_PER_SHARD``, all keys, which the exact
        tables have, go into the filters of more shards: a task holds a shard's keys and filter."""
        self.keys += fresh.count()
        needed = -(-self.keys // KEYS_PER_SHARD)
        if needed <= self.shards:
            return False
        everything = self.refs().select(*KEY).union(fresh.select(*KEY))
        self.shards, self.since = max(64, needed, 2 * self.shards), len(self.kinds)
        self._update_filters(everything)
        return True

    def insert(self, documents: DataFrame) -> None:
        """Take in the lines of ``documents(doc_id, text)``. Documents that are in the index already are passed over (delete
        them first); rows of the same doc_id are one document; a null doc_id or text has no lines that count."""
        new = line_keys(documents, self.min_chars)
        if self.kinds:
            new = new.join(self.postings().select("doc_id").distinct(), "doc_id", "left_anti")
        new = new.groupBy(*KEY, "doc_id").agg(F.sum("n_lines").alias("n_lines"))
        postings = self._write(new.select("*", F.lit(1).alias("sign")), "postings")
        counts = postings.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
        if not self.kinds:
            fresh = self._write(counts, "refs")
            self.shards = 64
        else:
            counts = written(counts, "line-counts")
            hits = self.maybe_held(counts)
            held = self.refs().join(hits, KEY, "left_semi").select(
                *KEY, F.col("n_docs").alias("held_docs"), F.col("first_doc").alias("held_first"))
            held = written(held, "held-lines")
            added = counts.join(held, KEY, "left").select(
                *KEY, (F.col("n_docs") + F.coalesce("held_docs", F.lit(0))).alias("n_docs"),
                F.least("first_doc", "held_first").alias("first_doc"))
            self._write(added, "refs")
            fresh = counts.join(held, KEY, "left_anti")
        if not self._grow(fresh):
            self._update_filters(fresh)
        self._finish("insert")

    def delete(self, doc_ids: DataFrame) -> None:
        """Take the documents of ``doc_ids(doc_id)`` out again, as if they had never been inserted."""
        gone = self._table("postings", POSTINGS).groupBy(*KEY, "doc_id").agg(
            F.sum("sign").alias("held"), F.max("n_lines").alias("n_lines")).filter("held > 0")
        gone = gone.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")
        gone = self._write(gone.select(*KEY, "doc_id", "n_lines", F.lit(-1).alias("sign")), "postings")
        touched = gone.select(*KEY).distinct()
        left = (self.postings().join(gone, [*KEY, "doc_id"], "left_anti").join(touched, KEY, "left_semi")
                .groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")))
        refs = touched.join(left, KEY, "left").select(*KEY, F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "first_doc")
        refs = self._write(refs, "refs").filter("n_docs = 0")
        self.keys -= refs.count()
        self._update_filters(refs, delete=True)
        self._finish("delete")

    def repeated(self) -> DataFrame:
        """``(doc_id, keys)``: for each document the keys of lines that a smaller doc_id holds too.

        The shared keys are written first: the join then reads both sides as they were dealt out, so that adaptive
        execution can split a line that very many documents hold.
        """
        shared = written(self.refs().filter("n_docs > 1"), "shared-lines")
        return (self.postings().join(shared, KEY).filter("doc_id <> first_doc")
                .groupBy("doc_id").agg(F.collect_list(F.struct(*KEY)).alias("keys")))

    def clean(self, documents: DataFrame) -> DataFrame:
        """``documents`` without the lines that a smaller doc_id in the index holds, and ``n_lines``, ``n_dropped``.

        A line is compared without white space at its ends and with A-Z in lower case; keys of fewer than ``min_chars``
        characters never count. A document's own repeats stay if it is the smallest that holds them. A null or empty
        text is one empty line, a null stays null, and a null doc_id keeps all its lines. All rows and other columns stay.
        """
        min_chars = self.min_chars

        def some_kept(texts: pa.Array, keys: pa.Array) -> pa.Array:
            found = [], [], []
            for text, own in zip(texts.to_pylist(), keys):
                n, dropped = (text or "").count("\n") + 1, 0
                if text and own.is_valid:
                    pairs = np.stack([own.values.field(k).to_numpy() for k in KEY], axis=1).astype("<i8")
                    gone = set(pairs.view("V16").ravel().tolist())
                    left = [line for line in text.split("\n") if line_key(line, min_chars) not in gone]
                    text, dropped = "\n".join(left), n - len(left)
                for column, value in zip(found, (text, n, dropped)):
                    column.append(value)
            return pa.StructArray.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.int64()),
                                               pa.array(found[2], pa.int64())], ["text", "n_lines", "n_dropped"])

        @F.arrow_udf("text string, n_lines long, n_dropped long")
        def kept(texts: pa.Array, keys: pa.Array) -> pa.Array:
            parts = [some_kept(texts.slice(i, STEP), keys.slice(i, STEP)) for i in range(0, max(len(texts), 1), STEP)]
            return pa.concat_arrays(parts)

        rows = beside_row(documents, _doc_id=F.col("doc_id"), _text=F.col("text"))
        gone = self.repeated().withColumnRenamed("doc_id", "of")
        rows = rows.join(gone, F.col("_doc_id") == F.col("of"), "left").withColumn("_kept", kept("_text", "keys"))
        return row_with(rows, documents.columns, text=F.col("_kept.text"), n_lines=F.col("_kept.n_lines"),
                        n_dropped=F.col("_kept.n_dropped"))


def _filter_of(layers: pa.Table) -> CuckooFilter:
    return CuckooFilter.from_bytes([r["slots"] for r in sorted(layers.to_pylist(), key=lambda r: r["layer"])])


def _key_arrays(keys: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return keys["k1"].to_numpy(), keys["k2"].to_numpy()
