"""Near-duplicates by SimHash, compared exactly in tiles of fingerprints with equal population counts.

A tile holds the fingerprints whose four quarters have the same population counts. Two fingerprints within the radius
differ in these counts by no more than the radius altogether, so only neighbouring tiles are compared, with numpy's
exclusive-or and bit counts over blocks; all other pairs of tiles are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sidelines.llm.common import beside_row, components, quoted, row_with
from sidelines.session import written

QUARTERS, BITS = 4, 16
LEVELS = BITS + 1
SEED = 42
STEP = 512  # texts in memory as Python's own at a time
_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each set if it is in over half of the shingles' XXH64; 0 without a word."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and the white space of ASCII
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(s), SEED) for s in zip(*[words[i:] for i in range(shingle)])), "<u8", n)
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_byte[:, i], minlength=256) @ _BIT for i in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(rows: DataFrame, text: str, shingle: int = 3) -> DataFrame:
    """``rows`` without the text column, with ``fp``: the fingerprint as a signed long."""
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t for i in range(0, len(batch), STEP) for t in batch.column(text).slice(i, STEP).to_pylist())
            found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(batch))
            columns = [batch.column(c) for c in kept] + [pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "fp"])

    schema = rows.select(*kept).schema.add("fp", "long")
    return rows.mapInArrow(run, schema)


def _levels(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, BITS * i).bitwiseAND(F.lit(0xFFFF))) for i in range(QUARTERS)]


def _tile(levels: list[Column]) -> Column:
    return sum((level * LEVELS ** i for i, level in enumerate(levels[1:], 1)), levels[0])


def _smaller_neighbours(levels: list[Column], radius: int) -> Column:
    """The tiles before this one whose population counts differ by the radius or less altogether."""
    found = []
    for step in product(range(-radius, radius + 1), repeat=QUARTERS):
        delta = sum(s * LEVELS ** i for i, s in enumerate(step))
        if delta < 0 and sum(map(abs, step)) <= radius:
            inside = F.lit(True)
            for level, s in zip(levels, step):
                if s:
                    inside &= (level + s).between(0, BITS)
            found.append(F.when(inside, _tile(levels) + delta))
    return F.array_compact(F.array(*found))


class _Home:
    """A tile's fingerprints, kept, against those that stream past; links enough to connect all that are near."""

    ROWS, COLUMNS = 256, 1024

    def __init__(self, radius: int):
        self.radius, self.parts, self.fps = radius, [], None

    def add(self, fps: np.ndarray) -> None:
        self.parts.append(fps)

    def settle(self) -> None:
        """All of the tile's own are there: they are sorted by population count and linked with each other."""
        if self.fps is None:
            self.fps = self._sorted(np.concatenate(self.parts) if self.parts else np.empty(0, np.uint64))
            self.root = np.arange(len(self.fps))
            for i in range(0, len(self.fps), self.COLUMNS):
                own, other = self._near(self.fps[i:i + self.COLUMNS])
                self._unite(own, other + i)

    def _sorted(self, fps: np.ndarray) -> np.ndarray:
        return fps[np.argsort(np.bitwise_count(fps), kind="stable")]

    def _near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of pairs within the radius, among the tile's own and in ``fps`` (sorted), block by block."""
        own, other = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        low, high = (int(x) for x in np.bitwise_count(fps[[0, -1]]))
        for i in range(0, len(self.fps), self.ROWS):
            block = self.fps[i:i + self.ROWS]
            least, most = (int(x) for x in np.bitwise_count(block[[0, -1]]))
            if least > high + self.radius or most < low - self.radius:
                continue  # the population counts differ too much in every pair
            a, b = np.nonzero(np.bitwise_count(block[:, None] ^ fps[None, :]) <= self.radius)
            own.append(a + i)
            other.append(b)
        return np.concatenate(own), np.concatenate(other)

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of a and b; every set is named by its smallest position."""
        root = self.root
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root[:] = root[root]

    def pass_by(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One link for each of ``fps`` that is near one of the tile's own, whose sets are joined."""
        fps = self._sorted(fps)
        ends = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for i in range(0, len(fps), self.COLUMNS):
            own, other = self._near(fps[i:i + self.COLUMNS])
            if len(own):
                seen, first = np.unique(other, return_index=True)
                of = np.zeros(self.COLUMNS, np.int64)
                of[seen] = own[first]
                self._unite(of[other], own)
                ends[0].append(fps[i + seen])
                ends[1].append(self.fps[of[seen]])
        return np.concatenate(ends[0]), np.concatenate(ends[1])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        child = np.nonzero(self.root != np.arange(len(self.root)))[0]
        return self.fps[child], self.fps[self.root[child]]


def links(fps: DataFrame, radius: int = 2, tile_rows: int = 50_000) -> DataFrame:
    """``(a, b)``: links that connect the same distinct ``fps(fp)`` as all pairs within the radius do.

    Every tile is the home of its fingerprints, and each fingerprint is also sent past the neighbouring tiles before its
    own. A tile of more than ``tile_rows`` is cut into chunks, each a home. A task keeps one chunk and streams the rest, sorted
    by home; it gives at most one link for each row that it reads. There are at most 17 ** 4 tiles: their counts are
    the only thing that is broadcast.
    """
    tiled = fps.select("fp", _tile(_levels(F.col("fp"))).alias("tile"))
    counts = F.broadcast(tiled.groupBy("tile").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks")))
    own = (tiled.join(counts, "tile")
           .select("fp", "tile", F.pmod(F.xxhash64("fp"), "chunks").cast("int").alias("chunk")))
    at_home = own.select("tile", "chunk", F.lit(0).alias("passes"), "fp")
    before = own.filter("chunk > 0").select("tile", F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("chunk"),
                                            F.lit(1).alias("passes"), "fp")
    others = (fps.select("fp", F.explode(_smaller_neighbours(_levels(F.col("fp")), radius)).alias("tile"))
              .join(counts, "tile")
              .select("tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                      F.lit(1).alias("passes"), "fp"))
    rows = (at_home.union(before).union(others).repartition("tile", "chunk")
            .sortWithinPartitions("tile", "chunk", "passes"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)) for f in found], ["a", "b"])

        home, at = _Home(radius), None
        for batch in batches:
            tile, chunk, passes, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fp = fp.view(np.uint64)
            key = np.stack([tile, chunk, passes])
            cuts = [0, *(np.nonzero((key[:, 1:] != key[:, :-1]).any(axis=0))[0] + 1), len(fp)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if (tile[start], chunk[start]) != at:
                    home.settle()
                    yield pairs(home.links())
                    home, at = _Home(radius), (tile[start], chunk[start])
                if not passes[start]:
                    home.add(fp[start:end])
                else:
                    home.settle()
                    if len(home.fps):
                        yield pairs(home.pass_by(fp[start:end]))
        home.settle()
        yield pairs(home.links())

    return rows.mapInArrow(compare, "a long, b long")


def _classes(fps: DataFrame, radius: int) -> DataFrame:
    """``fps(doc_id, fp)`` to ``(fp, root, component_id)``, a row per distinct fingerprint."""
    firsts = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(firsts.select("fp"), radius))
    linked = firsts.join(roots, firsts["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return linked.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Every row of ``documents(doc_id, text)`` with its fingerprint and the smallest doc_id it is linked to.

    Links are fingerprints that differ in at most ``radius`` bits, over all documents, and reach on through others. A null
    text or one without a word has the fingerprint zero and is linked like any other. A null doc_id is never the
    smallest, unless all of a component are null. Repeated rows stay; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    fps = written(with_fingerprints(rows, "text", shingle), "documents-fp")
    found = fps.join(_classes(fps, radius), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``documents``, all columns, with one row of each component: that of the smallest doc_id (nulls last).

    Of several rows with that doc_id the one with the least hash stays, and of wholly equal rows one.
    """
    columns = documents.columns
    whole = beside_row(documents, _doc_id=F.col("doc_id"), _text=F.col("text"),
                       _tag=F.xxhash64(*[F.col(quoted(c)) for c in columns]))
    fps = written(with_fingerprints(whole.select("_doc_id", "_tag", "_text"), "_text", shingle), "documents-fp")
    classes = _classes(fps.select(F.col("_doc_id").alias("doc_id"), "fp"), radius)
    first = F.min(F.struct(F.col("_doc_id").isNull().alias("no_id"), "_doc_id", "_tag")).alias("first")
    winners = written(fps.join(classes, "fp").groupBy("root").agg(first).select("first._doc_id", "first._tag"), "winners")
    same = whole["_doc_id"].eqNullSafe(winners["_doc_id"]) & (whole["_tag"] == winners["_tag"])
    kept = whole.drop("_text").join(winners, same, "left_semi")
    rank = F.row_number().over(Window.partitionBy("_doc_id", "_tag").orderBy(F.lit(0)))
    return row_with(kept.withColumn("_rank", rank).filter("_rank = 1"), columns)
