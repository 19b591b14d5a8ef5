"""Near-duplicates among embeddings by an inverted multi-index.

The two halves of the unit vectors have a codebook each, and a cell is a pair of codewords. The cells nearest to a vector come in
the order of the multi-sequence algorithm: both lists of codewords, sorted by distance, are walked outward together. The walk ends where
the target recall is reached: at a distance that is measured on vectors turned by the largest angle that counts. Every
pair that a vector meets in these cells is verified by its cosine.

What is sent is a vector and, for each row of the grid that the walk touches, the cells to look into; it meets the vectors that live
in this row. Only cells before a vector's own are looked into, so that a pair meets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sidelines.llm.common import components
from sidelines.llm.vectors import entries
from sidelines.session import written

SAMPLE, SAMPLE_BYTES, TURNED, ROUNDS, SEED = 8192, 16 << 20, 2048, 12, 42
LEAST, POINTS = 4, 32  # codewords at least; vectors of the sample for each codeword at least
BLOCK = 512  # vectors that are compared at once
STAIRS = 1 << 21  # pairs of codewords whose distances are held at once


# --- the codebooks --------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Grid:
    """The codebooks of both halves, and how much farther than the nearest cell the walk goes (squared distances)."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How much farther than the nearest one the codewords of each half are from each vector."""
        half = self.first.shape[1]
        return _beyond_nearest(unit[:, :half], self.first), _beyond_nearest(unit[:, half:], self.second)

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = self.distances(unit)
        return first.argmin(axis=1), second.argmin(axis=1)

    def walk(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(vector, codeword of the first half, codeword of the second)`` for all cells within the reach.

        The two sorted lists give stairs: the farther out on the first, the fewer codewords of the second are left.
        """
        found = []
        step = max(1, STAIRS // (len(self.first) * len(self.second)))
        for at in range(0, len(unit), step):
            a, b = self.distances(unit[at:at + step])
            by_a, by_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
            a, b = np.take_along_axis(a, by_a, 1), np.take_along_axis(b, by_b, 1)
            wide, high = (max(1, int((x <= self.reach).sum(axis=1).max(initial=0))) for x in (a, b))
            row, i, j = np.nonzero(a[:, :wide, None] + b[:, None, :high] <= self.reach)
            found.append((row + at, by_a[row, i], by_b[row, j]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def _squares(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (words ** 2).sum(axis=1) - 2 * points @ words.T


def _beyond_nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    squares = _squares(points, words)
    return squares - squares.min(axis=1, keepdims=True)


def _codebook(points: np.ndarray, size: int, random: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm; codewords that no point is near are dropped."""
    if not points.shape[1]:  # half of a single entry
        return np.zeros((1, 0))
    distinct = np.unique(points, axis=0)
    words = distinct[random.permutation(len(distinct))[:size]]
    for _ in range(ROUNDS):
        nearest = _squares(points, words).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        words = sums[count > 0] / count[count > 0, None]
    return words


def fitted(sample: np.ndarray, codewords: int, least_cosine: float, recall: float) -> Grid:
    """Codebooks of a sample of unit vectors, and the reach at which the walk of a vector finds the cell of another one at
    the least cosine, in a random direction, with the probability ``recall``; nearer ones are found more often."""
    random = np.random.default_rng(SEED)
    half = sample.shape[1] // 2
    size = max(1, min(codewords, len(sample) // POINTS))
    grid = Grid(_codebook(sample[:, :half], size, random), _codebook(sample[:, half:], size, random), 0.0)
    if sample.shape[1] == 1:  # only one direction is near
        return grid
    unit = sample[random.integers(0, len(sample), TURNED)]
    aside = random.standard_normal(unit.shape)
    aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    first, second = grid.cells(least_cosine * unit + np.sqrt(max(0.0, 1 - least_cosine ** 2)) * aside)
    a, b = grid.distances(unit)
    rows = np.arange(len(unit))
    return Grid(grid.first, grid.second, float(np.quantile(a[rows, first] + b[rows, second], recall)))


# --- vectors as rows ------------------------------------------------------------------------------------------

def _kind(column: T.DataType) -> str:
    """How the entries are kept in binary: as they are, floats take half of the room."""
    return "<f4" if isinstance(column.elementType, T.FloatType) else "<f8"


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small or large entries would not fit
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _comparable(rows: DataFrame) -> DataFrame:
    """``rows(vec_id, embedding, label)`` with ``vector``: the entries in binary, null if it links with nothing."""
    kind = _kind(rows.schema["embedding"].dataType)
    size = np.dtype(kind).itemsize

    def run(batches):
        for batch in batches:
            good, start, end, flat = entries(batch.column("embedding"))
            nonzero = np.concatenate([[0], np.cumsum(flat != 0)])
            good &= nonzero[end] > nonzero[start]
            data = (flat + 0.0).astype(kind).tobytes()  # + 0.0: there is one zero
            vectors = [data[size * s:size * e] if g else None for g, s, e in zip(good, start, end)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.binary())],
                                             ["vec_id", "label", "vector"])

    schema = rows.select("vec_id", "label").schema.add("vector", "binary")
    return rows.select("vec_id", "label", "embedding").mapInArrow(run, schema)


def _of_lengths(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of a batch with vectors of one length (in bytes), as unit vectors, length by length."""
    vectors = batch.column("vector").to_pylist()
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        rows = np.nonzero(lengths == length)[0]
        yield int(length), rows, _unit([vectors[i] for i in rows], kind)


def _grids(classes: DataFrame, kind: str, rows_per_cell: int, least_cosine: float, recall: float) -> dict[int, Grid]:
    """A grid for each length of vectors, in bytes; the square of its side follows the largest label."""
    largest = (classes.groupBy("label", F.length("vector").alias("bytes")).agg(F.sum("copies").alias("n"))
               .groupBy("bytes").agg(F.max("n").alias("n")).collect())
    found = {}
    for length, n in largest:
        sample = (classes.filter(F.length("vector") == length).select("vector", F.xxhash64("vector").alias("at"))
                  .orderBy("at", "vector").limit(min(SAMPLE, max(256, SAMPLE_BYTES // length))).collect())
        codewords = max(LEAST, int(np.ceil(np.sqrt(n / rows_per_cell))))
        found[length] = fitted(_unit([bytes(r["vector"]) for r in sample], kind), codewords, least_cosine, recall)
    return found


# --- links ----------------------------------------------------------------------------------------------------

class _Residents:
    """The vectors that live in one row of the grid (or in one of its chunks), by cell, against those that look in."""

    def __init__(self, least_cosine: float):
        self.least, self.parts = least_cosine, []

    def add(self, node: np.ndarray, copies: np.ndarray, cell: np.ndarray, looks: list[list[int]], unit: np.ndarray) -> None:
        self.parts.append((node, copies, cell, looks, unit))

    def settle(self) -> tuple[np.ndarray, ...]:
        """All residents are there: what links them with each other, within a cell and with the cells before it."""
        node, copies, cell, unit = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1, 2, 4))
        looks = [x for p in self.parts for x in p[3]]
        order = np.argsort(cell, kind="stable")
        self.node, self.copies, self.unit, cell = node[order], copies[order], unit[order], cell[order]
        self.cells, starts = np.unique(cell, return_index=True)
        self.span = {int(c): (int(s), int(e)) for c, s, e in zip(self.cells, starts, [*starts[1:], len(cell)])}
        self.root, self.links = np.arange(len(cell)), np.zeros(len(cell), np.int64)
        for start, end in self.span.values():
            for i in range(start, end, BLOCK):
                stop = min(i + BLOCK, end)
                # those before the block and its own, of which each pair is seen twice
                near = self.unit[i:stop] @ self.unit[start:stop].T >= self.least
                near[:, i - start:] &= np.tri(stop - i, stop - i, -1, bool)
                a, b = np.nonzero(near)
                self._count(a + i, b + start)
                self._unite(a + i, b + start)
        looks = [looks[i] for i in order]
        for i, j in self._met(looks, self.unit):
            self._count(i, j)
            self._unite(i, j)
        return self.node, self.copies

    def _count(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.links, a, self.copies[b])
        np.add.at(self.links, b, self.copies[a])

    def _met(self, looks: list[list[int]], unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (one that looks, resident) that are near, cell by cell and block by block."""
        by_cell: dict[int, list[int]] = {}
        for i, cells in enumerate(looks):
            for cell in cells:
                if cell in self.span:
                    by_cell.setdefault(cell, []).append(i)
        for cell, rows in by_cell.items():
            start, end = self.span[cell]
            for at in range(0, len(rows), BLOCK):
                some = np.array(rows[at:at + BLOCK])
                for home in range(start, end, 4 * BLOCK):
                    stop = min(home + 4 * BLOCK, end)
                    a, b = np.nonzero(unit[some] @ self.unit[home:stop].T >= self.least)
                    if len(a):
                        yield some[a], b + home

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of residents a and b; a set is named by its smallest position."""
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

    def pass_by(self, node: np.ndarray, copies: np.ndarray, looks: list[list[int]], unit: np.ndarray) -> pa.RecordBatch:
        """What links those that look in with residents: their counts, and one link each, whose residents are joined."""
        counts = np.zeros(len(node), np.int64)
        first = np.full(len(node), -1)
        for i, j in self._met(looks, unit):
            np.add.at(counts, i, self.copies[j])
            np.add.at(self.links, j, copies[i])
            seen, at = np.unique(i, return_index=True)
            new = first[seen] < 0
            first[seen[new]] = j[at[new]]
            self._unite(first[i], j)
        met = np.nonzero(counts)[0]
        return _batch(node[met], self.node[first[met]], counts[met])

    def results(self) -> pa.RecordBatch:
        met = np.nonzero(self.links)[0]
        return _batch(self.node[met], self.node[self.root[met]], self.links[met])


def _batch(node: np.ndarray, other: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (node, other, links)], ["a", "b", "n_links"])


def _homes_and_looks(classes: DataFrame, kind: str, grids: dict[int, Grid]) -> DataFrame:
    """A row for each class and row of the grid that its walk touches, up to its own: ``looks`` are the cells before its
    own; ``cell`` is its own in the row where it lives, else null."""
    def run(batches):
        for batch in batches:
            for length, rows, unit in _of_lengths(batch, kind):
                grid = grids[length]
                home, cell = grid.cells(unit)
                who, i, j = grid.walk(unit)
                before = (i < home[who]) | ((i == home[who]) & (j < cell[who]))
                all_rows = np.arange(len(rows))
                # its own row has an entry even where no cell before its own is near
                who, i, j = (np.concatenate(x) for x in ((all_rows, who[before]), (home, i[before]),
                                                         (np.full(len(rows), -1), j[before])))
                order = np.lexsort((j, i, who))
                who, i, j = who[order], i[order], j[order]
                start = np.nonzero(np.r_[True, (who[1:] != who[:-1]) | (i[1:] != i[:-1])])[0]
                sent, at = who[start], i[start]
                own, keep = j[start] < 0, j >= 0
                size = np.add.reduceat(keep.astype(np.int32), start)
                looks = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)),
                                                 pa.array(j[keep].astype(np.int32)))
                taken = pa.array(rows[sent])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(taken) for c in ("node", "label", "copies", "vector")]
                    + [pa.array(at.astype(np.int32)), pa.array(cell[sent].astype(np.int32), mask=~own), looks],
                    ["node", "label", "copies", "vector", "line", "cell", "looks"])

    kept = classes.select("node", "label", "copies", "vector")
    schema = T.StructType([*kept.schema.fields, T.StructField("line", T.IntegerType()), T.StructField("cell", T.IntegerType()),
                           T.StructField("looks", T.ArrayType(T.IntegerType()))])
    return kept.mapInArrow(run, schema)


def links(classes: DataFrame, kind: str, grids: dict[int, Grid], least_cosine: float = 0.93, chunk_rows: int = 50_000) -> DataFrame:
    """``(a, b, n_links)`` over ``classes(node, label, copies, vector)``, vectors in binary of a numpy ``kind``: the links a -> b
    connect what all pairs found do, and the sum of ``n_links`` over a is how many vectors of other classes it is linked with.

    A task keeps the vectors that live in one row of the grid, for one label and length of vectors, and streams those that look in. A row
    with more than ``chunk_rows`` is cut into chunks by hash; its vectors look into each other's chunks like
    strangers. At most one link is given for each row that a task reads.
    """
    sent = _homes_and_looks(classes, kind, grids).withColumn("bytes", F.length("vector"))
    place = ["label", "bytes", "line"]
    counts = (sent.filter("cell is not null").groupBy(*place)
              .agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks")))
    sent = sent.join(counts, place).withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    chunked = sent.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    at_home = F.col("cell").isNotNull() & (F.col("chunk") == F.col("own"))
    # a resident looks into its own cell too where that is in a chunk before its own
    back = F.col("cell").isNotNull() & (F.col("chunk") < F.col("own"))
    looks = F.when(back, F.array_append("looks", F.col("cell"))).otherwise(F.col("looks"))
    rows = (chunked.select(*place, "chunk", (~at_home).cast("int").alias("passes"), "node", "copies", "vector", "cell",
                           looks.alias("looks"))
            .filter("passes = 0 or size(looks) > 0").repartition(*place, "chunk")
            .sortWithinPartitions(*place, "chunk", "passes"))
    return rows.mapInArrow(_compared(kind, least_cosine), "a long, b long, n_links long")


def _compared(kind: str, least_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at, settled = None, None, False
        for batch in batches:
            keys = [batch.column(c).to_pylist() for c in ("label", "bytes", "line", "chunk")]
            places = list(zip(*keys))
            passes = batch.column("passes").to_pylist()
            cuts = [0, *(i for i in range(1, len(places)) if places[i] != places[i - 1] or passes[i] != passes[i - 1]), len(places)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if places[start] != at:
                    if here is not None:
                        if not settled:
                            here.settle()
                        yield here.results()
                    here, at, settled = None, places[start], False
                part = batch.slice(start, end - start)
                node, copies = (part.column(c).to_numpy() for c in ("node", "copies"))
                looks, unit = part.column("looks").to_pylist(), _unit(part.column("vector").to_pylist(), kind)
                if not passes[start]:
                    if here is None:
                        here = _Residents(least_cosine)
                    here.add(node, copies, part.column("cell").to_numpy(zero_copy_only=False).astype(np.int64), looks, unit)
                elif here is not None:  # else the hash put nobody into this chunk
                    if not settled:
                        here.settle()
                        settled = True
                    yield here.pass_by(node, copies, looks, unit)
        if here is not None:
            if not settled:
                here.settle()
            yield here.results()

    return run


def near_duplicates(embeddings: DataFrame, least_cosine: float = 0.93, recall: float = 0.99, rows_per_cell: int = 1024,
                    chunk_rows: int = 50_000) -> DataFrame:
    """Every row of ``embeddings(vec_id, embedding, label)``: vec_id, n_links (other vectors of its label whose cosine
    is ``least_cosine`` or more), component_id (the smallest vec_id that links reach) and kept (vec_id = component_id).

    Links are found with the probability ``recall`` or more (see ``fitted``, which looks at up to 8,192 vectors or 16 MB
    of a length; all vectors are indexed), and none is false. Equal vectors of a label are always linked. Vectors that are null, empty, zero or hold a null or
    non-finite entry, and those without a label, link with nothing; vectors of different lengths have no cosine. Repeated
    rows are vectors like any other. A null vec_id is never the smallest unless all of a component are null; null equals
    null in ``kept``. Classes of equal vectors are known by their label and 128 bits of hash. Other columns are ignored.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"),
                             F.col("label").alias("label"))
    ready = _comparable(rows)
    marked = ready.select("vec_id", "label", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    comparable = F.col("vector").isNotNull() & F.col("label").isNotNull()
    classes = (marked.filter(comparable).groupBy("label", "h1", "h2")
               .agg(F.any_value("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("first"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = written(classes, "vector-classes")
    kind = _kind(rows.schema["embedding"].dataType)
    grids = _grids(classes, kind, rows_per_cell, least_cosine, recall)
    found = written(links(classes, kind, grids, least_cosine, chunk_rows), "vector-links")
    roots = components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n_links").alias("others"))
    known = (classes.select("label", "h1", "h2", "copies", "first", "node")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
             .join(counts, F.col("node") == F.col("a"), "left"))
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = written(known.join(smallest, "root").select(
        "label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "vectors-known")
    linked = marked.filter(comparable).select("vec_id", "label", "h1", "h2").join(known, ["label", "h1", "h2"])
    alone = marked.filter(~comparable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = linked.select("vec_id", "n_links", "component_id").union(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
