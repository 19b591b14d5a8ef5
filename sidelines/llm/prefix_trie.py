"""The trie of conversations that begin alike, with totals over subtrees by centroid decomposition.

A node is a distinct sequence of first turns, known by two 64-bit hashes that every turn and its place are exclusive-or'ed into, so
that a prefix of any length is a running value and its parent is the value before.

Totals over subtrees: the mass of a node (turns at or below it, repeated ones counted) is known from its members alone. Where it is
at most ``light``, a task takes the whole subtree and splits it at centroids: the total below a centroid is added along the path
from it to the top, then what lies above it and below it is split on. The nodes above, of more mass, are few paths, as each of their
ends has its own ``light`` of mass: they are cut into pieces of a path, the tree of pieces is totalled first, and then every
piece. ``light`` follows the root of the whole mass, so that neither a subtree nor the tree of pieces is more than some
roots of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sidelines.operators.ranking import row_index
from sidelines.session import written

SHARERS, MOST_SHARED = 20, 4  # conversations that may share their first turns; fewer turns than this
ROOTS = 4  # ``light``, in square roots of the whole mass
STRETCH = 4096  # turns of a conversation that a task sorts
WORD = r"[^\x20\x09-\x0D]+"
_NODE, _PARENT = ["p1", "p2"], ["u1", "u2"]


# --- centroids ------------------------------------------------------------------------------------------------

def centroid_totals(parent: Sequence[int], values: np.ndarray) -> np.ndarray:
    """For each node of a forest the sum of ``values`` (a row each) over its subtree; a top's parent is -1.

    Every component is split at its centroid, the lowest node that has more than half of the component at or below it. What that
    centroid has below it, in the component, counts for all nodes on its path to the component's top. Each part
    has at most half of the nodes, so that a node is met no more often than the logarithm of the component's size.
    """
    children: list[list[int]] = [[] for _ in parent]
    components = []
    for node, above in enumerate(parent):
        (components if above < 0 else children[above]).append(node)
    totals, cut, size = np.zeros_like(values), [False] * len(parent), [1] * len(parent)

    def below(top: int) -> list[int]:
        found = [top]
        for node in found:
            found += [c for c in children[node] if not cut[c]]
        return found

    while components:
        top = components.pop()
        nodes = below(top)
        if len(nodes) == 1:
            totals[top] += values[top]
            continue
        for node in nodes:
            size[node] = 1
        for node in reversed(nodes[1:]):
            size[parent[node]] += size[node]
        path, centroid = [top], top
        while (lower := next((c for c in children[centroid] if not cut[c] and 2 * size[c] > len(nodes)), None)) is not None:
            path.append(lower)
            centroid = lower
        totals[path] += values[nodes if centroid == top else below(centroid)].sum(axis=0)
        cut[centroid] = True
        components += [c for c in children[centroid] if not cut[c]]
        if centroid != top:
            components.append(top)
    return totals


_FOREST = "p1 long, p2 long, u1 long, u2 long, top boolean, leaves long, saved long"


def _totalled(rows: DataFrame, fragment: Sequence[Column]) -> DataFrame:
    """``rows(p1, p2, u1, u2, leaves, saved)``, nodes and their parents, with the totals within each fragment, of which a task holds one.
    ``top`` tells the nodes whose parent is in no fragment or another one."""
    keys = [f"_f{i}" for i in range(len(fragment))]
    placed = (rows.select(*[c.alias(k) for c, k in zip(fragment, keys)], *_NODE, *_PARENT, "leaves", "saved")
              .repartition(*keys).sortWithinPartitions(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            of = [rows.column(k).to_numpy() for k in keys]
            changes = np.nonzero(np.any([k[1:] != k[:-1] for k in of], axis=0))[0]
            whole = int(changes[-1]) + 1 if len(changes) else 0  # the last fragment may go on in the next batch
            if whole:
                yield totals(rows.slice(0, whole))
            held = rows.slice(whole)
        if held is not None and held.num_rows:
            yield totals(held)

    def totals(rows: pa.Table) -> pa.RecordBatch:
        of = zip(*[rows.column(k).to_pylist() for k in keys])
        names = list(zip(of, *[rows.column(k).to_pylist() for k in _NODE]))
        at = {name: i for i, name in enumerate(names)}
        above = zip(names, *[rows.column(k).to_pylist() for k in _PARENT])
        parent = [at.get((name[0], u1, u2), -1) for name, u1, u2 in above]
        found = centroid_totals(parent, np.stack([rows.column(c).to_numpy() for c in ("leaves", "saved")], axis=1))
        kept = [rows.column(c).combine_chunks() for c in (*_NODE, *_PARENT)]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array([p < 0 for p in parent]), pa.array(found[:, 0]), pa.array(found[:, 1])],
            [*_NODE, *_PARENT, "top", "leaves", "saved"])

    return placed.mapInArrow(run, _FOREST)


# --- conversations --------------------------------------------------------------------------------------------

def _numbered(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, h1, h2, words)``: the turns by their place, from 0, without their texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    placed = row_index(written(turns, "turns"), ["conv_id"], ["numbered", "turn", "h1", "h2"], "at")
    return written(placed.select("conv_id", "at", "h1", "h2", "words"), "turns-numbered")


def _shapes(numbered: DataFrame) -> DataFrame:
    """For each conversation how many turns it takes from the first of its twenty (``shared``), drops (``h``) and has."""
    base = F.col("conv_id") - F.col("conv_id") % SHARERS
    convs = numbered.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", base.alias("base"), F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MOST_SHARED)).alias("h"))
    bases = convs.filter("conv_id = base").select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    shared = F.least("h", F.coalesce("there", F.lit(0)))
    return convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))


def _rebuilt(numbered: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(conv_id, pos, len, words, p1, p2, u1, u2)``: the rebuilt turns, each with the node it ends in and its parent."""
    hashes = ["h1", "h2", "words"]
    own = (numbered.join(shapes, "conv_id").filter("at >= h")
           .select("conv_id", (F.col("shared") + F.col("at") - F.col("h")).alias("pos"), "len", *hashes))
    heads = numbered.filter((F.col("conv_id") % SHARERS == 0) & (F.col("at") < MOST_SHARED)).withColumnRenamed("conv_id", "base")
    taken = (shapes.join(heads, "base").filter("at < shared").select("conv_id", F.col("at").alias("pos"), "len", *hashes))
    rows = own.union(taken).select(
        "conv_id", "pos", "len", "words", F.expr(f"pos div {STRETCH}").alias("stretch"),
        F.xxhash64("pos", "h1", "h2").alias("x1"), F.xxhash64(F.lit(2), "pos", "h1", "h2").alias("x2"))
    so_far = W.partitionBy("conv_id", "stretch").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv_id").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    before = (rows.groupBy("conv_id", "stretch").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
              .select("conv_id", "stretch", F.bit_xor("x1").over(earlier).alias("b1"), F.bit_xor("x2").over(earlier).alias("b2")))
    running = rows.select("*", F.bit_xor("x1").over(so_far).alias("r1"), F.bit_xor("x2").over(so_far).alias("r2"))
    node = {f"p{i}": F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)}
    parent = {f"u{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)}
    return (running.join(before, ["conv_id", "stretch"]).withColumns(node).withColumns(parent)
            .select("conv_id", "pos", "len", "words", *_NODE, *_PARENT))


def _nodes(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """A row for each node and the root (0, 0): its smallest member, depth, members, parent, own values and mass."""
    members = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum("len").alias("turns")]
    nodes = rows.groupBy(*_NODE).agg(
        *members, (F.min("pos") + 1).alias("depth"), F.min("words").alias("words"), *[F.min(u).alias(u) for u in _PARENT])
    root = shapes.agg(*members).filter("n_convs > 0").select(
        *[F.lit(0).cast("long").alias(p) for p in _NODE], "conv_id", "n_convs", "turns", F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("words"), *[F.lit(None).cast("long").alias(u) for u in _PARENT])
    nodes = written(nodes.select(*root.columns).union(root).select(
        *_NODE, *_PARENT, "conv_id", "n_convs", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("turns") - F.col("n_convs") * (F.col("depth") - 1)).alias("mass")), "trie-nodes")
    above = nodes.select(F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("conv_id").alias("parent_conv_id"),
                         F.col("mass").alias("parent_mass"))
    children = (nodes.filter("depth > 0").groupBy(F.col("u1").alias("p1"), F.col("u2").alias("p2"))
                .agg(F.count("*").alias("n_children")))
    return written(nodes.join(above, _PARENT, "left").join(children, _NODE, "left").withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0)), "leaves": F.col("n_children").isNull().cast("long")}), "trie")


def _totals(nodes: DataFrame, rows: DataFrame, light: int) -> DataFrame:
    """``(p1, p2, leaves, saved)`` over the subtree of each node."""
    is_light = (F.col("depth") > 0) & (F.col("mass") <= light)
    tops = nodes.filter(is_light & ((F.col("depth") == 1) | (F.col("parent_mass") > light))).select(*_NODE)
    # a conversation enters one light subtree, which also holds the nodes whose smallest member it is
    entered = rows.join(tops, _NODE).select("conv_id", F.col("p1").alias("t1"), F.col("p2").alias("t2"))
    below = written(_totalled(nodes.filter(is_light).join(entered, "conv_id"), [F.col("t1"), F.col("t2")]), "trie-light")

    def added(nodes: DataFrame, totals: DataFrame) -> DataFrame:
        """Totals of subtrees, added to the own values of the nodes they hang from."""
        sums = totals.groupBy(F.col("u1").alias("p1"), F.col("u2").alias("p2")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        return nodes.join(sums, _NODE, "left").withColumns({
            c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}).drop("more_leaves", "more_saved")

    # the nodes of one smallest member are a path
    piece = F.expr(f"depth div {light}")
    heavy = written(added(nodes.filter(~is_light), below.filter("top")).withColumn("piece", piece), "trie-heavy")
    first = F.min(F.struct("depth", *_PARENT, "parent_conv_id")).alias("first")
    pieces = written(heavy.groupBy("conv_id", "piece").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), first), "trie-pieces")
    tree = pieces.select(
        F.col("conv_id").alias("p1"), F.col("piece").alias("p2"), F.col("first.parent_conv_id").alias("u1"),
        F.expr(f"(first.depth - 1) div {light}").alias("u2"), "leaves", "saved")
    hung = (_totalled(tree, [F.lit(0).alias("all")]).filter("not top").select(F.col("p1").alias("conv_id"), F.col("p2").alias("piece"), "leaves", "saved")
            .join(pieces.select("conv_id", "piece", "first.u1", "first.u2"), ["conv_id", "piece"]))
    above = _totalled(added(heavy, hung), [F.col("conv_id"), F.col("piece")])
    return below.select(*_NODE, "leaves", "saved").union(above.select(*_NODE, "leaves", "saved"))


def _digests(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(p1, p2, ends_sha256)`` of the nodes where conversations end: their ids stream past in order, none is held."""
    root = [F.lit(0).cast("long").alias(p) for p in _NODE]
    ends = rows.filter("pos + 1 = len").select(*_NODE, "conv_id").union(shapes.filter("len = 0").select(*root, "conv_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            found = []
            for p1, p2, conv in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if (p1, p2) != node:
                    if node is not None:
                        found.append((*node, digest.hexdigest()))
                    node, digest = (p1, p2), hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield _digest_batch(found)
        if node is not None:
            yield _digest_batch([(*node, digest.hexdigest())])

    placed = ends.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")
    return placed.mapInArrow(run, "p1 long, p2 long, ends_sha256 string")


def _digest_batch(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = zip(*found) if found else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                      [*_NODE, "ends_sha256"])


def prefix_trie(conversations: DataFrame, light: int | None = None) -> DataFrame:
    """The nodes of the trie of ``conversations(conv_id, turn, role, text)``, with totals over their subtrees.

    Turns go by number, null first, and by the hash of role and text where the number is the same; a null role or text is empty. Rows
    without a conv_id are left out. Each conversation c is rebuilt: the first h turns of conversation c - c % 20, if it
    is there, then its own after the first h, h being crc32 of the decimal c modulo 4. Returns for each node: conv_id
    (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves, saved_tokens and
    ends_sha256 (of the members that end there, decimal, ascending, joined by commas). An empty table has no nodes.
    """
    numbered = _numbered(conversations)
    shapes = written(_shapes(numbered), "conversation-shapes")
    rows = written(_rebuilt(numbered, shapes), "turns-rebuilt")
    nodes = _nodes(rows, shapes)
    if light is None:
        light = ROOTS * math.isqrt(shapes.agg(F.sum("len")).first()[0] or 0) + 1
    totals = _totals(nodes, rows, light).select(*_NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    none = F.sha2(F.lit(""), 256)
    return (nodes.join(totals, _NODE).join(_digests(rows, shapes), _NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))
