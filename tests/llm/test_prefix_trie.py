import hashlib
import re
import zlib

import numpy as np
import pytest

from sidelines.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain(rows):
    """From rows (conv_id, turn, role, text) with no two equal turns in a conversation, node by node."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = tuple(turns.get(base, [])[:h]) + tuple(own[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) if below else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = sum(saved[p] for p in below) + (len(members[path]) - 1) * words
    result = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == path)
        result.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                       len(children.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = prefix_trie.prefix_trie(df, **options)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)
    return found


@pytest.mark.parametrize("light", [None, 100_000, 3])
def test_given_conversations(spark, light):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    found = check(spark, rows, light=light)
    assert all(kind == "bigint" for name, kind in found.dtypes if name != "ends_sha256")


@pytest.mark.parametrize("light", [None, 7, 1])
def test_shared_beginnings_of_all_lengths(spark, light, monkeypatch):
    """Conversations of a few words that branch everywhere, some very long; pieces and stretches are cut often."""
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    random = np.random.default_rng(light or 9)
    rows = []
    for conv in range(-30, 60):
        for turn in range(60 if conv % 29 == 0 else int(random.integers(0, 9))):
            text = "a b" if conv % 3 == 0 and turn < 30 else str(random.choice(["one", "two words", ""]))
            rows.append((conv, turn, str(random.choice(["user", "assistant"])) if turn > 2 else "user", text))
    check(spark, rows, light=light)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 2, "user", "b"), (5, -1, "", None), (25, 7, "user", ""),
            (40, 0, "user", "long " * 20000), (41, 0, "user", "x"), (41, 1, "user", "x"), (7, 0, "a", "bc"), (8, 0, "ab", "c")]
    check(spark, rows)


def test_turnless_conversations_and_equal_ones(spark):
    """Conversations that drop all of their turns end at the root; equal ones share all nodes."""
    check(spark, [(c, t, "user", "same words here") for c in range(1, 20) for t in range(2)])


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows_are_turns(spark):
    """Equal rows are two turns; turns of one number are in some fixed order."""
    rows = [(20, 0, "user", "a"), (20, 0, "user", "a"), (20, 0, "user", "a"), (20, 0, "user", "b")]
    found = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    assert sorted(r["depth"] for r in found) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("shape", ["path", "star", "random", "forest", "binary"])
def test_centroid_totals(shape):
    random = np.random.default_rng(1)
    n = 700
    parent = {"path": [i - 1 for i in range(n)], "star": [-1] + [0] * (n - 1), "binary": [(i - 1) // 2 if i else -1 for i in range(n)],
              "random": [-1] + [int(random.integers(0, i)) for i in range(1, n)],
              "forest": [int(random.integers(-1, i)) for i in range(n)]}[shape]
    order = random.permutation(n)  # parents need not come first
    place = np.argsort(order)
    shuffled = [0] * n
    for node, above in enumerate(parent):
        shuffled[place[node]] = int(place[above]) if above >= 0 else -1
    values = random.integers(-5, 50, (n, 2))
    expected = values[order].copy()[place]
    expected = values.copy()
    for node in reversed(range(n)):
        if parent[node] >= 0:
            expected[place[parent[node]]] += expected[place[node]]
    assert (prefix_trie.centroid_totals(shuffled, values) == expected).all()
