import heapq

import numpy as np
import pytest

from sidelines.llm import embedding_dedup, registry
from tests.llm.test_simhash import plain_roots

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return bool(vector) and all(c is not None and np.isfinite(c) for c in vector) and any(vector)


def plain(rows, least=0.93):
    """All pairs, from rows (vec_id, vector, label); returns the result's rows and the pairs that are linked."""
    unit = {}
    for i, (_, vector, label) in enumerate(rows):
        if label is not None and usable(vector):
            x = np.array(vector, np.float64)
            unit[i] = x / np.linalg.norm(x)
    by_key = {}
    for i, x in unit.items():
        by_key.setdefault((rows[i][2], len(x)), []).append(i)
    pairs = []
    for members in by_key.values():
        cosines = np.array([unit[i] for i in members]) @ np.array([unit[i] for i in members]).T
        pairs += [(members[a], members[b]) for a, b in zip(*np.nonzero(cosines >= least)) if a < b]
    roots = plain_roots(range(len(rows)), pairs)
    least_id, n = {}, [0] * len(rows)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    for i, row in enumerate(rows):
        if row[0] is not None:
            least_id[roots[i]] = min(row[0], least_id.get(roots[i], row[0]))
    result = [(row[0], n[i], least_id.get(roots[i]), row[0] == least_id.get(roots[i])) for i, row in enumerate(rows)]
    return sorted(result, key=str), pairs


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(seed, groups, size, dims=64, noise=0.2, label=lambda g: g % 3):
    """Groups of vectors about a random direction each; noise 0.2 gives cosines of some 0.96."""
    random = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = random.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            aside = random.standard_normal(dims)
            x = centre + noise * aside / np.linalg.norm(aside)
            rows.append([float(np.float32(c)) for c in x / np.linalg.norm(x)])
    return [(i, x, label(i // size)) for i, x in enumerate(rows)]


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    df = registry.queries()["op13_embedding_dedup"](spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert found(df) == plain(rows)[0]


@pytest.mark.parametrize("chunk_rows,rows_per_cell", [(50_000, 1024), (7, 2), (1, 20)])
def test_planted_copies_equal_all_pairs(spark, chunk_rows, rows_per_cell):
    """With many cells and chunks: at cosines of 0.96 and above nothing is missed here."""
    rows = near_copies(1, 60, 6) + [(1000 + i, *row[1:]) for i, row in enumerate(near_copies(1, 60, 6)[::9])]
    df = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), rows_per_cell=rows_per_cell, chunk_rows=chunk_rows)
    expected, pairs = plain(rows)
    assert len(pairs) > 900 and found(df) == expected


def test_recall_at_the_least_cosine(spark):
    """Pairs between 0.93 and 0.95, the hardest there are: at least 0.9 are found, and none is false."""
    rows = near_copies(2, 500, 2, noise=0.257, label=lambda g: 0)
    _, pairs = plain(rows)
    assert len(pairs) > 200
    df = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), rows_per_cell=10)
    links = {r["vec_id"]: r["n_links"] for r in df.collect()}
    assert sum(links.values()) >= 0.9 * 2 * len(pairs)
    linked = {i for pair in pairs for i in pair}
    assert all(i in linked for i, n in links.items() if n)


def test_walk_is_the_multi_sequence(spark):
    """Against the textbook's queue over the two sorted lists."""
    random = np.random.default_rng(4)
    sample = random.standard_normal((2000, 16))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    grid = embedding_dedup.fitted(sample, 12, 0.93, 0.99)
    a, b = grid.distances(sample[:50])
    who, i, j = grid.walk(sample[:50])
    for row in range(50):
        by_a, by_b = np.argsort(a[row]), np.argsort(b[row])
        queue, seen, cells = [(0.0, 0, 0)], {(0, 0)}, set()
        while queue:
            distance, x, y = heapq.heappop(queue)
            if distance > grid.reach:
                break
            cells.add((int(by_a[x]), int(by_b[y])))
            for step in ((x + 1, y), (x, y + 1)):
                if step not in seen and step[0] < len(by_a) and step[1] < len(by_b):
                    seen.add(step)
                    heapq.heappush(queue, (a[row, by_a[step[0]]] + b[row, by_b[step[1]]], *step))
        assert set(zip(i[who == row].tolist(), j[who == row].tolist())) == cells


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [0.0, 0.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [-1.0, 0.0], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 2), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 3), (None, [0.0, 1.0], 3),
            (13, [1e-30, 0.0], 1), (14, [1e30, 1e30], 4), (15, [3.0], 5), (16, [5.0], 5), (17, [-5.0], 5), (-3, [0.0, -0.0, 2.0], 6), (4, [0.0, 0.0, 3.0], 6)]
    df = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert found(df) == plain(rows)[0]


def test_one_group_of_equal_vectors(spark):
    rows = [(i, [0.5, 0.5, 0.5], 1) for i in range(1, 400)]
    result = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["n_links"], r["component_id"]) for r in result} == {(398, 1)} and [r["vec_id"] for r in result if r["kept"]] == [1]


def test_empty_table_and_other_columns(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, [1.0, 0.0], "a", 5, 6), (2, [1.0, 0.0], "a", 7, 8)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string, n_links int, kept int")
    assert found(embedding_dedup.near_duplicates(df)) == [(1, 1, 1, True), (2, 1, 1, False)]
