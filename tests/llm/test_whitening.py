import numpy as np
import pytest

from sidelines.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<float>, component int"


def plain(rows, components=8):
    """The components by the covariance matrix, from rows (vec_id, vector) that are all good."""
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    away = x * n - sums
    centred = (away / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    values, axes = values[order], axes[:, order]
    return n, (away * away).sum(axis=1), centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(found, rows, components=8):
    n, deviations, projected, explained = plain(rows, components)
    at = {i: k for k, (i, _) in enumerate(rows)}
    assert len(found) == n * len(explained)
    white = np.full(projected.shape, np.nan)
    for r in found:
        white[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == deviations[at[r["vec_id"]]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
    signs = np.sign((white * projected).sum(axis=0))
    assert np.abs(white * signs - projected).max() < 1e-8
    error = np.abs(white.T @ white / n - np.outer(white.mean(axis=0), white.mean(axis=0)) - np.eye(white.shape[1])).max()
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and error < 1e-9
    assert found[0]["identity_error"] < 1e-9


def test_query_equals_eigenvectors_of_the_covariance(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = registry.queries()["op11_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                  "explained": "double", "identity_error": "double"}
    check(found.collect(), rows)


@pytest.mark.parametrize("block", [1, 3, 8, 64])
def test_any_block_gives_the_singular_vectors(block):
    random = np.random.default_rng(7)
    x = random.standard_normal((300, 20)) * np.linspace(5, 0.1, 20)
    x -= x.mean(axis=0)
    steps = []

    def xv(right, left):
        steps.append(right.shape[1])
        return (x @ left).T @ (x @ right), (x @ right).T @ (x @ right), np.vdot(x, x)

    def xtu(new, left):
        return x.T @ (x @ new), (x @ left).T @ (x @ new), (x @ new).T @ (x @ new)

    found = whitening.bidiagonalised(xv, xtu, 20, 8, block)
    _, deviations, v = np.linalg.svd(x)
    assert found.deviations == pytest.approx(deviations[:8], rel=1e-12)
    assert np.abs(np.abs((found.vectors * v[:8].T).sum(axis=0)) - 1).max() < 1e-12
    assert max(steps) <= block and sum(steps) <= 20


def test_stops_when_the_components_have_converged():
    random = np.random.default_rng(7)
    x = random.standard_normal((400, 120)) * np.array([1000, 900, 800, 700, *[1e-3] * 116])
    x -= x.mean(axis=0)
    steps = []

    def xv(right, left):
        steps.append(right.shape[1])
        return (x @ left).T @ (x @ right), (x @ right).T @ (x @ right), np.vdot(x, x)

    found = whitening.bidiagonalised(
        xv, lambda new, left: (x.T @ (x @ new), (x @ left).T @ (x @ new), (x @ new).T @ (x @ new)), 120, 4, 8)
    assert found.deviations == pytest.approx(np.linalg.svd(x)[1][:4], rel=1e-12)
    assert sum(steps) < 120


def test_rank_below_the_components(spark):
    """Three dimensions that vary, one of them twice: two components."""
    random = np.random.default_rng(3)
    vectors = [[float(a), float(b), float(a), 7.0] for a, b in random.integers(-4, 5, (50, 2))]
    found = whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert {r["component"] for r in found} == {1, 2}
    check(found, list(enumerate(vectors)), 2)


def test_equal_eigenvalues(spark):
    """Sixteen corners of a cube: every deviation is the same, any orthogonal components are right."""
    corners = [[float(i >> k & 1) for k in range(4)] for i in range(16)]
    for block in (1, 16):
        found = whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in enumerate(corners)], SCHEMA), 8, block).collect()
        assert len(found) == 64 and {round(r["explained"], 12) for r in found} == {0.25}
        assert found[0]["identity_error"] < 1e-9


def test_bad_vectors_are_left_out(spark):
    random = np.random.default_rng(5)
    good = [(i, [float(np.float32(c)) for c in random.standard_normal(5)]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [nan] * 5), (104, [inf, 0.0, 0.0, 0.0, 0.0]),
           (105, [1.0, 2.0])]
    found = whitening.whitened(spark.createDataFrame([(i, v, 9) for i, v in good + bad], SCHEMA), block=2).collect()
    check(found, good, 5)


def test_null_ids_and_repeated_rows_count(spark):
    rows = [(None, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (3, [2.0, 1.0], 0), (3, [0.0, 5.0], 0)]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 8 and {r["n"] for r in found} == {4}
    assert sorted(str(r["vec_id"]) for r in found) == ["3"] * 4 + ["None"] * 4


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 5):
        assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(0, [1e14, 3.0]), (1, [-1e14, 5.0]), (2, [2e13, -7.0])]
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    found = whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    for r in found:
        assert int(r["deviation"]) == sum((3 * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
