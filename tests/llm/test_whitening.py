"""Whitening against numpy's eigenvectors of the whole covariance, and rows with all the awkward cases."""

import numpy as np
import pytest

from graphloom.llm import whitening

NAMES = "vec_id long, embedding array<float>, row string, x string, deviation string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "own row", "own x", "own d") for i, v in vectors], NAMES)


def brute(vectors, k):
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    moved = n * x - s
    c = moved.astype(float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return [int((r * r).sum()) for r in moved], c, e[::-1][:k], u[:, ::-1][:, :k], np.trace(c.T @ c / n)


@pytest.mark.parametrize(("d", "rank", "k"), [(6, 6, 3), (3, 3, 32), (60, 5, 4), (60, 60, 4)])
def test_components(spark, d, rank, k):
    rng = np.random.default_rng(d + rank)
    basis = rng.standard_normal((rank, d)) * np.linspace(3, 1, rank)[:, None]
    rows = [(i % 90, [float(np.float32(c)) for c in rng.standard_normal(rank) @ basis]) for i in range(150)]
    rows += [(None, rows[0][1]), rows[1]]
    deviation, c, e, u, trace = brute(rows, k)
    got = whitening.components(table(spark, rows).repartition(5), k=k).collect()
    assert len(got) == len(rows) * min(k, d) and {r["n"] for r in got} == {len(rows)}
    want = sorted((-1 if i is None else i, j + 1, dev, round(float(t) / trace, 9)) for (i, _), dev in zip(rows, deviation, strict=True) for j, t in enumerate(e))
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"], r["deviation"], round(r["explained"], 9)) for r in got) == want
    assert max(r["identity_error"] for r in got) < 1e-9
    by = {}
    for r in got:
        by.setdefault((r["component"], r["deviation"]), abs(r["whitened"]))
    for i, dev in enumerate(deviation):
        for j in range(len(e)):
            assert by[j + 1, dev] == pytest.approx(abs(float(c[i] @ u[:, j])) / e[j] ** 0.5, abs=1e-8)


def test_a_thin_basis_is_enough_for_low_rank(spark):
    rng = np.random.default_rng(1)
    basis = rng.standard_normal((4, 50)) * 20
    rows = [(i, [float(c) for c in np.round(rng.integers(-9, 9, 4) @ np.sign(basis))]) for i in range(80)]
    found = whitening.fit(whitening.usable(table(spark, rows)), k=3)
    assert found.passed == 11
    assert whitening.fit(whitening.usable(table(spark, [(i, [float(c) for c in rng.standard_normal(50)]) for i in range(80)])), k=3).passed == 50


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [1.0, 2.0, 3.0]), (7, [0.25, 1.0]), (8, [0.5, 1.0]), (None, [0.5, 1.0])]
    got = whitening.components(table(spark, rows)).collect()
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"]) for r in got) == [(-1, 1), (-1, 2), (7, 1), (7, 2), (8, 1), (8, 2)]
    assert {(r["component"], round(r["explained"], 12)) for r in got} == {(1, 1.0), (2, 0.0)}
    assert all(r["whitened"] == 0 for r in got if r["component"] == 2) and {r["deviation"] for r in got if r["vec_id"] == 7} == {(3 * 16 - 80) ** 2}


def test_one_vector_equal_vectors_and_none(spark):
    for rows in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        got = whitening.components(table(spark, rows)).collect()
        assert len(got) == 2 * len(rows) and all(r["whitened"] == 0 and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] == 0 for r in got)
    assert whitening.components(table(spark, [(1, None)])).collect() == []
    assert whitening.components(table(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_64_bits_are_null(spark):
    got = whitening.components(table(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])])).collect()
    assert {r["deviation"] for r in got} == {None}
    assert {r["deviation"] for r in whitening.components(table(spark, [(1, [2.0**22, 0.0]), (2, [0.0, 0.0])])).collect()} == {2**56}


def test_query(spark):
    got = whitening.query(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert got.count() == 500 * 32
