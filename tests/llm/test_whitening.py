"""Whitening against dense eigenvectors, and its solver against plain singular values."""

import numpy as np
import pytest

from docengine.llm import bidiagonal, queries, whitening

SF = "/root/testdata/sf0.001"


def shapes():
    random = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64):
        turn = np.linalg.qr(random.standard_normal((n, n)))[0]
        half = max(1, n // 2)
        yield np.linalg.qr(random.standard_normal((3 * n, n)), mode="r")
        yield np.eye(n)
        yield np.zeros((n, n))
        yield np.diag(10.0 ** -np.arange(n))
        yield np.diag(10.0 ** np.arange(-n, 0))
        yield turn * np.array([5.0] * half + [1.0] * (n - half)) @ turn.T
        yield turn * (1 + 1e-9 * np.arange(n)) @ turn.T
        yield random.standard_normal((n, half)) @ random.standard_normal((half, n))


@pytest.mark.parametrize("matrix", list(shapes()), ids=lambda m: f"{len(m)}")
def test_singular_values_and_vectors(matrix):
    diagonal, upper, right = bidiagonal.bidiagonal(matrix)
    assert np.abs(right.T @ right - np.eye(len(right))).max() < 1e-13
    found = bidiagonal.dqds(diagonal, upper)
    expected = np.linalg.svd(matrix, compute_uv=False)
    assert np.abs(np.sqrt(found) - expected).max() <= 1e-14 * max(expected.max(), 1e-300)
    some = np.sqrt(found) > expected.max() * len(found) * bidiagonal.EPS
    if some.any():
        z = right @ bidiagonal.vectors(diagonal, upper, found[some])
        assert np.abs(z.T @ z - np.eye(z.shape[1])).max() < 1e-11
        assert np.abs(matrix.T @ (matrix @ z) - z * found[some]).max() < 1e-12 * found[0]


def dense(rows, components=32):
    """Ids, deviations and whitened rows by numpy's eigenvectors."""
    ids = [i for i, _ in rows]
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    c = x - total / n
    values, turn = np.linalg.eigh(c.T @ c / n)
    values, turn = values[::-1], turn[:, ::-1]
    white = c @ turn[:, :components] / np.sqrt(values[:components])
    return ids, ((n * x - total) ** 2).sum(axis=1), white, values[:components] / values.sum()


def test_query_equals_dense_eigenvectors(spark):
    rows = [
        (r.vec_id, r.embedding)
        for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ]
    ids, deviation, white, explained = dense(rows)
    got = sorted(tuple(r) for r in queries.op12_whitening(spark, SF).collect())
    assert [r[:2] for r in got] == [(i, k + 1) for i in ids for k in range(32)]
    assert {r[2] for r in got} == {len(rows)}
    assert [r[3] for r in got[::32]] == deviation.tolist()
    own = np.array([r[4] for r in got]).reshape(-1, 32)
    signs = np.sign((own * white).sum(axis=0))
    assert np.abs(own * signs - white).max() < 1e-9
    assert np.abs(np.array([r[5] for r in got[:32]]) / explained - 1).max() < 1e-12
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-10
    assert np.abs(own.T @ own / len(own) - np.eye(32)).max() < 1e-10


def test_odd_rows(spark):
    """What cannot be measured is left out; ids may repeat or be missing."""
    random = np.random.default_rng(3)
    good = [(k % 30, random.standard_normal(3).tolist()) for k in range(40)]
    good += [(None, [0.5, -0.25, 0.125]), (30, [1e4, -1e4, 3.0])]
    bad = [
        (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
        (104, [1.0, float("inf"), 2.0]), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0]),
    ]
    table = spark.createDataFrame(
        [(i, v, 1, 2.0, "x") for i, v in good + bad],
        "vec_id long, embedding array<double>, n int, deviation double, pos string",
    )
    got = whitening.whiten(table.repartition(5)).collect()
    assert len(got) == 3 * len(good) and {r.vec_id for r in got} == {i for i, _ in good}
    assert {r.n for r in got} == {len(good)} and got[0].identity_error < 1e-9
    ids, deviation, _, explained = dense(good)
    assert sorted(str((r.vec_id, r.deviation)) for r in got if r.component == 1) == sorted(
        str((i, d)) for i, d in zip(ids, deviation.tolist())
    )
    assert sorted({r.explained for r in got}) == pytest.approx(sorted(explained))


def test_directions_without_variance_are_no_components(spark):
    schema = "vec_id long, embedding array<float>"
    flat = spark.createDataFrame([(k, [float(k), 1.0, 2.0 * k]) for k in range(9)], schema)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    for rows in ([], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(5)], [(1, None)]):
        empty = whitening.whiten(spark.createDataFrame(rows, schema))
        assert empty.count() == 0 and len(empty.columns) == 7


def test_deviation_beyond_a_long_is_null(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [2.0**44, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert {r.vec_id for r in got if r.deviation is None} == {1, 2, 3}


def test_factors_fold_over_several_rounds(spark, monkeypatch):
    """More parts than are folded at once, as on many executors."""
    random = np.random.default_rng(8)
    rows = [(k, random.standard_normal(4).tolist()) for k in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(70)
    got = sorted(tuple(r) for r in whitening.whiten(table).collect())
    _, _, white, _ = dense(rows)
    own = np.array([r[4] for r in got]).reshape(-1, 4)
    assert np.abs(np.abs(own) - np.abs(white)).max() < 1e-9
