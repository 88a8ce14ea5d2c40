"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from pitchside.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def dense(vectors: np.ndarray) -> tuple:
    """n, sums, eigenvalues (falling) and eigenvectors of the distinct whole-number vectors."""
    x = np.unique(np.floor(256 * vectors).astype(int), axis=0)
    n, sums = len(x), x.sum(axis=0)
    apart = x - sums / n
    values, turn = np.linalg.eigh(apart.T @ apart / n)
    return n, sums, values[::-1], turn[:, ::-1]


def held(found, vectors: dict[int, list[float]]) -> None:
    """Whether ``found`` is what a dense decomposition gives."""
    n, sums, values, turn = dense(np.array(list(vectors.values()), float))
    k = min(4, len(sums))
    rows = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert len(rows) == found.count() == k * len(vectors)
    signs = np.zeros(k)
    for key, vector in vectors.items():
        x = np.floor(256 * np.array(vector, float)).astype(int)
        apart = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        for i in range(k):
            r = rows[key, i + 1]
            assert (r["n"], r["deviation"]) == (n, apart)
            white = (x - sums / n) @ turn[:, i] / np.sqrt(values[i])
            signs[i] = signs[i] or np.sign(white * r["whitened"])
            assert r["whitened"] == pytest.approx(signs[i] * white, abs=1e-8)
            assert r["explained"] == pytest.approx(values[i] / values.sum(), rel=1e-10)
            assert r["identity_error"] < 1e-10


def test_embeddings(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    held(queries.op13_whitening(spark, SF), dict(rows))


@pytest.mark.parametrize("width", [1, 3, 24])
def test_repeats_count_once(spark, width):
    draw = np.random.default_rng(width)
    some = draw.standard_normal((60, width)) * np.linspace(1, 3, width)
    vectors = {i: some[i % 60 if i < 80 else 7].tolist() for i in range(200)}
    df = spark.createDataFrame(list(vectors.items()), SCHEMA).repartition(3)
    held(whitening.with_components(df, search=whitening.Search(guard=4, degree=8)), vectors)


def test_without_spread(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], SCHEMA)
    found = whitening.with_components(same).collect()
    assert len(found) == 8
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found} == {
        (1, 0, None, None, 0.0)
    }
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], SCHEMA)
    found = {(r["vec_id"], r["component"]): r["whitened"] for r in whitening.with_components(line).collect()}
    assert abs(found[0, 1]) == pytest.approx(2**0.5) and found[0, 2] is None


def test_rows_without_a_place(spark):
    bad = [
        (10, None), (11, []), (12, [1.0]), (13, [None, 1.0]), (14, [float("nan"), 1.0]),
        (15, [float("inf"), 1.0]), (16, [1e300, 1.0]),
    ]
    good = {1: [1.0, 0.5], 2: [-3.0, 0.25], 3: [0.0, 7.0], 4: [-0.0, 7.0]}
    df = spark.createDataFrame([*good.items(), *bad], SCHEMA)
    held(whitening.with_components(df), good)


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, 0], [5, 5]])
    assert whitening.deviations(x, 10, [7, 7]) == [None, 2 * 43**2]
    assert whitening.deviations(x[1:], 10, [7, 7]) == [2 * 43**2]


@pytest.mark.parametrize("width", [50, 200])
def test_close_eigenvalues(width):
    draw = np.random.default_rng(2)
    turn = np.linalg.qr(draw.standard_normal((width, width)))[0]
    values = np.sort(1 + 0.05 * draw.random(width))[::-1]
    passes = []

    def apply(q):
        passes.append(1)
        return turn @ (values[:, None] * (turn.T @ q))

    found, vectors = whitening.leading(apply, width)
    assert found == pytest.approx(values[:4], rel=1e-12)
    assert np.abs(np.abs(turn[:, :4].T @ vectors) - np.eye(4)).max() < 1e-8
    assert len(passes) < 400


def test_polynomial():
    """Small on the interval, 1 at the top, and equal to the Chebyshev polynomial."""
    values = np.array([0.0, 0.3, 1.0, 1.4, 2.0])
    q = np.ones((5, 1))
    found = whitening.filtered(
        lambda x: values[:, None] * x, q, values[:, None] * q, 0.0, 1.0, 2.0, 6
    )
    of = np.polynomial.Chebyshev.basis(6)
    assert found[:, 0] == pytest.approx(of(2 * values - 1) / of(3.0))
