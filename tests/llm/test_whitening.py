from __future__ import annotations

import math

import numpy as np
import pytest

from linewarden.llm.whitening import jacobi_davidson, orthonormal, symmetric_eigen, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n int, x double"


@pytest.fixture(scope="module")
def embed(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 0, "c", 1, 0.5) for i, v in rows], SCHEMA)

    return build


def brute(rows, most=16):
    """Per kept row (vec_id, deviation, whitened by component), and the statistics."""
    kept = [
        (i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    there = e > 1e-10 * e[0]
    e, v = e[there], v[:, there]
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        row = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        out.append((i, deviation, row @ v / np.sqrt(e)))
    return out, n, e / np.trace(cov)


def assert_whitened(frame, rows):
    expected, n, explained = brute(rows)
    got: dict = {}
    for r in frame.collect():
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9)
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(
            r["whitened"]
        )
    k = len(explained)
    wanted: dict = {}
    for i, deviation, white in expected:
        wanted.setdefault((i, deviation), []).append(white)
    assert got.keys() == wanted.keys()
    order = sorted(got, key=repr)
    for key in order:
        assert got[key].keys() == set(range(1, k + 1))
        assert all(len(v) == len(wanted[key]) for v in got[key].values())
    single = [key for key in order if len(wanted[key]) == 1]
    a = np.array([[got[key][c][0] for c in range(1, k + 1)] for key in single])
    b = np.array([wanted[key][0] for key in single])
    signs = np.sign((a * b).sum(axis=0))
    assert np.abs(a * signs - b).max() < 1e-7


def test_equals_brute_force_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in table.collect()]
    assert_whitened(whiten(table), rows)


def test_odd_rows(embed):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((60, 5)) * [4, 3, 2, 1, 0.5]).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(7, vectors[7])] * 3 + [(None, vectors[9]), (100, vectors[1]), (100, vectors[2])]
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [math.nan] * 5)]
    odd += [(204, [math.inf, 1.0, 1.0, 1.0, 1.0]), (205, [1.0]), (206, [3e38] * 5), (None, None)]
    assert_whitened(whiten(embed(rows + odd)), rows)


def test_fewer_components_than_dimensions(embed):
    rows = [(i, [float(i % 7), float(i % 5), 2.0, float(i % 7) * 2]) for i in range(40)]
    frame = whiten(embed(rows))
    assert {r["component"] for r in frame.select("component").collect()} == {1, 2}
    assert_whitened(frame, rows)


def test_nothing_to_whiten(embed):
    assert whiten(embed([])).count() == 0
    assert whiten(embed([(1, None), (2, [])])).count() == 0
    assert whiten(embed([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_deviations_beyond_a_long_are_null_and_others_exact(embed):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.5]), (4, [1e4, 9e15])]
    got = {r["vec_id"]: r["deviation"] for r in whiten(embed(rows)).collect()}
    expected = {i: d if d < 1 << 63 else None for i, d, _ in brute(rows)[0]}
    assert got == expected and None in got.values()


@pytest.mark.parametrize("m", [1, 2, 3, 16, 33])
def test_symmetric_eigen(m):
    a = np.random.default_rng(m).standard_normal((m, m))
    a = a + a.T
    e, v = symmetric_eigen(a)
    assert np.abs(a @ v - v * e).max() < 1e-12 * m and (np.diff(e) <= 0).all()
    assert np.abs(v.T @ v - np.eye(m)).max() < 1e-13 * m


@pytest.mark.parametrize("dims, kind", [(40, "plain"), (150, "plain"), (40, "equal"), (40, "low")])
def test_jacobi_davidson_reaches_double_precision(dims, kind):
    rng = np.random.default_rng(dims)
    values = np.sort(rng.random(dims))[::-1]
    if kind == "equal":
        values[:20] = 1.0
    if kind == "low":
        values[4:] = 0.0
    turn = orthonormal(rng.standard_normal((dims, dims)))
    matrix = (turn * values) @ turn.T
    e, v = jacobi_davidson(lambda block: matrix @ block, dims, 16)
    assert np.abs(e - values[:16]).max() < 1e-13
    assert np.abs(matrix @ v - v * e).max() < 1e-13
    assert np.abs(v.T @ v - np.eye(16)).max() < 1e-13
