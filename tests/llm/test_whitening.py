import math

import numpy as np
import pytest

from floodmark.llm import whitening


def made(eigen, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(eigen), len(eigen))))
    return (q * eigen) @ q.T


@pytest.mark.parametrize("eigen", [[5, 4, 3, 2, 1], [9, 9, 9, 1, 1, 0], [1e6, 1, 1e-6, 0, 0, -3], [2, 2 - 1e-9, 2 - 2e-9, 1], [4]])
def test_counts_and_leading_eigenvalues(eigen):
    m = made(np.array(eigen, float), len(eigen))
    m = (m + m.T) / 2
    true = np.sort(np.linalg.eigvalsh(m))
    for shift in [-10.0, -2.9, 0.5, 1.5, 3.5, 8.0, 1e7]:
        assert whitening.below(m, shift) == int((true < shift).sum())
    values, vectors = whitening.leading(m, 4)
    assert np.allclose(values, true[::-1][:4], atol=1e-13 * max(map(abs, eigen)), rtol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-12)
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-12 * max(map(abs, eigen))


def test_random_matrices():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        n = int(rng.integers(2, 40))
        m = rng.normal(size=(n, n))
        m += m.T
        true = np.sort(np.linalg.eigvalsh(m))
        assert [whitening.below(m, s) for s in (true[:-1] + true[1:]) / 2] == list(range(1, n))
        values, vectors = whitening.leading(m, 8)
        assert np.allclose(values, true[::-1][:8], atol=1e-11)
        assert np.abs(m @ vectors - vectors * values).max() <= 1e-11


def brute(rows):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], object)
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    c = (d / n).astype(float)
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    return [i for i, _ in good], n, (d * d).sum(axis=1), c @ q[:, ::-1][:, :8] / np.sqrt(e[::-1][:8]), e[::-1][:8] / np.trace(v)


def test_same_as_dense_eigenvectors(spark):
    rng = np.random.default_rng(4)
    spread = rng.normal(size=(12, 12)) * np.linspace(3, 0.2, 12)[:, None]
    rows = [(k, [float(c) for c in np.float32(rng.normal(size=12) @ spread)]) for k in range(300)]
    rows += [rows[7], (2**60 + 1, rows[3][1]), (None, rows[5][1]), (900, None), (901, []), (902, [math.nan] * 12), (903, [None, *rows[1][1][1:]])]
    rows += [(904, [math.inf] * 12)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as v", "2 as id", "3 as dim", "4 as n")
    got = whitening.whiten(given.repartition(5)).collect()
    ids, n, deviation, whitened, explained = brute(rows)
    assert len(got) == 8 * len(ids) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error <= 1e-9
    want = sorted(((i, int(d), tuple(np.abs(w).round(7))) for i, d, w in zip(ids, deviation, whitened)), key=str)
    rows_of = {}
    for r in got:
        assert abs(r.explained - explained[r.component - 1]) <= 1e-10
        rows_of.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    mine = []
    for (i, d), cells in rows_of.items():
        for k in range(len(cells[1])):  # repeated rows
            mine.append((i, d, tuple(round(abs(cells[c][k]), 7) for c in range(1, 9))))
    for a, b in zip(sorted(mine, key=str), want, strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2], b[2], atol=1e-6)
    # One sign for all rows.
    signs = {c: {math.copysign(1, r.whitened * whitened[ids.index(r.vec_id), c - 1]) for r in got if r.component == c and r.vec_id == 11} for c in range(1, 9)}
    for r in got:
        if r.vec_id in range(20) and r.vec_id != 7 and abs(r.whitened) > 1e-6:
            assert math.copysign(1, r.whitened * whitened[ids.index(r.vec_id), r.component - 1]) in signs[r.component]


def test_degenerate_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], kind)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    # All on a line: one component has variance; another length is fitted by itself.
    line = [(k, [0.5 * k, 1.0 * k, 0.0]) for k in range(5)] + [(10, [1.0]), (11, [3.0])]
    got = whitening.whiten(spark.createDataFrame(line, kind)).collect()
    first = [r for r in got if r.vec_id < 10 and r.component == 1]
    assert len(first) == 5 and all(abs(r.explained - 1) < 1e-12 and r.whitened is not None for r in first)
    assert all(r.whitened is None for r in got if r.vec_id < 10 and r.component > 1)
    assert {(r.vec_id, round(abs(r.whitened), 12), r.n) for r in got if r.vec_id >= 10} == {(10, 1.0, 2), (11, 1.0, 2)}


def test_large_sums_stay_exact(spark):
    big = [(1, [2.0**30]), (2, [-(2.0**30)]), (3, [0.5])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()}
    x = [2**40 + 100000, -(2**40) + 100000, 512 + 100000]
    want = {k + 1: (3 * v - sum(x)) ** 2 for k, v in enumerate(x)}
    assert got == {k: v if v < 2**63 else None for k, v in want.items()}
