import math
import random

import numpy as np
import pytest
from tackroom.llm.eigen import leading_eigenpairs
from tackroom.llm.q_whitening import components_table
from tackroom.llm.whitening import fit

SCHEMA = "vec_id long, embedding array<float>, n long, deviation string, component int, id int, vec array<int>, x int"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    vectors = [v and [c if c is None else float(c) for c in v] for v in vectors]
    return spark.createDataFrame([(i, v, 5, "d", 7, 8, [9], 1) for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def check(spark, vectors, ids=None):
    """Against exact integers and numpy's own eigenvalues."""
    ids = list(range(len(vectors))) if ids is None else ids
    rows = components_table(frame(spark, vectors, ids)).collect()
    kept = [(i, np.float32(v).astype(float)) for i, v in zip(ids, vectors, strict=True)
            if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    d = len(kept[0][1])
    x = [[math.floor(64 * c) + 1_000_000 for c in v.tolist()] for _, v in kept]
    n, s = len(x), [sum(col) for col in zip(*x, strict=True)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    k = min(32, d)
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.component, r.n, r.deviation) for r in rows) == sorted(
        (i if i is not None else -1, c + 1, n, y) for (i, _), y in zip(kept, dev, strict=True) for c in range(k))
    centred = np.array([[(n * a - b) / n for a, b in zip(r, s, strict=True)] for r in x])
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1][:k]
    assert len({r.identity_error for r in rows}) == 1
    for r in rows:
        want = values[r.component - 1] / np.trace(cov) if np.trace(cov) > 0 else None
        assert (r.explained is None) == (want is None) and (want is None or r.explained == pytest.approx(want, rel=1e-4, abs=1e-12))
    ok = values > 1e-9 * max(values[0], 1e-300)
    by = {}
    for r in rows:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    w = np.array([[by[i, y][c + 1] for c in np.flatnonzero(ok)] for (i, _), y in zip(kept, dev, strict=True)], dtype=float)
    assert all((v.get(c + 1) is None) == (not ok[c]) for v in by.values() for c in range(k))
    if ok.any():
        assert np.abs(w.T @ w / n - np.eye(ok.sum())).max() < 1e-9 and rows[0].identity_error < 1e-9
        back = centred.T @ w / n / np.sqrt(values[ok])    # the components, from the projections
        assert np.abs(cov @ back - back * values[ok]).max() < 1e-9 * values[0]
    else:
        assert rows[0].identity_error is None
    return rows


def rand(seed, n, d):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(3, 0.2, d)).tolist()


def test_against_numpy(spark):
    check(spark, rand(1, 400, 40))
    check(spark, rand(2, 50, 3))
    check(spark, rand(3, 30, 1))


def test_rows_that_take_no_part(spark):
    bad = [None, [], [None] * 5, [1.0, None, 0, 0, 0], [float("nan")] * 5, [float("inf"), 0, 0, 0, 0], [0, 0, 0, 0, -float("inf")],
           [float("nan")], [0.0] * 5]
    vectors = rand(4, 60, 5) + bad
    random.Random(5).shuffle(vectors)
    rows = check(spark, vectors)
    assert len({r.vec_id for r in rows}) == 61


def test_ties_repeats_null_ids_single_row_and_low_rank(spark):
    v = rand(6, 20, 4)
    check(spark, v + v[:3] + [v[0]] * 30, [*range(20), 0, 1, 2, *[None] * 30])
    check(spark, [[0.5, -0.5]])                                       # no variance at all
    check(spark, [[1.0, 2.0], [1.0, 2.0], [1.0, 2.0]])
    check(spark, (np.array(rand(7, 40, 2)).round() @ np.array([[1, 2, 3, 1], [0, 1, 1, 2.0]])).tolist())  # rank 2 of 4
    check(spark, [[4e6, 1.0], [-3e6, 2.0], [1e3, 2.0]])
    empty = components_table(frame(spark, [None, []]))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert components_table(spark.createDataFrame([], SCHEMA)).count() == 0


def test_beyond_64_bits_and_different_lengths(spark):
    rows = components_table(frame(spark, [[4e9, 1.0], [-4e9, 2.0]] * 4)).collect()
    assert {r.deviation for r in rows} == {None}
    with pytest.raises(Exception, match="too large"):
        fit(frame(spark, [[1e30, 1.0]]))
    with pytest.raises(ValueError, match="different lengths"):
        fit(frame(spark, [[1.0], [1.0, 2.0]]))


def test_eigenpairs_of_hard_matrices():
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(64, 64)))
    a = [np.eye(40), np.zeros((5, 5)), (q * np.repeat([5, 5, 3, 1e-9], 16)) @ q.T, np.kron(np.eye(8), np.ones((8, 8))),
         np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
         (q * np.logspace(0, -15, 64)) @ q.T * 1e200, (q * np.logspace(0, -3, 64)) @ q.T * 1e-200, -np.eye(3)]
    for m in a:
        w, v = leading_eigenpairs(m, 32)
        want = np.linalg.eigvalsh(m)[::-1][:len(w)]
        size = np.abs(m).max() or 1
        assert np.abs(w - want).max() < 1e-13 * size * 10
        assert np.abs(m @ v.T - v.T * w).max() < 1e-13 * size * 10 and np.abs(v @ v.T - np.eye(len(v))).max() < 1e-13
