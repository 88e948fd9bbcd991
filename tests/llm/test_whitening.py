"""Whitening against numpy: states in any split, the QR iteration, exact deviations, lengths, edges."""

import numpy as np
import pytest

from statuta.llm import whitening


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_symmetric_qr(n):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n, n))
    for m in (a @ a.T, a + a.T, np.diag(np.arange(n) // 2.0), np.zeros((n, n)), np.ones((n, n))):
        values, vectors = whitening.symmetric_qr(m)
        assert np.allclose(values, np.linalg.eigvalsh(m)[::-1], atol=1e-10 * max(1, np.abs(m).max() * n))
        assert np.allclose(vectors @ np.diag(values) @ vectors.T, m, atol=1e-9 * max(1, np.abs(m).max()))
        assert np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-12)


def test_states_merge_to_the_whole():
    x = np.random.default_rng(1).integers(-500, 500, (300, 6)) + 10**9
    for cut in ([0, 100, 100, 250, 300], [0, 1, 300], [0, 300]):
        merged = whitening.State(6)
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            part = whitening.State(6)
            for v in x[a:b].astype(float):
                part.add(v)
            merged.merge(part)
        assert merged.n == 300 and np.allclose(merged.moment / 300, np.cov(x.T, bias=True), rtol=1e-9, atol=1e-3)


def _check(rows, got):
    """rows: (vec_id, vector) of one length without bad ones; got: result rows of that length."""
    x = np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64)
    u = np.unique(x, axis=0)
    n, total = len(u), u.sum(axis=0)
    centred = u - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, x.shape[1])
    assert len(got) == k * len(rows)
    for c in range(k):
        mine = sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in got if r["component"] == c + 1)
        y = (x - total / n) @ vectors[:, c] / np.sqrt(values[c])
        apart = ((n * x - total) ** 2).sum(axis=1)
        for sign in (1, -1):
            want = sorted((i, int(d), sign * w) for (i, _), d, w in zip(rows, apart, y, strict=True))
            if all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-7 for a, b in zip(mine, want, strict=True)):
                break
        else:
            raise AssertionError(c)
        assert all(abs(r["explained"] - values[c] / values.sum()) < 1e-9 for r in got if r["component"] == c + 1)
    assert {r["n"] for r in got} == {n} and {r["identity_error"] for r in got}.pop() < 1e-9


def test_two_lengths_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    a = [(i, (rng.normal(size=9) * np.arange(1, 10)).tolist()) for i in range(300)]
    b = [(1000 + i, (rng.normal(size=3) * np.array([3, 2, 1])).tolist()) for i in range(200)]
    a += [(i, a[0][1]) for i in range(400, 500)]  # one vector many times counts once in the fit
    bad = [(2000, None), (2001, [None, 1.0, 2.0]), (2002, [float("nan"), 1.0, 2.0]), (2003, [float("inf"), 1.0, 2.0]), (2004, [])]
    table = spark.createDataFrame([(i, v, 1, 1) for i, v in a + b + bad], "vec_id long, embedding array<double>, n int, x int").repartition(7)
    got = whitening.whiten(table).collect()
    _check(a, [r for r in got if r["vec_id"] < 1000])
    _check(b, [r for r in got if 1000 <= r["vec_id"] < 2000])
    assert not [r for r in got if r["vec_id"] >= 2000]


def test_many_partitions_merge_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MERGED", 2)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(150)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check(rows, whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_degenerate(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(make([(1, [1.0])]).limit(0)).count() == 0
    one = whitening.whiten(make([(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, 0.0, 0.0) for r in one)
    flat = whitening.whiten(make([(i, [float(i), 5.0, 5.0]) for i in range(10)])).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in flat) and flat[0]["identity_error"] < 1e-12
    huge = whitening.whiten(make([(1, [1e300, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 3.0])])).collect()
    assert len(huge) == 6 and {r["deviation"] for r in huge} == {None}
    assert len(whitening.whiten(make([(i, [float(i % 7)]) for i in range(50)])).collect()) == 50
