"""Whitening against numpy's eigenvectors of the whole covariance, and exact sums against Python's integers."""

import math

import numpy as np
import pytest

from fieldstack.llm import embedding_whitening as W

SCHEMA = "vec_id long, embedding array<float>, component int, x string"


def table(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 5, "x")
            for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def integers(vectors):
    return np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)


def compare(spark, vectors, **more):
    """The query's columns, by brute force."""
    x = integers(vectors)
    n, sums = len(x), x.sum(axis=0)
    far = x * n - sums
    xc = far.astype(float) / n
    v = xc.T @ xc / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    got = W.whitened_components(table(spark, vectors), **more).collect()
    k = min(more.get("components", 32), int((e > 1e-13 * e[0]).sum()))
    assert len(got) == n * k
    rows = {(r.id, r.component): r for r in got}
    for c in range(k):
        mine = np.array([rows[i, c + 1].whitened for i in range(n)])
        want = xc @ u[:, c] / math.sqrt(e[c])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7
    for r in got:
        assert r.n == n and r.deviation == sum(int(t) ** 2 for t in far[r.id])
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(v), rel=1e-9)
        assert r.identity_error < 1e-9
    return got


@pytest.mark.parametrize("d", [1, 3, 40, 64, 150])
def test_against_numpy(spark, d):
    """Fewer dimensions than components, about as many, and more than the block has columns."""
    rng = np.random.default_rng(d)
    compare(spark, (rng.standard_normal((300, d)) * np.linspace(1, 3, d)).astype(np.float32))


def test_steep_spectrum(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 100)) @ np.diag(2.0 ** -np.arange(100).clip(0, 12)) * 50
    compare(spark, x.astype(np.float32), components=8)


def test_dependent_dimensions(spark):
    """A rank of 3 gives three components; a constant table and a single row give none."""
    rng = np.random.default_rng(2)
    base = rng.integers(-3, 4, (200, 3))
    x = np.concatenate([base, base, -base, np.ones((200, 60))], axis=1)
    got = compare(spark, x)
    assert {r.component for r in got} == {1, 2, 3}
    assert W.whitened_components(table(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert W.whitened_components(table(spark, [[1.0, 2.0]])).collect() == []


def test_equal_eigenvalues(spark):
    """A cross of 60 axes: any orthonormal basis does, the whitened covariance tells."""
    x = np.concatenate([np.eye(60), -np.eye(60)]) * 3
    got = W.whitened_components(table(spark, x), components=10).collect()
    w = np.zeros((120, 10))
    for r in got:
        w[r.id, r.component - 1] = r.whitened
    assert np.abs(w.T @ w / 120 - np.eye(10)).max() < 1e-9 and got[0].explained == pytest.approx(1 / 60)


def test_odd_vectors(spark):
    """Null, empty, non-finite and ragged vectors go; null and repeated ids and repeated vectors stay."""
    good = [[1, 2], [3, 5], [2, 0.5], [1, 2]]
    bad = [None, [], [1, None], [float("nan"), 1], [1, float("inf")], [1, 2, 3]]
    got = W.whitened_components(table(spark, good + bad, [7, None, 7, 1, 2, 3, 4, 5, 6, 8])).collect()
    assert sorted((r.id if r.id is not None else -1, r.component) for r in got) == sorted(
        (i, c) for i in (7, -1, 7, 1) for c in (1, 2)) and all(r.n == 4 for r in got)
    assert W.whitened_components(table(spark, bad[:5])).collect() == []


def test_empty_table(spark):
    out = W.whitened_components(table(spark, []))
    assert out.collect() == [] and out.columns == [c.split()[0] for c in W.WHITENED.split(", ")]


def test_numbers_beyond_a_long(spark):
    """Entries of 1e12 (their squares need more than 64 bits) and of 1e30 (held at the limit) don't fail."""
    got = W.whitened_components(table(spark, [[1e12, 0], [-1e12, 1], [3e11, 2]])).collect()
    assert [r.component for r in got] == [1, 1, 1] and all(r.deviation is None for r in got)   # the other is rounding beside it
    assert len(W.whitened_components(table(spark, [[1e30, 0], [0, 1], [5, 2]])).collect()) >= 3


def test_exact_sums(spark):
    x = [[10 ** 9 * i, -i] for i in range(50)]
    blocks, d = W.pack(table(spark, x), "vec_id", "embedding", 64.0, 1_000_000)
    n, sums, _ = W.exact_sums(blocks, d)
    assert (n, sums) == (50, [int(s) for s in integers(x).sum(axis=0)])
