"""Whitening against a dense eigendecomposition, exact deviations, repeated variances, unusable vectors."""

import numpy as np
import pytest

from stakefold.llm import queries, whitening


def naive(rows, scale=256, most=4):
    """(vec_id, x) to n, S, V's eigenvalues and vectors, and the rows."""
    kept = [(k, [int(np.floor(scale * float(v))) for v in c]) for k, c in rows
            if c is not None and len(c) and all(v is not None and np.isfinite(v) for v in c)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    y = np.array([[(n * v - s) / n for v, s in zip(x, sums, strict=True)] for x in distinct])
    e, vectors = np.linalg.eigh(y.T @ y / n)
    return n, sums, e[::-1], vectors[:, ::-1], kept


def compare(found, rows, most=4, simple=True):
    n, sums, e, vectors, kept = naive(rows)
    rank = min(most, int((e > 1e-9 * e[0]).sum()))
    assert len(found) == rank * len(kept)
    deviation = {}
    for k, x in kept:
        deviation.setdefault(k, set()).add(sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True)))
    for r in found:
        assert r.n == n and r.deviation in deviation[r.vec_id] and 0 <= r.identity_error <= 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-10)
    if simple:  # no two variances alike: components are unique up to the sign
        at = {}
        for k, x in kept:
            at.setdefault(k, x)
        for i in range(rank):
            mine = {r.vec_id: r.whitened for r in found if r.component == i + 1}
            want = {k: (np.array(x) - np.array(sums) / n) @ vectors[:, i] / np.sqrt(e[i]) for k, x in at.items()}
            sign = np.sign(sum(mine[k] * want[k] for k in mine))
            assert max(abs(mine[k] - sign * want[k]) for k in mine) < 1e-8


def test_query_by_dense_eigenvectors(spark, folder):
    import duckdb

    rows = duckdb.sql(f"select vec_id, embedding from '{folder}/embeddings.parquet'").fetchall()
    found = queries.op11_whitening(spark, folder)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(found.collect(), rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, x array<long>, c double, label int")


def test_decaying_spectrum_stops_early_and_is_exact(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((400, 24)) @ np.diag(0.3 ** np.arange(24)) * 50 + 1000
    rows = [(i, c.tolist(), None, None, None) for i, c in enumerate(data)]
    passes, summed = [], whitening.summed
    monkeypatch.setattr(whitening, "summed", lambda *a: passes.append(1) or summed(*a))
    compare(whitening.whiten(spark, frame(spark, rows)).collect(), [r[:2] for r in rows])
    assert len(passes) < 24


def test_repeated_variances_and_low_rank(spark):
    corners = [(i, [float(s * (i % 5 == j)) for j in range(5)], None, None, None) for i in range(5) for s in (1, -1)]
    found = whitening.whiten(spark, frame(spark, corners)).collect()
    compare(found, [r[:2] for r in corners], simple=False)
    assert {r.component for r in found} == {1, 2, 3, 4}
    line = [(i, [i / 4, -i / 2, 3.0], None, None, None) for i in range(9)]
    found = whitening.whiten(spark, frame(spark, line)).collect()
    compare(found, [r[:2] for r in line])
    assert {r.component for r in found} == {1}


def test_unusable_repeated_and_huge(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, 0.25]), (1, [0.5, 1.0, 0.25]), (2, [-0.5, 0.125, 2.0]), (None, [3.0, 1.0, 1.5]), (4, [0.1, -0.7, 0.2]),
            (5, [0.1, -0.7, 0.2]), (6, [-0.001, 0.0, 9.0])]
    bad = [(7, None), (8, []), (9, [1.0, None, 2.0]), (10, [nan, 1.0, 1.0]), (11, [1.0, inf, 1.0]), (12, [1.0, -inf, 1.0]), (13, [1.0, 2.0])]
    rows = [(k, c, None, None, None) for k, c in good + bad]
    compare(whitening.whiten(spark, frame(spark, rows)).collect(), good)
    huge = [(1, [1e300, 0.0], None, None, None), (2, [-1e300, 1.0], None, None, None), (3, [0.0, 2.0], None, None, None)]
    found = whitening.whiten(spark, frame(spark, huge)).collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and {r.deviation for r in found if r.vec_id < 3} == {None}


def test_nothing_to_learn(spark):
    assert whitening.whiten(spark, frame(spark, [])).collect() == []
    same = [(i, [1.0, 2.0], None, None, None) for i in range(4)]
    assert whitening.whiten(spark, frame(spark, same)).collect() == []
