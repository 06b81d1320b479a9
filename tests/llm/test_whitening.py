"""Whitening against the eigenvectors of the covariance in NumPy."""

import math

import numpy as np
import pytest

from weatherlake.llm.whitening import fit_whitening, whiten


def frame(spark, rows, more="vec_id long, embedding array<float>"):
    return spark.createDataFrame(rows, more)


def exact(rows):
    """vec_id -> fixed-point vector, for the rows that take part."""
    return [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e)) for i, e in rows
            if e is not None and all(c is not None and math.isfinite(c) for c in e)]


def check(out, rows, most=16):
    kept = exact(rows)
    fit = sorted({x for _, x in kept})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dim)]
    centred = (np.array(fit) - np.array(sums) / n)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, int((values > values[0] * 1e-12).sum()))
    got = {}
    for r in out:
        got.setdefault((r.vec_id, r.deviation, r.n), {}).setdefault(r.component, []).append(r)
    assert len(out) == len(kept) * count
    by_vector = dict(kept)
    signs = {}
    for (i, deviation, size), parts in got.items():
        x = by_vector[i]
        assert size == n and deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert sorted(parts) == list(range(1, count + 1))
        for k, rs in parts.items():
            want = (np.array(x) - np.array(sums) / n) @ vectors[:, k - 1] / math.sqrt(values[k - 1])
            for r in rs:
                if abs(want) > 1e-3:
                    signs.setdefault(k, set()).add(np.sign(want * r.whitened))
                assert abs(abs(r.whitened) - abs(want)) < 1e-6 * max(1, abs(want))
                assert abs(r.explained - values[k - 1] / values.sum()) < 1e-9
                assert 0 <= r.identity_error < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def vectors(n, dim, seed=0):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dim)) * np.linspace(3, 0.3, dim) + r.standard_normal(dim) * 5
    return [(k, [float(c) for c in row]) for k, row in enumerate(x)]


@pytest.mark.parametrize("n, dim, most", [(300, 20, 16), (40, 6, 16), (500, 8, 3), (10, 12, 16)])
def test_against_eigenvectors(spark, n, dim, most):
    rows = vectors(n, dim)
    out = whiten(frame(spark, rows), components=most)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), rows, most)


def test_repeats_count_once_in_the_fit(spark):
    rows = vectors(60, 5)
    rows += [(100 + k, rows[0][1]) for k in range(50)] + [rows[3], rows[3]]
    check(whiten(frame(spark, rows)).collect(), rows)


def test_equal_eigenvalues_are_all_found(spark):
    # the corners of a cross: four equal eigenvalues
    rows = [(2 * d + s, [float(10 * (2 * s - 1)) if k == d else 0.0 for k in range(4)]) for d in range(4) for s in (0, 1)]
    out = whiten(frame(spark, rows)).collect()
    assert len(out) == 8 * 4 and all(abs(r.explained - 0.25) < 1e-12 and r.identity_error < 1e-9 for r in out)
    per = {}
    for r in out:
        per.setdefault(r.vec_id, []).append(r.whitened)
    assert all(abs(sum(w * w for w in ws) - 4) < 1e-9 for ws in per.values())


def test_rows_that_take_no_part(spark):
    rows = vectors(30, 4)
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0]), (104, [])]
    extra = frame(spark, rows + bad).selectExpr("vec_id", "embedding", "'a' as id", "1 as x", "2 as component", "3 as n")
    check(whiten(extra).collect(), rows)
    assert whiten(extra.limit(0)).collect() == []
    assert whiten(extra.filter("vec_id >= 100")).collect() == []
    assert whiten(extra.filter("vec_id = 3")).collect() == []  # one vector has no directions


def test_null_ids_and_lengths_each_for_themselves(spark):
    three, five = vectors(20, 3), [(100 + k, e) for k, e in vectors(25, 5, 1)]
    out = whiten(frame(spark, three + five + [(None, three[0][1])])).collect()
    check([r for r in out if r.vec_id is not None and r.vec_id < 100], three)
    check([r for r in out if r.vec_id is not None and r.vec_id >= 100], five)
    assert len([r for r in out if r.vec_id is None]) == 3


def test_huge_entries(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 2.0]), (2, [3.0, 3.0]), (3, [4.0, 1.0])]
    out = whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in out} == {0, 1, 2, 3}
    assert all(r.deviation is None for r in out if r.vec_id < 2) and all(math.isfinite(r.whitened) for r in out)


def test_model(spark):
    x = frame(spark, [([1, 2],), ([1, 2],), ([3, 2],), ([5, 2],)], "x array<long>")
    m = fit_whitening(x, 2)
    assert (m.n, m.sums) == (3, (9, 6)) and m.components.shape == (2, 1) and abs(abs(m.components[0, 0]) - 1) < 1e-12
    assert abs(m.eigenvalues[0] - 8 / 3) < 1e-12 and fit_whitening(x.limit(0), 2) is None
