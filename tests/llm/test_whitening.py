import math
from collections import Counter

import numpy as np
import pytest

from meterlake.llm.eigen import below, largest, leading, tridiagonal
from meterlake.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, n int, label int"


def fit(rows):
    """Whole vectors that take part, by row, and the distinct ones' mean and covariance."""
    width = max((len(v) for _, v in rows if v is not None), default=0)
    kept = []
    for vec_id, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(64 * c) + 1000000 for c in v]
        kept.append((vec_id, tuple(x + [1000000] * (width - len(x)))))
    distinct = sorted({x for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in distinct])
    return kept, n, sums, centred.T @ centred / max(n, 1)


def check(rows, found, components=16):
    kept, n, sums, covariance = fit(rows)
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    count = min(components, int((values > 1e-10 * values[0]).sum()))
    want, got = Counter(), Counter()
    for vec_id, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for c in range(count):
            want[vec_id, c + 1, deviation] += 1
    by_row = {}
    for r in found:
        assert r["n"] == n
        got[r["vec_id"], r["component"], int(r["deviation"])] += 1
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        assert 0 <= r["identity_error"] <= 1e-6
        by_row[r["vec_id"], int(r["deviation"]), r["component"]] = r["whitened"]
    assert got == want
    gaps = np.abs(np.diff(values, append=0))
    for c in range(count):
        if min(gaps[c], gaps[c - 1] if c else np.inf) < 1e-3 * values[0]:
            continue
        exact, made = [], []
        for vec_id, x in kept:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            centred = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
            exact.append(centred @ basis[:, c] / math.sqrt(values[c]))
            made.append(by_row[vec_id, deviation, c + 1])
        exact, made = np.array(exact), np.array(made)
        sign = np.sign(exact @ made)
        assert np.abs(exact - sign * made).max() < 1e-7 * max(1, np.abs(exact).max())


def test_equals_dense_solution(stored_table):
    draw = np.random.default_rng(1)
    mix = draw.normal(size=(24, 24)) * np.geomspace(1, 0.05, 24)
    rows = [(i, (draw.normal(size=24) @ mix.T + 3).tolist()) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(300)] + [rows[3], rows[3]]
    table = stored_table([(i, v, 5, 6) for i, v in rows], SCHEMA)
    check(rows, whiten(table, ["vec_id"]).collect())
    check(rows, whiten(table, ["vec_id"], components=3).collect(), 3)


def test_odd_vectors_and_clashing_columns(stored_table):
    rows = [
        (1, [0.5, 1.25, -3.0]), (2, [0.25]), (2, [0.25, 0.0]), (3, []), (4, None), (5, [None, 1.0, 1.0]),
        (6, [math.nan, 1.0, 2.0]), (7, [math.inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
        (8, [3e6, 1.0, 1.0]), (9, [-1e9, 7.0, 0.5]), (10, [0.1, 0.2, 0.3]), (10, [0.1, 0.2, 0.3]),
    ]
    table = stored_table([(i, v, 5, 6) for i, v in rows], SCHEMA)
    found = whiten(table, ["vec_id"]).collect()
    kept, n, sums, _ = fit(rows)
    assert {r["vec_id"] for r in found} == {i for i, _ in kept}
    assert {r["n"] for r in found} == {n}
    exact = {(i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in kept}
    assert {(r["vec_id"], int(r["deviation"])) for r in found} == exact
    assert all(r["identity_error"] < 1e-4 for r in found)
    renamed = table.withColumnRenamed("vec_id", "_x").withColumnRenamed("n", "_length")
    again = whiten(renamed, ["_x", "_length"]).collect()
    assert Counter(r["_x"] for r in again) == Counter(r["vec_id"] for r in found)


def test_no_variance_no_rows(stored_table):
    assert whiten(stored_table([], SCHEMA), ["vec_id"]).collect() == []
    same = stored_table([(1, [1.0, 2.0], 1, 1), (2, [1.0, 2.0], 1, 1)], SCHEMA)
    assert whiten(same, ["vec_id"]).collect() == []
    assert whiten(stored_table([(1, [], 1, 1)], SCHEMA), ["vec_id"]).collect() == []


def test_entries_beyond_a_long_take_no_part(stored_table):
    rows = [(1, [1e300, 0.0]), (2, [1.0, 2.0]), (3, [2.0, 2.0]), (4, [1e16, 3.0])]
    found = whiten(stored_table([(i, v, 1, 1) for i, v in rows], SCHEMA), ["vec_id"]).collect()
    assert {r["vec_id"] for r in found} == {2, 3, 4}
    _, n, sums, _ = fit(rows[1:])
    x = [math.floor(64 * c) + 1000000 for c in rows[3][1]]
    want = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
    assert {int(r["deviation"]) for r in found if r["vec_id"] == 4} == {want}


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1.0, 41), np.ones(20), np.r_[np.full(10, 5.0), np.full(10, 1.0)], np.r_[1e9, np.ones(11)],
        np.r_[3.0, 3.0 - 1e-9, 3.0 - 2e-9, 1.0, 1e-6], [2.0], [2.0, 1.0], np.r_[np.zeros(6), 1.0],
    ],
)
def test_eigenpairs(values):
    values = np.sort(values)[::-1]
    draw = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(draw.normal(size=(len(values), len(values))))
    for matrix in (q * values @ q.T, np.diag(draw.permutation(values))):
        matrix = (matrix + matrix.T) / 2
        k = min(16, len(values))
        found, basis = leading(matrix, 16)
        assert np.abs(found - values[:k]).max() < 1e-13 * len(values) * values[0]
        assert np.abs(basis.T @ basis - np.eye(k)).max() < 1e-11
        assert np.abs(matrix @ basis - basis * found).max() < 1e-12 * len(values) * values[0]


def test_counts_of_eigenvalues():
    draw = np.random.default_rng(5)
    matrix = draw.normal(size=(30, 30))
    matrix = matrix + matrix.T
    diagonal, off, _ = tridiagonal(matrix)
    values = np.linalg.eigvalsh(matrix)
    points = np.linspace(values[0] - 1, values[-1] + 1, 200)
    assert below(diagonal, off, points).tolist() == [(values < p).sum() for p in points]
    assert np.allclose(largest(diagonal, off, 30), values[::-1], rtol=0, atol=1e-12 * 30)
