from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorflow.llm import whitening
from sensorflow.llm.whitening import bidiagonal, directions, squared_singular_values, whiten

NAN, INF = math.nan, math.inf


def square(rows):
    rows = np.asarray(rows, float)
    triangle = np.linalg.qr(rows, mode="r")
    return np.vstack([triangle, np.zeros((rows.shape[1] - len(triangle), rows.shape[1]))])


def agrees(rows, precision=1e-9):
    triangle = square(rows)
    squares, along = directions(triangle)
    values = np.linalg.svd(triangle, compute_uv=False)
    rank = int((values > max(triangle.shape) * np.finfo(float).eps * max(values[0], 1e-300)).sum())
    assert len(squares) == rank
    np.testing.assert_allclose(np.sqrt(squares), values[:rank], rtol=1e-12, atol=1e-14 * values[0])
    np.testing.assert_allclose(along.T @ along, np.eye(rank), atol=precision)
    if rank:
        np.testing.assert_allclose(triangle.T @ (triangle @ along), along * squares, atol=precision * squares[0])


RNG = np.random.default_rng(3)
TURN = np.linalg.qr(RNG.normal(size=(24, 24)))[0]


@pytest.mark.parametrize(
    "rows",
    [
        RNG.normal(size=(400, 64)),
        np.round(RNG.normal(size=(400, 24)) * 8),
        RNG.normal(size=(7, 24)),  # fewer rows than dimensions
        np.eye(24),  # one value for all directions
        np.diag([5, 5, 5, 4, 4, 3, 2, 2, 0, 0]),
        (TURN * np.repeat([3, 2, 1, 0.5], 6)) @ TURN.T,  # values that six directions share
        (TURN * (1 + 1e-9 * np.arange(24))) @ TURN.T,
        RNG.normal(size=(60, 6)) @ RNG.normal(size=(6, 24)),  # rank six
        np.kron(np.eye(4), RNG.normal(size=(9, 5))),
        RNG.normal(size=(50, 12)) * 10.0 ** -np.arange(12),
        np.zeros((5, 4)),
        [[3.0]],
    ],
)
def test_directions_equal_a_full_decomposition(rows):
    agrees(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=5, max_size=5), min_size=1, max_size=9))
def test_small_whole_numbers(rows):
    agrees(rows)


def test_small_singular_values_keep_their_digits():
    """Of a bidiagonal matrix; a method that squares it first loses values below the root of the precision."""
    diagonal, upper = 10.0 ** -np.arange(0, 24, 2.0), 10.0 ** -np.arange(1, 23, 2.0)
    found = np.sqrt(squared_singular_values(diagonal, upper))
    product = np.prod(diagonal)  # of all singular values as well
    assert math.isclose(np.prod(found), product, rel_tol=1e-12)
    inverse = np.linalg.inv(np.diag(diagonal) + np.diag(upper, 1))
    assert math.isclose(found[-1], 1 / np.linalg.norm(inverse, 2), rel_tol=1e-10)


def test_reflections_leave_a_bidiagonal_matrix():
    a = RNG.normal(size=(9, 9))
    diagonal, upper, v = bidiagonal(a)
    b = np.diag(diagonal) + np.diag(upper, 1)
    np.testing.assert_allclose(v.T @ v, np.eye(9), atol=1e-13)
    np.testing.assert_allclose(v @ b.T @ b @ v.T, a.T @ a, atol=1e-12)


def plain(rows, components=32):
    """The same from all rows at once: (id, component) to (n, deviation, |whitened|, explained)."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept])
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    share = values[order] / values.sum()
    return sorted((i, k + 1, n, int((apart[r] ** 2).sum()), abs(white[r, k]), share[k]) for r, (i, _) in enumerate(kept) for k in range(len(order)))


def test_whole_query_equals_one_decomposition(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 7)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(RNG.normal(size=(300, 40)) * np.linspace(0.5, 2, 40))]
    rows += [(900, None), (901, [None, *rows[0][1][1:]]), (902, [NAN, *rows[0][1][1:]]), (903, [-INF, *rows[0][1][1:]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = whiten(frame).collect()
    expected = plain(rows)
    assert len(found) == len(expected) == 300 * 32
    for row, (i, k, n, deviation, white, share) in zip(sorted(found, key=lambda r: (r.vec_id, r.component)), expected):
        assert (row.vec_id, row.component, row.n, row.deviation) == (i, k, n, deviation)
        assert math.isclose(abs(row.whitened), white, rel_tol=1e-8, abs_tol=1e-9) and math.isclose(row.explained, share, rel_tol=1e-10)
        assert row.identity_error < 1e-10
    first = {r.vec_id: r.whitened for r in found if r.component == 1}  # one sign for all rows
    x = np.array([first[i] for i in range(300)])
    assert abs(x.mean()) < 1e-10 and math.isclose(x.var(), 1, rel_tol=1e-10)


def test_numbers_beyond_a_long_stay_exact():
    x = np.array([[2**60, -(2**60)], [2**60 + 3, 5]])
    n, sums = 7, [sum(map(int, x[:, k])) for k in range(2)]
    apart = whitening._apart(x, n, sums)
    assert apart.tolist() == [[n * int(c) - s for c, s in zip(row, sums)] for row in x]
    assert whitening._deviations(apart)[1] == sum(int(c) ** 2 for c in apart[1])
    with pytest.raises(OverflowError):
        whitening.whole_numbers(__import__("pyarrow").array([[1e30]]), 1)


def test_rows_of_every_kind(spark):
    schema = "vec_id long, embedding array<float>, label int, component string, n string"
    rows = [
        (1, [1.0, 2.0, 5.0], 1, "x", "y"), (1, [1.0, 2.0, 5.0], 1, "x", "y"), (None, [3.0, 1.0, 5.0], None, None, None), (2, [0.0, 0.5, 5.0], 1, "x", "y"),
        (3, None, 1, "x", "y"), (4, [], 1, "x", "y"), (5, [1.0], 1, "x", "y"), (6, [None, 1.0, 1.0], 1, "x", "y"), (7, [1.0, INF, 1.0], 1, "x", "y"),
    ]
    frame = spark.createDataFrame(rows, schema)
    found = whiten(frame).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]  # the third dimension is constant
    assert {r.n for r in found} == {4} and all(r.identity_error < 1e-12 for r in found)
    assert math.isclose(sum({r.component: r.explained for r in found}.values()), 1)
    for none in (frame.limit(0), frame.where("vec_id = 3"), frame.where("vec_id = 1"), frame.where("vec_id = 4")):
        empty = whiten(none)
        assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
