"""Whitening of vectors by singular values of their centred rows, found by a bidiagonal qd method.

Spark adds up the rows exactly and reduces the centred rows to triangles, block by block. The
triangle of all rows, as large as a vector is long, is made bidiagonal by Householder reflections;
dqds finds the squares of its singular values to high relative accuracy, and for each of them a
twisted factorisation gives the direction. Nothing is squared before the singular values are known,
so small ones keep their digits. A second pass over the rows measures what whitening achieved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import batches_of, common_length, scaled

SCALE, SHIFT = 64, 1_000_000  # a component c becomes floor(64 c) + 1,000,000
COMPONENTS = 32
TRIANGLES = 64  # tasks that merge the blocks' triangles before the last merge
ROWS = 2000  # rows handed back at once
_EPS = float(np.finfo(float).eps)
_CLOSE = 1e-3  # singular values nearer than this, relative to their size, are made orthogonal explicitly


def bidiagonal(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right factor `v` of a square matrix: u' a v is bidiagonal."""
    a = np.array(triangle, float)
    size = a.shape[0]
    v = np.eye(size)
    for k in range(size):
        reflect = _reflection(a[k:, k])
        a[k:, k:] -= np.outer(reflect, 2 * (reflect @ a[k:, k:]))
        if k < size - 2:
            reflect = _reflection(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ reflect), reflect)
            v[:, k + 1 :] -= np.outer(2 * (v[:, k + 1 :] @ reflect), reflect)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflection(x: np.ndarray) -> np.ndarray:
    """Unit vector whose reflection turns `x` to its first axis; zero if `x` lies there."""
    if not x[1:].any():
        return np.zeros_like(x)
    scale = np.abs(x).max()
    out = x / scale
    out[0] += np.copysign(np.linalg.norm(out), out[0])
    return out / np.linalg.norm(out)


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, by the differential qd method with shifts.

    Each step first passes without a shift, which gives the diagonal of the inverse and with it a
    shift that is never too large. The last entry is taken off once its neighbour is negligible.
    """
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper]
    found, total = [], 0.0
    while q:
        while len(q) > 1 and e[-1] > (_EPS / 8) ** 2 * (total + q[-1]):
            q, e, lows = _step(q, e, 0.0)
            shift = (1 - 8 * len(q) * _EPS) / sum(1 / low for low in lows) if min(lows) > 0 else 0.0
            if shift <= _EPS / 4 * total:  # beyond what the value found still shows
                continue
            while shift:
                shifted = _step(q, e, shift)
                if min(shifted[2]) >= 0:
                    q, e, total = shifted[0], shifted[1], total + shift
                    break
                shift = shift / 2 if shift > _EPS * max(q) else 0.0
        found.append(total + q.pop())
        if e:
            e.pop()
    return np.array(sorted(found, reverse=True))


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One transformation: the new arrays, and the running differences, whose signs tell whether the shift was too large."""
    d = q[0] - shift
    lows, above, beside = [d], [], []
    for k in range(len(e)):
        if d < 0:
            break
        whole = d + e[k]
        ratio = q[k + 1] / whole if whole > 0 else 1.0
        above.append(whole)
        beside.append(e[k] * ratio)
        d = d * ratio - shift
        lows.append(d)
    return [*above, d], beside, lows


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """A unit vector, as a column, for each of the falling squares: right singular vectors of a bidiagonal matrix without zeros."""
    out = np.zeros((len(diagonal), len(squares)))
    for i, square in enumerate(squares):
        first = i
        while first and squares[first - 1] - squares[first] <= _CLOSE * squares[first - 1]:
            first -= 1
        near = out[:, first:i]  # of almost the same value: the rows' digits leave some of them in the vector
        for vector in _twisted(diagonal, upper, square):
            vector = vector - near @ (near.T @ vector)
            vector -= near @ (near.T @ vector)
            if np.linalg.norm(vector) > 1e-2:
                break
        out[:, i] = vector / np.linalg.norm(vector)
    return out


def _twisted(diagonal: np.ndarray, upper: np.ndarray, square: float) -> Iterator[np.ndarray]:
    """Solutions of (b'b - square) z = gamma e_k from factorisations that meet at row k, the smallest gamma first."""
    size = len(diagonal)
    d, ld, lld = diagonal**2, diagonal[:-1] * upper, upper**2  # b'b = l d l', with l = upper / diagonal
    tiny = _EPS * _EPS * max(float(d.max()), 1e-300)
    down, up = np.zeros(size - 1), np.zeros(size - 1)
    s, p = np.empty(size), np.empty(size)
    s[0] = -square
    for i in range(size - 1):
        down[i] = ld[i] / _away(s[i] + d[i], tiny)
        s[i + 1] = down[i] * (upper[i] / diagonal[i]) * s[i] - square
    p[-1] = d[-1] - square
    for i in range(size - 2, -1, -1):
        pivot = _away(lld[i] + p[i + 1], tiny)
        up[i] = ld[i] / pivot
        p[i] = p[i + 1] * (d[i] / pivot) - square
    for k in np.argsort(np.abs(s + p + square), kind="stable"):
        z = np.zeros(size)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(k, size - 1):
            z[i + 1] = -up[i] * z[i]
        yield z / np.linalg.norm(z)


def _away(pivot: float, tiny: float) -> float:
    return pivot if abs(pivot) > tiny else (-tiny if pivot < 0 else tiny)


def directions(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and unit right singular vectors of a triangle, as columns.

    Values that are zero to the precision of the triangle are left out with their vectors. Of a
    vector's two signs the one whose largest entry is positive is taken.
    """
    size = triangle.shape[0]
    scale = float(np.abs(triangle).max(initial=0.0))
    if not scale:
        return np.empty(0), np.empty((size, 0))
    diagonal, upper, v = bidiagonal(triangle / scale)
    least = _EPS**2  # in place of zeros, which the qd method would divide by; far below what counts as zero
    diagonal = np.where(np.abs(diagonal) < least, least, diagonal)
    # Where the upper diagonal is zero to the precision of the reflections, the matrix falls into blocks
    # whose vectors have no entry in common; so values that several directions share are found in several blocks.
    cuts = [0, *(np.flatnonzero(np.abs(upper) <= _EPS * np.abs(diagonal).max()) + 1), size]
    found = [(square, begin, end) for begin, end in zip(cuts, cuts[1:]) for square in squared_singular_values(diagonal[begin:end], upper[begin : end - 1])]
    least = (size * _EPS) ** 2 * max(found)[0]
    squares, vectors = [], np.zeros((size, 0))
    for begin, end in zip(cuts, cuts[1:]):
        own = np.array([square for square, at, _ in found if at == begin and square > least])
        block = np.zeros((size, len(own)))
        block[begin:end] = right_vectors(diagonal[begin:end], upper[begin : end - 1], own)
        squares, vectors = [*squares, *own], np.hstack([vectors, block])
    order = np.argsort(-np.array(squares), kind="stable")
    squares, vectors = np.array(squares)[order], v @ vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    return squares * scale**2, vectors * np.where(vectors[largest, range(len(squares))] < 0, -1.0, 1.0)


def whole_numbers(vectors: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    places, x = scaled(vectors, length, SCALE)
    return places, x + SHIFT


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs where they fit, else as Python's integers."""
    if n * int(np.abs(x).max(initial=0)) < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(apart: np.ndarray, n: int) -> np.ndarray:
    return (apart / n).astype(np.float64)  # x - S/n, rounded once


def _deviations(apart: np.ndarray) -> list[int] | np.ndarray:
    if int(np.abs(apart).max(initial=0)) ** 2 * apart.shape[1] < 1 << 62:
        return (apart * apart).sum(axis=1)
    return [sum(int(x) ** 2 for x in row) for row in apart]


def _sums(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of usable rows, and the exact sum of each of their dimensions."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, total = 0, np.zeros(length, object)
        for batch in batches:
            _, x = whole_numbers(batch.column(0), length)
            n += len(x)
            total += x.sum(axis=0).astype(object) if int(np.abs(x).max(initial=0)) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
        if n:
            yield {"place": range(length + 1), "total": [str(t) for t in [*total, n]]}

    parts = batches_of(vectors.select("vector"), add, "place int, total string")
    totals = dict(parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect())
    return int(totals.get(length, 0)), [int(totals.get(k, 0)) for k in range(length)]


def _merged(parts: DataFrame, size: int, merge) -> np.ndarray | None:
    """Square matrices of all tasks merged into one: in `TRIANGLES` tasks, then what these give on the driver."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        whole = None
        for batch in batches:
            for block in batch.column(0).to_pylist():
                one = np.frombuffer(block).reshape(-1, size)
                whole = one if whole is None else merge(whole, one)
        if whole is not None:
            yield {"block": [np.ascontiguousarray(whole).tobytes()]}

    whole = None
    for row in batches_of(parts.repartition(TRIANGLES), some, "block binary").collect():
        one = np.frombuffer(row.block).reshape(-1, size)
        whole = one if whole is None else merge(whole, one)
    return whole


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (`vec_id`, `component` from 1, `n`, `deviation`, `whitened`, `explained`, `identity_error`), by falling variance.

    The fit covers all usable rows: vectors that are not null, with neither nulls nor infinite
    entries, of the length that most vectors have (of equally common lengths the larger). `whitened`
    is the centred row along the component over the component's standard deviation; `explained` the
    component's share of the variance; `deviation` the exact squared distance of n x from the sums;
    `identity_error` the largest entry by which the covariance of `whitened` departs from one.

    Components without variance (constant dimensions, fewer rows than dimensions) cannot be whitened
    and are left out, so equal rows only, one row or an empty table give no rows. Repeated rows and
    null ids are rows like others. Other columns are not read, whatever their names. Whole numbers that
    no long holds are an error, as in SQL.

    Four passes over the rows, without shuffling them: sums, triangles, the error, the result.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    length = common_length(source, "vector")
    n, sums = _sums(source, length)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        triangle = np.empty((0, length))
        for batch in batches:
            _, x = whole_numbers(batch.column(0), length)
            if len(x):
                triangle = _triangle(np.vstack([triangle, _centred(_apart(x, n, sums), n)]))
        if len(triangle):
            yield {"block": [np.ascontiguousarray(triangle).tobytes()]}

    triangle = None
    if n:
        blocks = batches_of(source.select("vector"), reduce, "block binary")
        triangle = _merged(blocks, length, lambda a, b: _triangle(np.vstack([a, b])))
    if triangle is None:
        return vectors.sparkSession.createDataFrame([], schema)
    triangle = np.vstack([triangle, np.zeros((length - len(triangle), length))])
    squares, along = directions(triangle)
    squares, along = squares[:components], along[:, :components]
    if not len(squares):
        return vectors.sparkSession.createDataFrame([], schema)
    weights = along / np.sqrt(squares / n)  # as long as a vector by at most `components`, in every task
    shares = squares / (triangle**2).sum()
    width = len(squares)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        whole = np.zeros((width, width))
        for batch in batches:
            _, x = whole_numbers(batch.column(0), length)
            white = _centred(_apart(x, n, sums), n) @ weights  # of centred rows, so centred
            whole += white.T @ white
        yield {"block": [whole.tobytes()]}

    covariance = _merged(batches_of(source.select("vector"), multiply, "block binary"), width, np.add) / n
    error = float(np.abs(covariance - np.eye(width)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            places, x = whole_numbers(batch.column(1), length)
            ids = batch.column(0).take(pa.array(places))
            for at in range(0, len(x), ROWS):
                apart = _apart(x[at : at + ROWS], n, sums)
                rows = len(apart)
                every = np.repeat(np.arange(rows), width)
                yield {
                    "vec_id": ids.slice(at, rows).take(pa.array(every)),
                    "component": np.tile(np.arange(1, width + 1, dtype=np.int32), rows),
                    "n": np.full(rows * width, n),
                    "deviation": pa.array(_deviations(apart), pa.int64()).take(pa.array(every)),
                    "whitened": (_centred(apart, n) @ weights).ravel(),
                    "explained": np.tile(shares, rows),
                    "identity_error": np.full(rows * width, error),
                }

    return batches_of(source, project, schema)
