"""Vectors as exact integers: which rows take part, and numbers that stay exact however large."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EXACT = 1 << 52  # doubles hold whole numbers below twice this
_LONG = 1 << 62


def common_length(vectors: DataFrame, vector_col: str) -> int:
    """The length that most vectors have, of equally common ones the larger; 0 without any vector."""
    lengths = vectors.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("size")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else 0


def scaled(vectors: pa.Array, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a batch, and floor(scale * component) of these, a row each.

    Usable is what is not null, has `length` components, and none that is null, infinite or no number.
    """
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), length), False)
    flat = vectors.filter(right).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    rows = flat.reshape(-1, length) if length else np.empty((0, 0))
    finite = np.isfinite(rows).all(axis=1)
    places = np.flatnonzero(right.to_numpy(zero_copy_only=False))[finite]
    whole = np.floor(rows[finite] * scale)
    if np.abs(whole).max(initial=0) >= _LONG:
        raise OverflowError("a component does not fit a long once scaled")
    return places, whole.astype(np.int64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices; more than a long holds is an error, as in SQL."""
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < _EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if bound < _LONG:
        return left @ right.T
    found = left.astype(object) @ right.T.astype(object)
    if found.size and max(abs(found.min()), abs(found.max())) >= 1 << 63:
        raise OverflowError("a score does not fit a long")
    return found.astype(np.int64)


def batches_of(df: DataFrame, run, schema: str) -> DataFrame:
    """`mapInArrow` with a function from an iterator of batches to dictionaries of columns."""
    arrow = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], names=arrow.names)

    return df.mapInArrow(each, schema)
