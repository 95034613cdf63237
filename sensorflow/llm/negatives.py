"""Hard negatives by a secondary sort: rows that score a little below an anchor's positives.

Every pair is scored once for the positives and once for the negatives, in cells of some anchors by
some rows. A cell passes on only what can still count: the best positives of each anchor, and the
first negatives of each window between two shares of a positive's score. These pairs are packed
into keys whose bytes sort by anchor, falling score, positives first, and id; the keys are shuffled
by anchor and sorted within partitions, and an iterator goes through them once: a positive opens its
window, a negative goes to every open window it lies in, and a window closes when it is full or
passed. It holds the open windows of one anchor, never an anchor's rows.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored, width
from .vectors import batches_of, common_length, products, scaled

SCALE = 256  # a component x counts as floor(256 x)
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a window, in hundredths of the positive's score
ANCHORS, ROWS = 16_384, 524_288  # of a cell, about
_TILE = 1 << 21  # scores held at once
_PENDING = 1 << 18  # pairs of a cell held before the best are picked out

_KEY = struct.Struct(">QQQBQ")  # anchor's number and id, score from above, 0 for positives, id
_FLIP = 1 << 63  # makes signed numbers sort as unsigned ones
_TOP = (1 << 64) - 1
_WINDOWS = "number long, anchor_id long, positive_id long, positive_score long"


def _packed(number: np.ndarray, anchor: np.ndarray, score: np.ndarray, kind: int, other: np.ndarray) -> bytes:
    rows = np.empty(len(number), [("n", ">u8"), ("a", ">u8"), ("s", ">u8"), ("k", "u1"), ("o", ">u8")])
    flip = np.uint64(_FLIP)
    rows["n"], rows["a"], rows["k"], rows["o"] = number, anchor.view(np.uint64) ^ flip, kind, other.view(np.uint64) ^ flip
    rows["s"] = ~(score.view(np.uint64) ^ flip)
    return rows.tobytes()


def unpacked(key: bytes) -> tuple[int, int, int, int, int]:
    """Anchor's number and id, score, kind and id of a key."""
    number, anchor, score, kind, other = _KEY.unpack(key)
    return number, (anchor ^ _FLIP) - _signed(anchor), (_TOP - score ^ _FLIP) - _signed(_TOP - score), kind, (other ^ _FLIP) - _signed(other)


def _signed(flipped: int) -> int:
    return 0 if flipped & _FLIP else 1 << 64


def _sorted_keys(packs: DataFrame, tasks: int):
    """Keys of all packs, each anchor's in one task and in order, spilled to disk where they are many."""
    size = _KEY.size
    keys = packs.rdd.flatMap(lambda row: ((row[0][at : at + size], None) for at in range(0, len(row[0]), size)))
    return keys.repartitionAndSortWithinPartitions(tasks, lambda key: zlib.crc32(key[:8])).keys()


def first_positives(keys: Iterator[bytes], most: int) -> Iterator[tuple[int, int, int, int]]:
    """The first `most` of each anchor: number, anchor, id, score."""
    current, seen = None, 0
    for key in keys:
        number, anchor, score, _, other = unpacked(key)
        if number != current:
            current, seen = number, 0
        if seen < most:
            seen += 1
            yield number, anchor, other, score


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest whole score s with low * score <= 100 s <= high * score."""
    return -(-low * score // 100), high * score // 100


def mined(keys: Iterator[bytes], most: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Walks through sorted keys; for each positive the first `most` negatives of its window."""
    current, windows = None, []
    for key in keys:
        number, anchor, score, kind, other = unpacked(key)
        if number != current:
            current, windows = number, []
        if kind == 0:
            windows.append([other, score, *window(score, low, high), 0])
            continue
        for opened in windows:
            positive, positive_score, least, greatest, count = opened
            if count < most and least <= score <= greatest:
                opened[4] = count + 1
                yield anchor, positive, count + 1, other, positive_score, score
        if any(opened[4] >= most or score < opened[2] for opened in windows):
            windows = [opened for opened in windows if opened[4] < most and score >= opened[2]]


def _usable(vectors: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """Rows that take part: `id`, `label`, `anchor` and the scaled vector as little-endian longs."""
    source = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull())
    length = common_length(source, "vector")

    def scale_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            places, x = scaled(batch.column("vector"), length, scale)
            kept = batch.select(["id", "label", "anchor"]).take(pa.array(places))
            yield {name: kept.column(name) for name in kept.schema.names} | {"q": [row.tobytes() for row in x]}

    return stored(batches_of(source, scale_batches, "id long, label long, anchor boolean, q binary"), "vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    blocks = column.to_pylist()
    return np.frombuffer(b"".join(blocks), np.int64).reshape(len(blocks), -1)


class _Cell:
    """Best pairs of the anchors of one cell with the rows that have come by, positives or negatives."""

    def __init__(self, most: int, windows: tuple[int, int] | None = None):
        self.most, self.windows = most, windows  # without windows: positives
        self.reset()

    def reset(self) -> None:
        self.anchors: list[pa.RecordBatch] = []
        self.table: dict | None = None
        self.pending: list[np.ndarray] = []
        self.size = 0

    def close(self) -> Iterator[dict]:
        """Keys of what is left, once the rows of a cell have been seen."""
        if self.pending:
            self._pick()
            slot, place, score, other = pairs = self.pending[0]
            if self.windows:  # the windows of one anchor may name the same row: it has one key, and repeated rows have one each
                first = np.r_[True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)] if len(slot) else np.empty(0, bool)
                starts = np.flatnonzero(first)
                copy = np.arange(len(slot)) - starts[np.cumsum(first) - 1]
                slot, score, other, _ = np.unique(np.stack([slot, score, other, copy]), axis=1)
            number, anchor = self.table["number"][slot], self.table["id"][slot]
            for at in range(0, len(slot), 100_000):
                part = slice(at, at + 100_000)
                yield {"keys": [_packed(number[part], anchor[part], score[part], 1 if self.windows else 0, other[part])]}
        self.reset()

    def add(self, rows: pa.RecordBatch) -> None:
        if self.table is None:
            if not self.anchors:
                return
            whole = pa.Table.from_batches(self.anchors).combine_chunks()
            self.table = {name: whole[name].to_numpy() for name in ("number", "id", "label")} | {"q": _matrix(whole["q"])}
            self.table["scores"] = whole["scores"].to_pylist()
        ids, labels, q = rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("q"))
        order = np.argsort(ids, kind="stable")  # so that the first of equal scores has the smallest id
        ids, labels, q = ids[order], labels[order], q[order]
        step = max(1, _TILE // max(1, len(ids)))
        for at in range(0, len(self.table["id"]), step):
            part = slice(at, at + step)
            scores = products(self.table["q"][part], q)
            same = self.table["label"][part, None] == labels
            if not self.windows:
                self._keep(at, 0, scores, same & (self.table["id"][part, None] != ids), ids)
                continue
            chosen = self.table["scores"][part]
            for place in range(max(map(len, chosen), default=0)):
                bounds = np.array([window(c[place], *self.windows) if place < len(c) else (1, 0) for c in chosen])
                inside = ~same & (scores >= bounds[:, :1]) & (scores <= bounds[:, 1:])
                self._keep(at, place, scores, inside, ids)

    def _keep(self, first: int, place: int, scores: np.ndarray, fit: np.ndarray, ids: np.ndarray) -> None:
        """Of each anchor's pairs that fit, those that no `most` others of these rows beat."""
        if scores.shape[1] > self.most:
            lowest = np.iinfo(np.int64).min
            masked = np.where(fit, scores, lowest)
            least = np.partition(masked, scores.shape[1] - self.most, axis=1)[:, scores.shape[1] - self.most]
            fit = fit & (scores >= least[:, None])
        slot, at = np.nonzero(fit)
        self.pending.append(np.stack([slot + first, np.full(len(slot), place), scores[slot, at], ids[at]]))
        self.size += len(slot)
        if self.size > _PENDING:
            self._pick()

    def _pick(self) -> None:
        """The best `most` of each anchor and window."""
        slot, place, score, other = pairs = np.hstack(self.pending)
        order = np.lexsort((other, ~score, place, slot))
        slot, place = slot[order], place[order]
        starts = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (place[1:] != place[:-1])]) if len(slot) else np.empty(0, int)
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        self.pending = [pairs[:, order[rank < self.most]]]
        self.size = self.pending[0].shape[1]


def _scored(anchors: DataFrame, rows: DataFrame, cells: tuple[int, int], cell: _Cell) -> DataFrame:
    """Keys of the pairs of all anchors with all rows that `cell` keeps; a cell is a task's share of both, dealt evenly by place."""
    of_anchors, of_rows = cells
    tasks = of_anchors * of_rows
    shared = anchors.select(
        (F.col("number") % of_anchors).alias("across"), F.explode(F.sequence(F.lit(0), F.lit(of_rows - 1))).alias("down"), F.lit(0).alias("kind"),
        "number", "id", "label", "q", "scores",
    )
    dealt = rows.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of_anchors - 1).cast("long"))).alias("across"), (F.monotonically_increasing_id() % of_rows).cast("int").alias("down"),
        F.lit(1).alias("kind"), F.lit(0).cast("long").alias("number"), "id", "label", "q", F.lit(None).cast("array<long>").alias("scores"),
    )
    together = shared.unionByName(dealt).repartition(tasks, "across", "down").sortWithinPartitions("across", "down", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current = None
        for batch in batches:
            marks = np.stack([batch.column(name).to_numpy() for name in ("across", "down", "kind")])
            starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)]) if batch.num_rows else []
            for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
                across, down, kind = marks[:, begin]
                if (across, down) != current:
                    yield from cell.close()
                    current = (across, down)
                some = batch.slice(begin, end - begin)
                if kind:
                    cell.add(some)
                else:
                    cell.anchors.append(some)
        yield from cell.close()

    return batches_of(together, run, "keys binary")


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """Rows (`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`).

    Anchors are the rows for which `anchors` holds. A score is the inner product of two vectors whose
    components are multiplied by `scale` and rounded down; higher scores come first, of equal ones
    the smaller id. An anchor's positives are its first `positives` rows of the same label with
    another id. A positive's negatives are the first `negatives` rows of another label whose scores lie
    between `low` and `high` hundredths of the positive's, ends included; `rank` counts them from 1.

    Rows without id or label take no part, nor do vectors that are null, have a component that is
    null or not finite, or a length other than most vectors have. Repeated rows count as often as
    they occur, also as anchors. Fewer positives or negatives than asked for are returned as they are;
    an empty table gives no rows; other columns are not read, whatever their names. Scores that no
    long holds are an error, as in SQL.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, anchors, id_col, label_col, vector_col, scale)
    chosen = rows.where("anchor").select(F.monotonically_increasing_id().alias("number"), "id", "label", "q")
    counts = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    tasks = width(spark)
    across = max(1, math.ceil(counts["anchors"] / ANCHORS))
    cells = across, max(math.ceil(counts["rows"] / ROWS), math.ceil(2 * tasks / across))

    numbered = stored(chosen, "anchors")
    unscored = numbered.withColumn("scores", F.array().cast("array<long>"))
    first = _sorted_keys(_scored(unscored, rows, cells, _Cell(positives)), tasks).mapPartitions(lambda keys: first_positives(keys, positives))
    opened = stored(spark.createDataFrame(first, _WINDOWS), "positives")

    scores = opened.groupBy("number").agg(F.collect_list("positive_score").alias("scores"))  # `positives` at most
    found = _scored(numbered.join(scores, "number"), rows, cells, _Cell(negatives, (low, high)))

    def window_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            number, anchor, other, score = (column.to_numpy() for column in batch.columns)
            yield {"keys": [_packed(number, anchor, score, 0, other)]}

    keys = _sorted_keys(found.unionByName(batches_of(opened, window_keys, "keys binary")), tasks)
    result = keys.mapPartitions(lambda some: mined(some, negatives, low, high))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(result, schema)
