"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk where its value is a multiple of the block
size, so a boundary depends on what stands there and not on what came before. Every chunk gives one
signature letter. Block sizes are 3, 6, 12 and so on, by the length of the text; a fingerprint has
the signatures at its block size and at twice that. A chunk has a quarter of the block size at least
and four times at most: where no boundary comes in that range, the smallest value of the rolling
hash in it, the first of equals, is one. So repeated lines, or a single repeated letter, give chunks
like any other text, every chunk has its letter, and a signature has 12 to 256 letters whatever the
text is like (fewer for texts of under 40 bytes). Two fingerprints are compared by the edit distance of
signatures at the same block size.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored, width

LETTERS = 64  # as many blocks a text has, or down to half as many
WINDOW = 7
SMALLEST = 3
SHORT, LONG = 4, 4  # a chunk has at least a block over SHORT, and at most LONG blocks
_SPAN = 1 << 20  # bytes looked at together: bounds memory for texts of any length
_FIRST_LETTER, _LETTER_BITS = 0x4E00, 12  # 4,096 letters, one code point each: a pattern and another rarely share one
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values; also the rule for the table of byte values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=None)
def _powers(inverse: bool, size: int) -> np.ndarray:
    step = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    out = np.full(size, step, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sized(inverse: bool, size: int) -> np.ndarray:
    return _powers(inverse, 1 << max(12, (size - 1).bit_length()))


def _spans(data: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """Begin of a span, bytes before it that are included so that its first windows are complete, and the sums up to each byte.

    The sum up to i adds value(byte) * base^i, so the hash of a window or a chunk is a difference of
    two of them, shifted back to position zero.
    """
    whole = np.frombuffer(data, np.uint8)
    for begin in range(0, len(data), _SPAN):
        lead = min(begin, WINDOW)
        span = whole[begin - lead : begin + _SPAN]
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(_VALUES[span] * _sized(False, len(span) + 1)[: len(span)], out=sums[1:])
        yield begin, lead, sums


def _rolled(data: bytes) -> np.ndarray:
    """The rolling hash at every byte: 1 to 2^31."""
    out = np.empty(len(data), np.uint32)
    for begin, lead, sums in _spans(data):
        rolled = sums[1:].copy()
        if len(rolled) > WINDOW:
            rolled[WINDOW:] -= sums[1:-WINDOW]
        rolled *= _sized(True, len(sums))[: len(rolled)]
        rolled = ((rolled >> np.uint64(24)).astype(np.uint32) & np.uint32(0x7FFFFFFF)) + np.uint32(1)
        out[begin : begin + _SPAN] = rolled[lead:]
    return out


def _sums_at(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Sums over the whole text up to each of `ends`, which rise."""
    out, total = np.empty(len(ends), np.uint64), 0
    for begin, lead, sums in _spans(data):
        shift = pow(_BASE, begin - lead, 1 << 64)
        before = (total - shift * int(sums[lead])) & _MASK
        some = slice(*np.searchsorted(ends, [begin, min(begin + _SPAN, len(data))], side="right"))
        out[some] = np.uint64(before) + np.uint64(shift) * sums[ends[some] - begin + lead]
        total = (before + shift * int(sums[-1])) & _MASK
    return out


def _ends(rolled: np.ndarray, triggers: list[int], block: int) -> np.ndarray:
    """Where the chunks end; `triggers` are the ends at which the rolling hash is a multiple of the block size."""
    size, least, most = len(rolled), max(1, block // SHORT), block * LONG
    found, begin, next_one = [], 0, 0
    while size - begin > least:
        next_one = bisect_left(triggers, begin + least, next_one)
        if next_one < len(triggers) and triggers[next_one] <= begin + most:
            begin = triggers[next_one]
        elif begin + most < size:
            begin += least + int(rolled[begin + least - 1 : begin + most].argmin())
        else:
            break
        found.append(begin)
    if begin < size:
        found.append(size)
    return np.array(found, np.int64)


def _letters(data: bytes, ends: np.ndarray) -> str:
    starts = np.concatenate([[0], ends[:-1]])
    chunks = np.diff(_sums_at(data, ends), prepend=np.uint64(0))
    back = _sized(True, _SPAN)[starts % _SPAN]
    if len(data) > _SPAN:
        back = back * np.array([pow(_BASE, -int(s // _SPAN * _SPAN), 1 << 64) for s in starts], np.uint64)
    letters = (_mixed(chunks * back) >> np.uint64(64 - _LETTER_BITS)).astype("<u4") + np.uint32(_FIRST_LETTER)
    return letters.tobytes().decode("utf-32-le")


def fingerprint(text: str | None) -> str:
    """`block size:signature:signature at twice the block size` of a whole text; null counts as empty."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return f"{SMALLEST}::"
    block = SMALLEST << (len(data) // (SMALLEST * LETTERS)).bit_length()
    with np.errstate(over="ignore"):
        rolled = _rolled(data)
        at = np.flatnonzero(rolled % np.uint32(block) == 0)
        double = at[rolled[at] % np.uint32(2 * block) == 0]
        parts = [_letters(data, _ends(rolled, (where + 1).tolist(), size)) for where, size in ((at, block), (double, 2 * block))]
    return f"{block}:{parts[0]}:{parts[1]}"


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: one minus the edit distance of two fingerprints' signatures as a share of the longer one.

    Signatures are compared at the block sizes that both fingerprints have, and the best counts;
    without any, 0. Equal fingerprints, those of empty texts included, give 1.
    """
    a, b = F.split(left, ":"), F.split(right, ":")
    size_a, size_b = a[0].cast("long"), b[0].cast("long")

    def alike(x: Column, y: Column) -> Column:
        return 1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))

    return (
        F.when(left == right, 1.0)
        .when((a[1] == "") | (b[1] == ""), 0.0)
        .when(size_a == size_b, F.greatest(alike(a[1], b[1]), alike(a[2], b[2])))
        .when(size_a == 2 * size_b, alike(a[1], b[2]))
        .when(size_b == 2 * size_a, alike(a[2], b[1]))
        .otherwise(0.0)
    )


def fingerprint_column(text: Column | str) -> Column:
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint, na_action=None)

    return of(text)


_FINISHED = "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
_EDGE = ", part int, first_text string, open_text string"


def _edited(text: str, following: str) -> str:
    """`text` whose last half is replaced by as many first code points of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id, text: str, own: str, following: str, its: str) -> tuple:
    edited = _edited(text, following)
    return doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own, fingerprint(edited), its


def _in_turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document with the one after it; a partition's first and last come out as edges, to be joined."""
    last = part = None
    for batch in batches:
        finished = []
        for doc_id, text, part in zip(batch["doc_id"], batch["text"], batch["part"]):
            own = fingerprint(text)
            if last is None:
                finished.append((None, None, None, own, None, None, part, text, None))
            else:
                finished.append((*_row(*last, text, own), None, None, None))
            last = doc_id, text, own
        if finished:
            yield _frame(finished)
    if last is not None:
        doc_id, text, own = last
        yield _frame([(doc_id, len(text), None, own, None, None, part, None, text)])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint", "part", "first_text", "open_text"]
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    return frame.astype({"n_chars": "Int64", "part": "Int32"})


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [_row(*row) for row in zip(batch["doc_id"], batch["open_text"], batch["fingerprint"], batch["following"], batch["its"])]
        if rows:
            yield _frame([(*row, None, None, None) for row in rows]).iloc[:, :6]


def compared_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document, by descending id.

    The edited text has the last half of the code points replaced by the first as many (or all) of
    the next document; after the last comes the first. Returns `doc_id`, `n_chars`,
    `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited` and `near_next`.

    A null text counts as empty. Rows with equal ids stand together, ordered by the hash of their
    text, and rows without an id come last. Repeated rows follow one another; a single row is
    followed by itself; an empty table gives no rows; other columns are not read, whatever their names.

    Texts are dealt by range of the id in one shuffle; only the first and last document of each
    partition are joined afterwards.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumns(
        {"mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    )
    # The row number only tells repeated rows apart, which are alike in every result.
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark").asc(), F.col("row").asc()]
    dealt = (
        rows.repartitionByRange(width(spark), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    schema = _FINISHED.format(id=rows.schema["doc_id"].dataType.simpleString())
    turned = stored(dealt.mapInPandas(_in_turn, schema + _EDGE), "piecewise")
    first = turned.where("first_text is not null").select(
        F.col("part").alias("next_part"), F.col("first_text").alias("following"), F.col("fingerprint").alias("its")
    )
    last = turned.where("open_text is not null").select("part", "doc_id", "open_text", "fingerprint")
    # One row for each partition of the shuffle.
    parts = last.select("part").withColumns(
        {
            "after": F.lead("part").over(Window.orderBy("part")),
            "lowest": F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    ).select("part", F.coalesce("after", "lowest").alias("next_part"))
    edges = last.join(parts, "part").join(first, "next_part").mapInPandas(_joined, schema)
    inner = turned.where("part is null").select(*edges.columns)
    return inner.union(edges).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
