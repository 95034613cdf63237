"""SentencePiece BPE, encoding and decoding, by backtracking over longest matches.

The model joins neighbouring parts of a text, the best-scored piece first, the leftmost of equals.
A row of pieces is what that gives exactly if each piece, and each two neighbours, come out of
merging their own characters: no merge across a border may come before it is closed. So nothing
needs to be merged over the whole text. An Aho-Corasick automaton finds the longest piece at every
place; a piece that does not go with the one before it gives way to the next shorter one; a place
from which nothing goes on is marked in a bitfield, and the piece before it is taken back. Each
place is reached in one way only, so it is marked at most once. The model itself is a given file
and is never trained.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

CACHED_WORDS = 500_000  # words a worker remembers before it starts anew
CACHED_PAIRS = 1_000_000  # pairs of neighbours it remembers
ROWS = 500  # rows handed back at once

SPACE = "▁"  # stands for a space in pieces
_UNKNOWN = " ⁇ "  # what the unknown id is decoded to


class Model:
    """Pieces, scores and ids of a SentencePiece BPE model that falls back to bytes and changes no characters."""

    def __init__(self, path: str):
        said = SentencePieceProcessor(model_file=path)
        places = range(said.get_piece_size())
        normal = [i for i in places if not (said.is_control(i) or said.is_byte(i) or said.is_unknown(i) or said.is_unused(i))]
        self.begin, self.end, self.unknown = said.bos_id(), said.eos_id(), said.unk_id()
        self.ids = {said.id_to_piece(i): i for i in normal}
        self.scores = {piece: said.get_score(i) for piece, i in self.ids.items()}
        self.control = frozenset(i for i in places if said.is_control(i))
        self.byte_values = {i: int(said.id_to_piece(i)[3:-1], 16) for i in places if said.is_byte(i)}
        self.of_byte = {byte: i for i, byte in self.byte_values.items()}
        odd = " ａﬁ①  \t"  # what normalisers change: runs of spaces, wide, joined and circled letters, tabs
        if len(self.of_byte) < 256 or any(map(said.is_unused, places)) or said.normalize(odd) != SPACE + odd.replace(" ", SPACE):
            raise ValueError(f"{path} is no BPE model with all bytes, no unused pieces and texts taken as they are")
        # No piece holds a space after another character, so no merge crosses the border before one.
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids)
        self.pieces_of = {i: piece for piece, i in self.ids.items()}
        self.shorter = {piece: self._next_shorter(piece) for piece in self.ids}
        self.found = ahocorasick.Automaton()
        for piece in self.ids:
            self.found.add_word(piece, piece)
        self.found.make_automaton()
        self._goes: dict[tuple[str, str], bool] = {}
        self._packed = {piece: i.to_bytes(4, "little") for piece, i in self.ids.items()}
        self._spoken = {i: piece.replace(SPACE, " ").encode() for i, piece in self.pieces_of.items()}
        self._spoken |= {i: bytes([byte]) for i, byte in self.byte_values.items()} | {self.unknown: _UNKNOWN.encode()}

    def _next_shorter(self, piece: str) -> str | None:
        """The longest piece that `piece` begins with, else its first character; None for one character."""
        prefixes = (piece[:end] for end in range(len(piece) - 1, 0, -1))
        return next((prefix for prefix in prefixes if prefix in self.ids), piece[0] if len(piece) > 1 else None)

    def merged(self, text: str) -> list[str]:
        """Parts of a short text: neighbours that make a piece are joined, the best score first, then the leftmost."""
        parts = list(text)
        while True:
            joined = [(-self.scores[a + b], at) for at, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not joined:
                return parts
            _, at = min(joined)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def goes(self, left: str, right: str) -> bool:
        """Whether `right` may follow `left`: merging their characters anew gives the two. `left` is empty at the start."""
        if len(self._goes) >= CACHED_PAIRS:
            self._goes.clear()
        goes = self._goes[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return goes

    def pieces(self, text: str) -> list[str]:
        """The parts that merging all of `text` gives; a character that is no piece is a part of its own."""
        longest: list[str] = list(text)
        for end, piece in self.found.iter(text):  # by their ends, so the last one noted is the longest
            longest[end - len(piece) + 1] = piece
        size, shorter_of, known = len(text), self.shorter, self._goes
        failed = bytearray(size // 8 + 1)
        taken: list[str] = []
        at, last, candidate = 0, "", text and longest[0]
        while at < size:
            end = at + len(candidate)
            goes = not failed[end >> 3] >> (end & 7) & 1
            if goes:
                goes = known.get((last, candidate))
                if goes is None:
                    goes = self.goes(last, candidate)
            if goes:
                taken.append(candidate)
                last, at = candidate, end
                if at < size:
                    candidate = longest[at]
                continue
            shorter = shorter_of.get(candidate)
            if shorter is None:
                failed[at >> 3] |= 1 << (at & 7)
                candidate = taken.pop()
                last = taken[-1] if taken else ""
                at -= len(candidate)
            else:
                candidate = shorter
        return taken

    def encoded(self, text: str) -> bytes:
        """Ids of an escaped text or word as little-endian 32-bit integers; what is no piece becomes its bytes."""
        found = self.pieces(text)
        try:
            return b"".join(map(self._packed.__getitem__, found))
        except KeyError:
            parts = ([self.ids[piece]] if piece in self.ids else [self.of_byte[byte] for byte in piece.encode("utf-8", "replace")] for piece in found)
            return np.array([i for part in parts for i in part], "<u4").tobytes()

    def decoded(self, ids: bytes) -> str:
        """The text of ids: control ids are silent, the space before the first word goes, bytes that are no UTF-8 are replaced."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        runs = [list(run) for silent, run in groupby(numbers, self.control.__contains__) if not silent]
        texts = [_text(b"".join(map(self._spoken.__getitem__, run))) for run in runs]  # bytes on two sides of a control id make no character
        if runs and runs[0][0] in self.pieces_of and texts[0].startswith(" "):
            texts[0] = texts[0][1:]
        return "".join(texts)

def _text(spoken: bytes) -> str:
    try:
        return spoken.decode()
    except UnicodeDecodeError:
        return "".join(_characters(spoken))


def _characters(spoken: bytes) -> Iterator[str]:
    """Characters of bytes, each byte that begins none replaced on its own."""
    at = 0
    while at < len(spoken):
        for size in (1, 2, 3, 4):
            try:
                yield spoken[at : at + size].decode()
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


class _Words(dict):
    """Ids of the words met so far, by the word without the space before it."""

    def __init__(self, pieces: Model):
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = ids = self.pieces.encoded(SPACE + word)
        return ids


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    """One per worker process, kept from task to task."""
    return _Words(model(path))


_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def text_ids(text: str, path: str) -> bytes:
    """Ids of a whole text, without begin and end."""
    if not text:
        return b""
    known = _words(path)
    if not known.pieces.by_words:
        return known.pieces.encoded(SPACE + text.replace(" ", SPACE))
    if text[0] == " " or "  " in text or SPACE in text:  # spaces in a row belong together
        runs = _RUNS.findall(SPACE + text.replace(" ", SPACE))
        return b"".join(known[run[1:]] if run[0] == SPACE else known.pieces.encoded(run) for run in runs)
    return b"".join(map(known.__getitem__, text.split(" ")))


def piece_round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_tokens`, `ids` (little-endian unsigned 32-bit integers) and `decoded`.

    `ids` are those of the model file with its begin and end ids; `decoded` is the text of `ids`.
    Columns in `keep` come along in a struct `columns`. One pass over the rows, no shuffle.

    A null text counts as empty: begin and end only, empty text. Repeated rows give equal rows, an
    empty table none; texts of any length are encoded whole, in time that grows with the length;
    other columns are not read, whatever their names.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = model(model_path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (pieces.begin, pieces.end))
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some = batch.iloc[at : at + ROWS].copy()
                some["ids"] = [begin + text_ids(text, model_path) + end for text in some.pop("text")]
                some["n_tokens"] = some["ids"].map(len) // 4
                some["decoded"] = [pieces.decoded(ids) for ids in some["ids"]]
                yield some

    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *([F.struct(*keep).alias("columns")] if keep else []),
    )
    schema = source.drop("text").withColumns(
        {"ids": F.lit(b""), "n_tokens": F.lit(0).cast("long"), "decoded": F.lit("")}
    ).schema
    return source.mapInPandas(encode, schema)
