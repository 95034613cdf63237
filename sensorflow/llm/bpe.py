"""Byte-level BPE, encoding and decoding, with a lexicon of frequent words in a minimal automaton.

Spark counts the words of all documents. The most frequent ones are merged once and compiled into a
minimal acyclic automaton over their bytes: equal suffixes share states, and every arc carries how
many words come before it, so that the numbers along a path add up to the word's place in a table of
token ids. Each worker maps the compiled lexicon into memory once; a word that is not in it is
merged exactly, by the rank of its pairs. The tokenizer itself is a given file and is never trained.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tables import stored

LEXICON_WORDS = 262_144  # most words compiled: bounds what is collected and broadcast
LEXICON_BYTES = 64  # longer words are not compiled
CACHED_WORDS = 500_000  # words a worker remembers before it starts anew
COUNTED_WORDS = 500_000  # distinct words a task counts before it passes them on
SHORT_WORD = 24  # bytes up to which looking at all pairs is faster than a queue
ROWS = 500  # rows handed back at once

# Below this code point the character classes are the same in every Unicode version in use; texts
# with others are split by the tokenizer's own splitter, whose Unicode tables they depend on.
_SETTLED = 0x558


def _classes() -> tuple[str, str, str]:
    found: dict[str, list[str]] = {"L": [], "N": [], "Z": []}
    for code in range(_SETTLED):
        kind = unicodedata.category(chr(code))[0]
        kind = "Z" if 9 <= code <= 13 or code == 0x85 else kind
        if kind in found:
            found[kind].append(re.escape(chr(code)))
    return "".join(found["L"]), "".join(found["N"]), "".join(found["Z"])


_LETTER, _NUMBER, _SPACE = _classes()
_WORDS = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_ID_BITS, _ID = 32, (1 << 32) - 1
_NEVER = 1 << 62  # in place of rank and result of a pair that does not merge
_UNSETTLED = re.compile(rf"[^\x00-{chr(_SETTLED - 1)}]")


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the tokenizer file: itself if visible, else the next free one."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class Vocabulary:
    """Tokens, merge ranks and added tokens of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        stands_for = _byte_letters()
        ids = said["model"]["vocab"]
        self.added = {token["content"]: token["id"] for token in said["added_tokens"]}
        self.pieces = {i: bytes(stands_for[letter] for letter in token) for token, i in ids.items()}
        self.pieces |= {i: token.encode() for token, i in self.added.items()}
        self.of_byte = [ids[letter] for letter, _ in sorted(stands_for.items(), key=lambda pair: pair[1])]
        # A pair of ids, and a merge's rank and result, are one integer each: quick to look up and compare.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(said["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left] << _ID_BITS | ids[right]] = rank << _ID_BITS | ids[left + right]
        self.between = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.splitter = Tokenizer.from_file(path).pre_tokenizer

    def words(self, text: str) -> list[str]:
        """The stretches of text within which pairs may merge."""
        if _UNSETTLED.search(text):
            return [text[begin:end] for _, (begin, end) in self.splitter.pre_tokenize_str(text)]
        return _WORDS.findall(text)

    def parts(self, text: str) -> list[str]:
        """Words and added tokens of a text, in order."""
        if self.between is None or not self.between.search(text):
            return self.words(text)
        found = []
        for part in self.between.split(text):
            found.extend([part] if part in self.added else self.words(part))
        return found

    def merged(self, word: str) -> list[int]:
        """Ids of one word: the pair of lowest rank, leftmost first, is merged until none is left."""
        ids = [self.of_byte[byte] for byte in word.encode("utf-8", "replace")]
        return self._merged_long(ids) if len(ids) > SHORT_WORD else self._merged_short(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        found = self.merges.get
        ranks = [found(left << _ID_BITS | right, _NEVER) for left, right in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != _NEVER:
            at = ranks.index(best)
            ids[at : at + 2] = [best & _ID]
            del ranks[at]
            if at:
                ranks[at - 1] = found(ids[at - 1] << _ID_BITS | ids[at], _NEVER)
            if at < len(ranks):
                ranks[at] = found(ids[at] << _ID_BITS | ids[at + 1], _NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs, so that a word of any length takes about as long as its length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(at: int) -> None:
            pair = ids[at] << _ID_BITS | ids[after[at]]
            if pair in self.merges:
                heapq.heappush(queue, (self.merges[pair], at, pair))

        for at in range(n - 1):
            offer(at)
        while queue:
            best, at, pair = heapq.heappop(queue)
            gone = after[at]
            if ids[at] < 0 or gone >= n or ids[at] << _ID_BITS | ids[gone] != pair:
                continue
            ids[at], ids[gone], after[at] = best & _ID, -1, after[gone]
            if after[at] < n:
                before[after[at]] = at
                offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [i for i in ids if i >= 0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def compiled(lexicon: dict[bytes, list[int]]) -> bytes:
    """The lexicon as one block: a minimal acyclic automaton whose arcs number the words, and their ids.

    Words are added in order. The path that the next word does not share is closed first: each of
    its states is replaced by an equal one if there is one (same arcs, same end mark).
    """
    words = sorted(lexicon)
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    known: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}
    open_path: list[list] = [[False, []]]  # from the start: ends a word, closed arcs

    def close(depth: int, labels: bytes) -> None:
        while len(open_path) > depth + 1:
            ends, arcs = open_path.pop()
            state = (ends, tuple(arcs))
            if state not in known:
                known[state] = len(states)
                states.append(state)
            open_path[-1][1].append((labels[len(open_path) - 1], known[state]))

    last = b""
    for word in words:
        shared = next((i for i, (x, y) in enumerate(zip(word, last)) if x != y), min(len(word), len(last)))
        close(shared, last)
        open_path.extend([False, []] for _ in range(len(word) - shared))
        open_path[-1][0] = True
        last = word
    close(0, last)
    states.append((open_path[0][0], tuple(open_path[0][1])))

    below = [0] * len(states)  # words that end at or after a state
    first, labels, targets, skips = [0], bytearray(), [], []
    for state, (ends, arcs) in enumerate(states):  # a state's targets come before it
        passed = int(ends)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(passed)
            passed += below[target]
        below[state] = passed
        first.append(len(targets))
    ids = [lexicon[word] for word in words]
    ends = bytes(int(ends) for ends, _ in states)
    columns = [
        np.array(first, "<u4").tobytes(),
        np.array(targets, "<u4").tobytes(),
        np.array(skips, "<u4").tobytes(),
        np.cumsum([0, *map(len, ids)]).astype("<u4").tobytes(),
        np.array([i for each in ids for i in each], "<u4").tobytes(),
        ends,
        bytes(labels),
    ]
    return struct.pack(f"<{len(columns)}Q", *map(len, columns)) + b"".join(columns)


class Lexicon:
    """A compiled lexicon mapped into memory; it looks words up without unpacking anything."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:  # without a name: it goes when the mapping goes
            file.write(block)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = struct.unpack_from("<7Q", self._map)
        view, at, parts = memoryview(self._map), 56, []
        for size, kind in zip(sizes, "IIIIIBB"):
            parts.append(view[at : at + size].cast(kind))
            at += size
        self.first, self.targets, self.skips, self.offsets, self.ids, self.ends, self.labels = parts

    def find(self, word: bytes) -> bytes | None:
        """Ids of the word as little-endian 32-bit integers, or None."""
        first, labels, targets, skips = self.first, self.labels, self.targets, self.skips
        state, place = len(self.ends) - 1, 0
        for byte in word:
            low, end = first[state], first[state + 1]
            high = end
            while low < high:
                middle = (low + high) // 2
                if labels[middle] < byte:
                    low = middle + 1
                else:
                    high = middle
            if low == end or labels[low] != byte:
                return None
            place += skips[low]
            state = targets[low]
        if not self.ends[state]:
            return None
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tobytes()


class _Remembered(dict):
    """Ids of words met so far, as bytes; a new word is looked up in the lexicon, else merged."""

    def __init__(self, words: Vocabulary, lexicon: Lexicon):
        self.words, self.lexicon = words, lexicon

    def __missing__(self, word: str) -> bytes:
        if word in self.words.added:
            ids = struct.pack("<I", self.words.added[word])
        else:
            ids = self.lexicon.find(word.encode("utf-8", "replace"))
            if ids is None:
                ids = np.array(self.words.merged(word), "<u4").tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = ids
        return ids


@lru_cache(maxsize=1)
def _remembered(vocabulary_path: str, block: bytes) -> _Remembered:
    """One per worker process, kept from task to task."""
    return _Remembered(vocabulary(vocabulary_path), Lexicon(block))


def frequent_words(docs: DataFrame, vocabulary_path: str, text_col: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all documents: those that occur a number of times which at most `most` words reach."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splits, seen = vocabulary(vocabulary_path), Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(splits.parts(text))
                if len(seen) > COUNTED_WORDS:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen = Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    texts = docs.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    counts = stored(
        texts.mapInPandas(counted, "word string, n long")
        .where(F.octet_length("word") <= LEXICON_BYTES)
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    # Counts over 2^20 are not told apart, so that this is a short list whatever the number of words.
    words_by_count = counts.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    least, total = None, 0
    for row in words_by_count.collect():
        total += row.words
        if total > most:
            break
        least = row.n
    if least is None:
        return []
    return [row.word for row in counts.where(F.col("n") >= least).select("word").collect()]


def build_lexicon(words: list[str], vocabulary_path: str) -> bytes:
    words_of = vocabulary(vocabulary_path)
    return compiled({word.encode(): words_of.merged(word) for word in words if word not in words_of.added})


def bpe_round_trip(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_words: int = LEXICON_WORDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_tokens`, `ids` (little-endian unsigned 32-bit integers) and `decoded`.

    `ids` are those of the tokenizer file without its template's special tokens; an added token's
    string in a text becomes that token. `decoded` is the text of `ids`. Columns in `keep` come along
    in a struct `columns`.

    A null text counts as empty: no ids, empty text. Repeated rows give equal rows, an empty table
    none; texts of any length are encoded whole; other columns are not read, whatever their names.
    """
    block = build_lexicon(frequent_words(docs, vocabulary_path, text_col, most_words), vocabulary_path)
    shared = docs.sparkSession.sparkContext.broadcast(block)  # bounded by the number and length of words

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(vocabulary_path)
        known = _remembered(vocabulary_path, shared.value)
        for batch in batches:
            for begin in range(0, len(batch), ROWS):
                some = batch.iloc[begin : begin + ROWS].copy()
                some["ids"] = [b"".join(map(known.__getitem__, words.parts(text))) for text in some.pop("text")]
                some["n_tokens"] = some["ids"].map(len) // 4
                some["decoded"] = [decoded(ids, words) for ids in some["ids"]]
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


def decoded(ids: bytes, words: Vocabulary) -> str:
    """Text of the ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(words.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def token_digests(encoded: DataFrame) -> DataFrame:
    """`encoded` with `ids_sha256` and `decoded_sha256` in place of the decoded text."""
    return encoded.withColumns(
        {"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)}
    ).drop("decoded")
