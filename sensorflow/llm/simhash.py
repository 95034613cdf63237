"""SimHash near-duplicates: byte-position inverted index, count filtering, verification.

A 64-bit fingerprint is eight bytes at eight positions. Two fingerprints at most d bits apart
differ in at most d bytes, so at least 8 - d positional bytes agree: the guaranteed minimum. The
index posts every distinct fingerprint under grams of positional bytes, chosen so that any pair
with the minimum of agreeing positions meets under some gram; for three bits these are the eight
grams of three positions within one half. Pairs that meet are tallied (positions that agree), kept
if they reach the minimum, and verified by their bit distance.

Equal fingerprints, and so all exact copies, are one node. A posting longer than `long_posting` is
not paired: its fingerprints are linked exactly through the fingerprints between them instead (two
that are d bits apart share a point within d // 2 bits of the one and the rest of the other), which
costs a fixed number of rows per fingerprint, not a square.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected
from .tables import stored

BITS, POSITIONS = 64, 8
SEED = 42
LONG_POSTING = 1024
_BLOCK = 255 * 128  # hashes counted at once


def simhash(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of a whole text.

    Letters A-Z are lower-cased, words are runs without ASCII white space, and every run of
    `shingle` words (repeats included; the whole sequence if it is shorter) votes with its XXH64. A
    bit is set if over half of the votes have it. Without words, as for a null text, it is zero.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    votes = max(1, len(words) - shingle + 1)
    total = np.zeros(BITS, np.int64)
    for begin in range(0, votes, _BLOCK):
        end = min(votes, begin + _BLOCK)
        digests = b"".join([xxhash.xxh64_digest(b" ".join(words[i : i + shingle]), SEED) for i in range(begin, end)])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, BITS)
        whole = len(bits) // 255 * 255  # 255 ones still fit into a byte
        total += np.add.reduce(bits[:whole].reshape(-1, 255, BITS), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > votes).tobytes(), "big", signed=True)


def simhash_column(text: Column | str, shingle: int = 3) -> Column:
    @F.pandas_udf(T.LongType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return fingerprint(text)


def grams(distance: int, size: int = 3) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any 8 - `distance` agreeing positions contain one of them.

    The positions are cut into as many parts as still leave `size` agreeing ones in some part.
    """
    least = POSITIONS - distance
    if not 0 <= distance or least < size:
        raise ValueError(f"a gram of {size} positions needs a distance of 0 to {POSITIONS - size} bits")
    parts = max(1, (least - 1) // (size - 1)) if size > 1 else least
    cut = np.array_split(np.arange(POSITIONS), parts)
    return [tuple(int(p) for p in which) for part in cut for which in combinations(part, size)]


def _byte(fingerprint: Column, position: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * position).bitwiseAND(255)


def _postings(nodes: DataFrame, distance: int, size: int) -> DataFrame:
    """One row for each fingerprint and gram: `gram`, `value` (the bytes at its positions), `fp`."""
    keys = []
    for number, positions in enumerate(grams(distance, size)):
        value = F.lit(0).cast("long")
        for position in positions:
            value = F.shiftleft(value, 8).bitwiseOR(_byte(F.col("fp"), position))
        keys.append(F.struct(F.lit(number).alias("gram"), value.alias("value")))
    return nodes.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.gram", "key.value", "fp")


def _verified(pairs: DataFrame, distance: int) -> DataFrame:
    """Pairs (`a`, `b`) that pass the count filter and then the bit distance."""
    apart = F.col("a").bitwiseXOR(F.col("b"))
    agreeing = sum((F.when(_byte(apart, p) == 0, 1).otherwise(0) for p in range(POSITIONS)), F.lit(0))
    return (
        pairs.withColumn("agreeing", agreeing)
        .where(F.col("agreeing") >= POSITIONS - distance)
        .where(F.bit_count(apart) <= distance)
        .select("a", "b")
    )


def _through_points(nodes: DataFrame, distance: int) -> DataFrame:
    """Links (`a`, `b`) that join all of `nodes` within `distance` bits, with no pair of them formed.

    Each fingerprint goes to all points up to half the distance away, rounded up. Those within the
    other half of a point are within `distance` of all the others there, so the smallest of them
    stands for the point and everyone there is linked with it.
    """
    near = distance // 2
    flipped = nodes.select("fp", F.col("fp").alias("point"), F.lit(0).alias("flips"), F.lit(-1).alias("last"))
    for _ in range(distance - near):
        flipped = flipped.withColumn("bit", F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1)))).where(
            (F.col("bit") == -1) | (F.col("bit") > F.col("last"))
        ).select(
            "fp",
            F.when(F.col("bit") == -1, F.col("point"))
            .otherwise(F.expr("point ^ shiftleft(1L, greatest(bit, 0))"))
            .alias("point"),
            (F.col("flips") + (F.col("bit") >= 0).cast("int")).alias("flips"),
            # after a step without a flip there are no more: each point is then reached once
            F.when(F.col("bit") == -1, BITS).otherwise(F.col("bit")).alias("last"),
        )
    hubs = (
        flipped.groupBy("point")
        .agg(F.min(F.when(F.col("flips") <= near, F.col("fp"))).alias("hub"), F.count("*").alias("met"))
        .where(F.col("hub").isNotNull() & (F.col("met") > 1))
    )
    return flipped.join(hubs, "point").where(F.col("hub") != F.col("fp")).select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def links(nodes: DataFrame, distance: int = 3, size: int = 3, long_posting: int = LONG_POSTING) -> DataFrame:
    """Links (`a`, `b`) among distinct fingerprints `fp`, enough to connect all within `distance` bits."""
    posts = _postings(nodes, distance, size)
    long = posts.groupBy("gram", "value").count().where(F.col("count") > long_posting)
    crowded = stored(long.select("gram", "value"), "simhash-long")
    if crowded.isEmpty():
        rest, extra = posts, None
    else:
        rest = posts.join(crowded, ["gram", "value"], "left_anti")
        extra = _through_points(posts.join(crowded, ["gram", "value"], "left_semi").select("fp").distinct(), distance)
    left, right = (rest.select("gram", "value", F.col("fp").alias(side)) for side in "ab")
    pairs = _verified(left.join(right, ["gram", "value"]).where(F.col("a") < F.col("b")), distance)
    return pairs if extra is None else pairs.union(extra)


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    size: int = 3,
    long_posting: int = LONG_POSTING,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: `row`, `doc_id`, `fingerprint` (16 hex digits), `component_id`, `kept`.

    Rows are linked if their fingerprints differ in at most `distance` bits; `component_id` is the
    smallest id reachable over such links. `row` numbers the rows of this result's stored table and
    one row of each component is `kept`: one of those with the smallest id. Columns named in
    `keep` come along in a struct `columns`.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked like any
    other. A row without an id takes part; a component without any id has a null `component_id`.
    Repeated rows fall into one component, an empty table gives no rows, and other columns are not
    read, whatever their names.
    """
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            simhash_column(F.col(text_col), shingle).alias("fp"),
            *([F.struct(*keep).alias("columns")] if keep else []),
        ),
        "simhash-rows",
    )
    # Plain minima are combined by hash in every task; a minimum of structs would sort all rows.
    firsts = rows.groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("row")
    )
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row").alias("first")
    nodes = stored(firsts.select("fp", first), "simhash-nodes")
    roots = stored(connected(links(nodes.select("fp"), distance, size, long_posting)), "simhash-roots")
    linked = nodes.join(roots, nodes["fp"] == roots["node"])
    heads = linked.groupBy("root").agg(F.min("first").alias("head"))
    heads = stored(roots.join(heads, "root").select(F.col("node").alias("fp"), "head"), "simhash-heads")
    heads = stored(nodes.join(heads, "fp", "left").select("fp", F.coalesce("head", "first").alias("head")), "simhash-heads")
    return rows.join(heads, "fp").select(
        "row",
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"),
        *(["columns"] if keep else []),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """`docs`, all columns, with one row of each group of near-duplicates: the one with the smallest id."""
    grouped = simhash_groups(docs, id_col, text_col, shingle, distance, keep=tuple(f"`{c}`" for c in docs.columns))
    return grouped.where("kept").select("columns.*")
