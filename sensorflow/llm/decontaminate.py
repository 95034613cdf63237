"""Benchmark decontamination by spaced-seed hashing.

Words of a document and of a benchmark item overlap if, laid side by side, some window of 13 words
differs in two at most; places beyond the end of either text count as different. Two fixed masks of six positions each pick words out of every stretch of
text and ignore the others; whatever the places of two substitutions in a window, one of the masks
fits between them somewhere. So joining the masked hashes of documents and items finds every
overlap, and counting equal words in the windows around a hit verifies it.

An item of 8 to 12 words is one window, in which one word may differ: of two masks that take every
second word, one from the first on and one from the second on, a substitution meets only one. An
item of fewer than 8 words must occur whole: one substitution in seven words is more than two in 13.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

WINDOW = 13
SUBSTITUTIONS = 2
SHORT_WINDOW, SHORT_SUBSTITUTIONS = 8, 1  # of items that are shorter than the window
# Every pair of places among 13 is left out by one of these masks at one of its shifts.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
LEAD = WINDOW - 1 - min(max(mask) for mask in MASKS)  # words before a hit that a window around it can reach
BROADCAST_SEEDS = 4_000_000  # seeds, of 8 bytes each, that are sent to every executor; more are joined by a shuffle
SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits; none for a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _hashed(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def _masked(mask: tuple[int, ...], number: int) -> Column:
    """Hash of the words that the mask picks from `place` on; null where it does not fit."""
    fits = F.col("place") + max(mask) < F.size("hashes")
    return F.when(fits, F.xxhash64(F.lit(number), *(F.get("hashes", F.col("place") + at) for at in mask)))


def allowed(length: Column) -> Column:
    """Words that may differ in a window of this many."""
    return F.when(length >= WINDOW, SUBSTITUTIONS).when(length >= SHORT_WINDOW, SHORT_SUBSTITUTIONS).otherwise(0)


_EVERY, _WHOLE = 100, 200  # numbers of the masks of short items, less how many words they take


def _masks(lengths: list[int]) -> dict[int, tuple[int, ...]]:
    """All masks by number: those of long items and those that items of `lengths` need."""
    every = {taken for n in lengths if n >= SHORT_WINDOW for taken in ((n + 1) // 2, n // 2)}
    whole = {n for n in lengths if n < SHORT_WINDOW}
    return (
        dict(enumerate(MASKS))
        | {_EVERY + n: tuple(range(0, 2 * n, 2)) for n in sorted(every)}
        | {_WHOLE + n: tuple(range(n)) for n in sorted(whole)}
    )


def _belongs(number: int) -> Column:
    """Whether the item in this row has a seed by this mask at this place."""
    n, place = F.size("hashes"), F.col("place")
    if number >= _WHOLE:
        return (n == number - _WHOLE) & (place == 0)
    if number >= _EVERY:
        from_first, from_second = F.expr("(size(hashes) + 1) div 2"), F.expr("size(hashes) div 2")
        return n.between(SHORT_WINDOW, WINDOW - 1) & (
            ((place == 0) & (from_first == number - _EVERY)) | ((place == 1) & (from_second == number - _EVERY))
        )
    return n >= WINDOW


def _seeds(items: DataFrame, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """`seed` of every place of every item, with the words around it and what a window there must reach."""
    n = F.size("hashes")
    found = [F.struct(F.when(_belongs(number), _masked(mask, number)).alias("seed")) for number, mask in masks.items()]
    around = F.array(*(F.when(F.col("place") + j >= 0, F.get("hashes", F.greatest(F.col("place") + j, F.lit(0)))) for j in range(-LEAD, WINDOW)))
    return (
        items.withColumn("place", F.explode(F.sequence(F.lit(0), n - 1)))
        .select(
            "item_id",
            around.alias("around"),
            F.least(n, F.lit(WINDOW)).alias("length"),
            F.explode(F.array(*found)).alias("found"),
        )
        .select("item_id", "around", "length", F.col("found.seed").alias("seed"))
        .where(F.col("seed").isNotNull())
        .distinct()  # an item that repeats itself has each seed and its surroundings once
    )


def _equal_words() -> Column:
    """Bits of the places around a hit at which document and item have the same word."""

    def add(bits: Column, k: Column) -> Column:
        at = F.col("place") - LEAD + k
        here = F.when(at >= 0, F.get("hashes", F.greatest(at, F.lit(0))))
        return F.when(here == F.get("around", k), bits + F.pow(F.lit(2), k).cast("int")).otherwise(bits)

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEAD + WINDOW - 1)), F.lit(0), add)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_seeds: int = BROADCAST_SEEDS,
) -> DataFrame:
    """One row for each document and benchmark item that overlap.

    Columns: `doc_id`, `text_hash` (of the document's text), `item_id`, `equal_words` (most equal
    words in a window), `first_word` and `last_word` (of the document, from 0: where the first
    overlapping window begins and the last one ends).

    Null and empty texts and items have no words and overlap with nothing. Repeated rows of
    documents and of items count as one; a null id is an id like any other. Empty tables give no
    rows; other columns are not read, whatever their names.

    Documents are read once and not shuffled while the distinct seeds are few enough to be sent to
    the executors: only the places that meet one go into the join that verifies them.
    """
    met, seeds = _hits(docs, benchmark, id_col, text_col, item_col, item_text_col, broadcast_seeds)
    # Places of a document with the same words around them are verified once.
    met = met.groupBy("doc_id", "text_hash", "words", "seed", "hashes", "place").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    return (
        _verified(met, seeds, "doc_id", "text_hash", "item_id", "first_at", "last_at", "words", "length")
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(
            F.max(F.array_max("counts")).cast("int").alias("equal_words"),
            F.greatest(F.min(F.col("first_at") - LEAD + F.array_min("reached")), F.lit(0)).alias("first_word"),
            F.max(F.least(F.col("last_at") - LEAD + F.array_max("reached") + F.col("length"), F.col("words")) - 1).alias("last_word"),
        )
    )


def _verified(met: DataFrame, seeds: DataFrame, *keep: str) -> DataFrame:
    """Hits around which some window has enough equal words: `counts` of all windows, and those `reached`."""
    window = F.expr("shiftleft(1, length) - 1")
    counts = F.array(*(F.bit_count(F.col("equal").bitwiseAND(F.shiftleft(window, shift))) for shift in range(LEAD + 1)))
    reached = F.transform("counts", lambda n, shift: F.when(n >= F.col("length") - allowed(F.col("length")), shift))
    return (
        met.join(seeds, "seed")
        .select(*dict.fromkeys([*keep, "length"]), _equal_words().alias("equal"))
        .withColumn("counts", counts)
        .withColumn("reached", reached)
        .where(F.array_max("reached").isNotNull())
    )


def _hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, broadcast_seeds: int
) -> tuple[DataFrame, DataFrame]:
    """Places of documents whose seed the benchmark has, with the words around them; and the seeds. Both stored."""
    items = stored(
        benchmark.select(F.col(item_col).alias("item_id"), _hashed(F.col(item_text_col)).alias("hashes"))
        .where(F.size("hashes") > 0)
        .distinct(),
        "items",
    )
    lengths = [row.n for row in items.where(F.size("hashes") < WINDOW).select(F.size("hashes").alias("n")).distinct().collect()]
    masks = _masks(lengths)
    seeds = stored(_seeds(items, masks), "seeds")
    places = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text_col).alias("text_hash"),
            _hashed(F.col(text_col)).alias("hashes"),
        )
        # no filter on the number of words: it would be pushed down and split every text twice
        .withColumn("place", F.explode(F.when(F.size("hashes") > 0, F.sequence(F.lit(0), F.size("hashes") - 1))))
        .withColumn("seed", F.explode(F.array(*(_masked(mask, number) for number, mask in masks.items()))))
    )
    around = F.slice("hashes", F.greatest(F.col("place") - LEAD, F.lit(0)) + 1, LEAD + WINDOW)
    columns = [
        "doc_id",
        "text_hash",
        "seed",
        around.alias("hashes"),
        F.least(F.col("place"), F.lit(LEAD)).alias("place"),
        F.col("place").alias("at"),
        F.size("hashes").alias("words"),
    ]
    # Only places whose seed the benchmark has go on, with the words around them.
    known = seeds.select("seed").distinct()
    if seeds.count() <= broadcast_seeds:
        met = places.join(F.broadcast(known), "seed", "left_semi").select(*columns)
    else:  # what is shuffled for a place are the words around it, never those of the whole text
        met = places.where(F.col("seed").isNotNull()).select(*columns).join(known, "seed", "left_semi")
    # Written, so that the long expressions of the verification stay out of the loop over all places:
    # together they make one generated method too large for the JVM to compile.
    return stored(met, "seeds-met"), seeds


def without_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """`docs`, all columns, without the rows that overlap with a benchmark item.

    A passage that many documents share is compared once with one that many items share: what is
    verified are the different stretches of words that were met, and the documents are sought by these.
    """
    met, seeds = _hits(docs, benchmark, id_col, text_col, item_col, item_text_col, BROADCAST_SEEDS)
    stretch = ["seed", "hashes", "place"]
    found = stored(_verified(met.select(*stretch).distinct(), seeds.drop("item_id").distinct(), *stretch).select(*stretch).distinct(), "overlaps")
    hit = met.join(found, stretch, "left_semi").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    hit = stored(hit, "overlapping")
    same = docs[id_col].eqNullSafe(hit["__id"]) & (F.xxhash64(docs[text_col]) == hit["__hash"])
    return docs.join(hit, same, "left_anti")
