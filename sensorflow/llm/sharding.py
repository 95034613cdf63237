"""Shards that all have the mixture of the whole: proportional stratified interleaving.

The rows of every source are shuffled by a seeded hash and ranked. A row's fractional rank, its
place within its source as a share of the source, spreads each source evenly over 0 to 1; sorted by
it, any stretch of rows has the sources in proportion. The sorted rows are cut into stretches of
equal length, so shards differ by one row at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import numbered, stored

SHARDS = 24
SEED = 17


def shuffled(doc_id: Column, seed: int) -> Column:
    """Sort key of the seeded shuffle: known from the id alone, so another run gives the same order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary"))


def interleave(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard`.

    `size` is the text's bytes plus 8. The law is `rows`: the shards' row counts are at most one
    apart; `slot` counts a shard's rows from 0 without gaps. A source's share of each shard differs
    from its share of all rows by half a row for each source at most. `grown_shard` is null, since the law says nothing about
    another number of shards. Copies are rows like any other and are spread as the shuffle has it:
    keeping a group of equal texts together would break the law once it outgrows a shard.

    A null text has no bytes and a CRC of 0. A null source is a source of its own; null ids are
    shuffled as one id. Rows alike in id and source are told apart by their place in the input. An
    empty table gives no rows; other columns are not read, whatever their names.

    Both orders are made by range partitioning, so a source of any size is spread over all tasks.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            # told from every name, so that a missing source is none of them
            F.concat(F.lit("="), F.col(source_col).cast("string")).alias("source"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("source", F.coalesce("source", F.lit(""))),
        "shard-rows",
    )
    key = shuffled(F.col("doc_id"), seed)
    placed = numbered(rows.withColumn("key", key), [F.col(c) for c in ("source", "key", "doc_id", "row")], "place", "shard-place")
    sources = stored(placed.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("rows")), "shard-sources")
    rank = F.col("place") - F.col("first")
    ranked = placed.join(sources, "source").select(
        "doc_id", "source", "size", "text_crc32", rank.alias("rank"), ((2 * rank + 1) / (2.0 * F.col("rows"))).alias("fraction")
    )
    woven = numbered(ranked, [F.col(c) for c in ("fraction", "source", "rank")], "place", "shard-woven")
    total = rows.count()
    shard = F.expr(f"(place * {shards}L) div {max(total, 1)}L")
    return woven.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int"),
        # the first place of a shard is the smallest whose product with `shards` reaches it
        (F.col("place") - F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
