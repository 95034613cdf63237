from __future__ import annotations

import random

import pytest

SYLLABLES = ["ta", "re", "mon", "li", "ves", "or", "an", "ki", "du", "pel", "sho", "ir", "ne", "bra", "cul"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = words(rng, n)
    for i in range(9, n, 10):
        out[i] += "."
    return " ".join(out)


@pytest.fixture
def rng():
    return random.Random(11)


# Rows that every operator must take: nulls in any column, empty and blank texts, repeated rows, ties, one
# long text; and columns whose names are those of results and helpers.
AWKWARD = [
    (1, None, None), (1, None, None), (None, "plain words here", "a"), (None, "plain words here", "a"), (None, None, None),
    (2, "", "b"), (3, " \t\n ", "b"), (4, "one", "b"), (4, "two other words", None), (5, "long " * 30_000, "c"),
]
CLASHING = ("row", "fp", "place", "score", "doc", "word", "fingerprint", "component_id", "part", "key", "size", "hashes", "seed", "ids", "spans", "candidates", "statistics")


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(AWKWARD, "doc_id long, text string, source string")
    return frame.select("*", *(F.lit("x").alias(name) for name in CLASHING)).repartition(3)
