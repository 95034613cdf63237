"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are a text's distinct words and the beginnings of words; a beginning counts how many
distinct words share it, so inflected forms of a stem add up. One weight per feature, shared by all
thresholds, gives a text its place on a line; ordered thresholds cut the line into grades of
severity, and the chance of a grade above k is the logistic function of the place minus threshold k.
The weights are fitted with an L1 penalty on a bounded sample, so that few features carry any;
scoring looks the words of each whole text up among them. The expected grade is the severity.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import held_out
from .tables import stored

SAMPLE_ROWS = 8_000  # most labelled documents that are fitted
FEATURES = 10_000  # most features that are fitted
LEAST_DOCS = 8  # a feature of fewer documents of the sample gets no weight
PENALTY = 3e-4  # L1 penalty per weight, of the mean loss
ROUNDS = 500
FLAG = 0.35  # chance of any toxicity from which a document is flagged
GRADES = 4
BEGINNINGS = (4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> Counter:
    """Distinct lower-cased words of a whole text, marked as whole, and how many of them share a beginning."""
    found: Counter = Counter()
    for word in set(_WORD.findall((text or "").lower())):
        found[word + "$"] += 1
        for size in BEGINNINGS:
            if len(word) >= size:
                found[word[:size]] += 1
    return found


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[str, float]  # features with a weight
    thresholds: np.ndarray  # one fewer than grades, ascending

    def place(self, text: str | None) -> float:
        known, met = self.weights, Counter()
        for word in set(_WORD.findall((text or "").lower())):
            if (whole := word + "$") in known:
                met[whole] += 1
            for size in BEGINNINGS:
                if len(word) >= size and word[:size] in known:
                    met[word[:size]] += 1
        return sum(known[feature] * np.log1p(n) for feature, n in sorted(met.items()))

    def above(self, texts: pd.Series) -> np.ndarray:
        """Chance that each text's grade is above 0, 1, ..."""
        places = np.array([self.place(text) for text in texts], float)
        return _logistic(places[:, None] - self.thresholds)


@dataclass(frozen=True)
class Sample:
    """Features of documents as triples (document, feature, count)."""

    row: np.ndarray
    col: np.ndarray
    count: np.ndarray
    names: list[str]
    labels: np.ndarray


def fit_ordinal(sample: Sample, grades: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> OrdinalModel:
    """Weights and thresholds of greatest likelihood under the L1 penalty, by proximal adaptive steps.

    Thresholds start at the observed shares of the grades and are kept in order.
    """
    levels, n, size = max(int(grades.max(initial=0)) + 1, 2), len(grades), len(sample.names)
    row, col, value = sample.row, sample.col, np.log1p(sample.count)
    shares = np.array([(np.sum(grades > k) + 0.5) / (n + 1) for k in range(levels - 1)])
    thresholds = np.maximum.accumulate(-np.log(shares / (1 - shares)))
    weights, seen_w, seen_t = np.zeros(size), np.full(size, 1e-8), np.full(levels - 1, 1e-8)
    for _ in range(rounds):
        places = np.bincount(row, weights=weights[col] * value, minlength=n)
        edges = np.concatenate([[-40.0], thresholds, [40.0]])
        upper, lower = _logistic(edges[grades + 1] - places), _logistic(edges[grades] - places)
        chance = np.maximum(upper - lower, 1e-9)
        step = np.bincount(col, weights=(1 - upper - lower)[row] * value, minlength=size) / n
        inner, outer = lower * (1 - lower) / chance, upper * (1 - upper) / chance
        turn = np.array([inner[grades == k + 1].sum() - outer[grades == k].sum() for k in range(levels - 1)]) / n
        seen_w += step**2
        seen_t += turn**2
        rate = 1 / np.sqrt(seen_w)
        weights = weights - rate * step
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * penalty, 0)
        thresholds = np.maximum.accumulate(thresholds - 0.2 / np.sqrt(seen_t) * turn)
    return OrdinalModel({name: float(w) for name, w in zip(sample.names, weights) if w}, thresholds)


def graded(sample: Sample, grades: int = GRADES) -> np.ndarray:
    """Severity grades where labels only say whether a text is toxic.

    Grade 0 is not toxic. Toxic texts are graded by how many marker features they have, a grade more
    for four times as many: markers are at least four times as common in toxic texts as in others.
    """
    toxic = np.minimum(sample.labels, 1)
    size = len(sample.names)
    bad = np.bincount(sample.col, weights=toxic[sample.row], minlength=size)
    good = np.bincount(sample.col, minlength=size) - bad
    n_bad, n_good = toxic.sum() + 1, len(toxic) - toxic.sum() + 1
    marker = (bad >= 0.02 * n_bad) & (bad / n_bad > 4 * (good + 0.5) / n_good)
    hits = np.bincount(sample.row, weights=marker[sample.col] * sample.count, minlength=len(toxic))
    steps = (np.log2(np.maximum(hits, 1)) // 2).astype(int)
    return np.where(toxic == 1, 1 + np.minimum(steps, grades - 2), 0)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int, most_features: int
) -> Sample | None:
    """The `sample_rows` labelled, not held-out ids with the smallest hashes, and their most telling features.

    Labels and ids that are null are left out; of several labels of an id the highest counts, and of
    several texts of an id the one with the smallest hash. None without any.
    """
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & (F.col("label") >= 0) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "toxicity-labels")
    texts = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(known), "doc_id")  # as many rows as the sample has
        .groupBy("doc_id")
        .agg(F.first("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    )

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, label, text in zip(batch["row"], batch["label"], batch["text"]):
                if found := features(text):
                    yield pd.DataFrame({"row": row, "label": label, "feature": list(found), "n": list(found.values())})

    texts = stored(texts.withColumn("row", F.monotonically_increasing_id()), "toxicity-texts")
    rows = np.array([tuple(r) for r in texts.select("row", "label").orderBy("row").collect()], np.int64).reshape(-1, 2)
    if not len(rows):
        return None
    counts = stored(texts.mapInPandas(counted, "row long, label int, feature string, n int"), "toxicity-features")
    bad, total = max(int((rows[:, 1] > 0).sum()), 1), max(int((rows[:, 1] == 0).sum()), 1)
    toxic, clean = F.sum((F.col("label") > 0).cast("int")), F.sum((F.col("label") == 0).cast("int"))
    telling = F.abs(F.log(((toxic + 0.5) / bad) / ((clean + 0.5) / total))) * F.sqrt(F.count("*"))
    chosen = counts.groupBy("feature").agg(F.count("*").alias("docs"), telling.alias("telling")).where(F.col("docs") >= LEAST_DOCS)
    names = sorted(r.feature for r in chosen.orderBy(F.desc("telling"), "feature").limit(most_features).select("feature").collect())
    numbered = docs.sparkSession.createDataFrame(list(enumerate(names)), "col int, feature string")
    found = counts.join(F.broadcast(numbered), "feature").select("row", "col", "n").toArrow()
    places = {int(row): at for at, row in enumerate(rows[:, 0])}
    row = np.array([places[r] for r in found.column("row").to_pylist()], np.int64)
    return Sample(row, found.column("col").to_numpy().astype(np.int64), found.column("n").to_numpy(), names, rows[:, 1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    most_features: int = FEATURES,
    grade_labels: bool = True,
) -> OrdinalModel | None:
    """Ordinal model of a bounded labelled sample; with `grade_labels` the labels are 0 and 1, else grades from 0."""
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, sample_rows, most_features)
    if sample is None:
        return None
    return fit_ordinal(sample, graded(sample) if grade_labels else sample.labels)


def severities(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    grade_labels: bool = True,
    flag: float = FLAG,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `held_out`, `expected_severity`, `severity`, `score`, `predicted`.

    `expected_severity` is the mean grade under the model, `severity` the likeliest grade, `score` the
    chance of any grade above 0 and `predicted` 1 where that reaches `flag`. `held_out` tells rows
    whose labels are never fitted.

    Null and empty texts have no words and get the model's chance without any. Repeated rows get
    equal rows, an empty table none; without usable labels every score is 0. Other columns are not
    read, whatever their names.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, label_col, sample_rows, grade_labels=grade_labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def above(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if shared.value is None:
                yield pd.Series([np.zeros(1)] * len(texts), dtype=object)
            else:
                yield pd.Series(list(shared.value.above(texts)), dtype=object)

    scored = docs.select(F.col(id_col).alias("doc_id"), above(text_col).alias("above"))
    below = F.concat(F.array(F.lit(1.0)), "above")
    chances = F.transform(below, lambda p, k: p - F.coalesce(F.get("above", k), F.lit(0.0)))
    return scored.select("doc_id", "above", chances.alias("chances")).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.aggregate("above", F.lit(0.0), lambda s, p: s + p).alias("expected_severity"),
        (F.array_position("chances", F.array_max("chances")) - 1).cast("int").alias("severity"),
        F.get("above", F.lit(0)).alias("score"),
        (F.get("above", F.lit(0)) >= flag).cast("int").alias("predicted"),
    )
