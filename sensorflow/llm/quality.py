"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class, low (label 0) and good (label 1), is a normal distribution over statistics of the text
that are transformed to be roughly bell-shaped. Its covariance is shrunk towards the covariance of
both classes together and towards a multiple of the identity, and factored once (Cholesky); a
document's score comes from the difference of the two log densities, each a Mahalanobis distance
and a log determinant. Spark adds up counts, sums and products per class over all labelled rows,
so fitting never gathers documents; the factors are a few kilobytes and travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import stored

SHRINK_POOLED = 0.5  # share of the pooled covariance in a class covariance
SHRINK_IDENTITY = 0.01  # then share of the scaled identity
THRESHOLD = 0.3
BINS = 400  # log-density differences are counted in this many bins for calibration
CLIP = 20.0  # squashed differences beyond this count as this much

STATISTICS = (
    "words", "word_length", "word_length_spread", "distinct", "repeats", "top_word",
    "line_repeats", "line_words", "upper", "digits", "stops", "pipes", "bangs", "symbols",
    "non_ascii", "sentence_words", "single_letters",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789",
    "stops": b".,;:",
    "pipes": b"|",
    "bangs": b"!?",
    "symbols": b"#$%&*@^~=<>{}[]\\_+",
}
_BYTES = {name: np.frombuffer(which, np.uint8) for name, which in _CLASSES.items()}


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of one whole text, in the order of `STATISTICS`; null counts as empty."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return np.zeros(len(STATISTICS))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = {name: counts[which].sum() / len(data) for name, which in _BYTES.items()}
    lengths = np.fromiter(map(len, words), np.float64, n)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    lines = [line for line in data.split(b"\n") if line]
    sentences = 1 + counts[ord(".")]
    root = np.sqrt
    return np.array(
        [
            np.log1p(n),
            np.log1p(lengths.mean()),
            np.log1p(lengths.std()),
            np.log1p(len(seen)) - 0.8 * np.log1p(n),
            root(sum(map(eq, words, words[1:])) / n),
            root(max(seen.values()) / n),
            root(1 - len(set(lines)) / max(1, len(lines))),
            np.log1p(n / max(1, len(lines))),
            root(share["upper"] / max(1e-9, share["upper"] + share["lower"])),
            root(share["digits"]),
            root(share["stops"]),
            root(share["pipes"]),
            root(share["bangs"]),
            root(share["symbols"]),
            root(counts[128:].sum() / len(data)),
            np.log1p(n / sentences),
            root(float((lengths == 1).mean())),
        ]
    )


@dataclass(frozen=True)
class Discriminant:
    """Cached factors of both classes and the calibration of their log-density difference."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray  # class, statistic
    inverse_factors: np.ndarray  # class, statistic, statistic: inverse of the Cholesky factor
    log_determinants: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Log density as good text minus log density as low text, squashed by the inverse hyperbolic sine."""
        z = (rows - self.centre) / self.scale
        logs = [
            -0.5 * (np.square((z - mean) @ factor.T).sum(axis=1) + log_determinant)
            for mean, factor, log_determinant in zip(self.means, self.inverse_factors, self.log_determinants)
        ]
        return np.clip(np.arcsinh(logs[1] - logs[0]), -CLIP, CLIP)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.difference(rows) + self.offset)))


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float, identity: float) -> Discriminant:
    """Discriminant from each class's row count, sums and sums of products."""
    p = sums.shape[1]
    n = counts.sum()
    centre = sums.sum(axis=0) / n
    scale = np.sqrt(np.maximum(np.diag(products.sum(axis=0)) / n - centre**2, 1e-6))
    means = sums / counts[:, None]
    scatter = np.array([products[k] - counts[k] * np.outer(means[k], means[k]) for k in (0, 1)])
    scatter /= np.outer(scale, scale)
    together = scatter.sum(axis=0) / n
    factors, log_determinants = [], []
    for k in (0, 1):
        covariance = (1 - pooled) * scatter[k] / counts[k] + pooled * together
        covariance = (1 - identity) * covariance + identity * max(np.trace(covariance) / p, 1e-3) * np.eye(p)
        factor = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(factor))
        log_determinants.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(centre, scale, (means - centre) / scale, np.array(factors), np.array(log_determinants))


def calibrated(model: Discriminant, bins: np.ndarray) -> Discriminant:
    """`model` with the slope and offset of a logistic curve through the classes' counts by bin.

    The targets are pulled in by one row per class, so that classes which do not overlap give a
    finite slope. Newton steps are halved until they lower the loss.
    """
    x = (np.arange(BINS) + 0.5) / BINS * 2 * CLIP - CLIP
    low, good = bins.sum(axis=1)
    weight = bins.sum(axis=0)
    hits = bins[1] * (good + 1) / (good + 2) + bins[0] / (low + 2)
    design = np.stack([x, np.ones_like(x)])

    def loss(ab: np.ndarray) -> float:
        return float((weight * np.logaddexp(0, ab @ design) - hits * (ab @ design)).sum())

    ab = np.array([0.1, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(ab @ design, -500, 500)))
        hessian = (design * (weight * p * (1 - p))) @ design.T + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, design @ (hits - weight * p)), 1.0
        while size > 1e-6 and loss(ab + size * step) > loss(ab):
            size /= 2
        ab = ab + size * step
        if np.abs(size * step).max() < 1e-8 or size <= 1e-6:
            break
    return replace(model, slope=max(float(ab[0]), 0.0), offset=float(ab[1]))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id` and `statistics`, kept as a stored table."""
    return stored(docs.select(F.col(id_col).alias("doc_id"), _statistics(text_col).alias("statistics")), "quality")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows kept away from fitting: those whose id, as text, has a CRC-32 divisible by `folds`.

    A missing id counts as empty text, so it is held out.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit_quality(
    described: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    pooled: float = SHRINK_POOLED,
    identity: float = SHRINK_IDENTITY,
) -> Discriminant | None:
    """Discriminant learned from `with_statistics` rows that have a label and are not held out.

    A document with several labels takes their rounded mean; labels and ids that are null are left
    out. None if a class has no rows: there is nothing to tell apart.
    """
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    train = stored(described.join(known, "doc_id").select("label", "statistics"), "quality-train")
    p = len(STATISTICS)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + p + p * p))
        for batch in batches:
            for k, group in batch.groupby("label"):
                rows = np.stack(group["statistics"].to_numpy())
                total[k] += np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
        label, place = np.indices(total.shape)
        yield pd.DataFrame({"label": label.ravel(), "place": place.ravel(), "value": total.ravel()})

    def summed(frame: DataFrame, places: int) -> np.ndarray:
        out = np.zeros((2, places))
        for row in frame.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
            out[row.label, row.place] = row.value
        return out

    moments = summed(train.mapInPandas(partial, "label int, place int, value double"), 1 + p + p * p)
    if not moments[:, 0].all():
        return None
    model = fit(moments[:, 0], moments[:, 1 : 1 + p], moments[:, 1 + p :].reshape(2, p, p), pooled, identity)

    @F.pandas_udf("int")
    def bin_of(rows: pd.Series) -> pd.Series:
        place = (model.difference(np.stack(rows.to_numpy())) + CLIP) / (2 * CLIP) * BINS
        return pd.Series(np.clip(place.astype(int), 0, BINS - 1))

    return calibrated(model, summed(train.select("label", bin_of("statistics").alias("place"), F.lit(1.0).alias("value")), BINS))


def score_column(model: Discriminant | None, statistics_col: str = "statistics") -> Column:
    """Score of a `statistics` column, 0 to 1: how likely the text is good. 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(rows.to_numpy())) if len(rows) else [], dtype=float)

    return score(statistics_col)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `held_out`, `score` and `predicted` (1: score at or above the threshold).

    Null and empty texts have statistics of zero and are scored like any other; repeated rows get
    equal scores; an empty table gives no rows. Other columns are not read, whatever their names.
    """
    described = with_statistics(docs, id_col, text_col)
    scored = described.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(fit_quality(described, labels, label_col, id_col)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`docs`, all columns, without the rows that score below the threshold.

    Every text is described once: the rows are stored with their statistics, which both the fit and
    the decision read, and no scores have to be joined to documents.
    """
    described = stored(docs.withColumn("__statistics", _statistics(text_col)), "quality-rows")
    statistics_of = described.select(F.col(id_col).alias("doc_id"), F.col("__statistics").alias("statistics"))
    model = fit_quality(statistics_of, labels, label_col, id_col)
    return described.where(score_column(model, "__statistics") >= threshold).drop("__statistics")
