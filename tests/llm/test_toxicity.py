from __future__ import annotations

import itertools
import math

import numpy as np

from sensorflow.llm.toxicity import OrdinalModel, Sample, features, fit_ordinal, fit_toxicity, graded, severities

from .conftest import AWKWARD, prose

BAD = ["grunk", "sneeb", "vorpish", "blarg"]


def corpus(spark, rng, n=400):
    docs, labels, hits = [], [], {}
    for i in range(n):
        words = prose(rng, rng.randint(20, 120)).split()
        hits[i] = rng.choice([1, 2, 4, 6]) if i % 5 == 0 else 0
        for _ in range(hits[i]):
            words.insert(rng.randint(0, len(words)), rng.choice(BAD) + rng.choice(["", "ta", "mon", "li"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(hits[i] > 0)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), hits


def test_held_out_rows_are_graded(spark, rng):
    docs, labels, hits = corpus(spark, rng)
    found = [r for r in severities(docs, labels).collect()]
    assert len(found) == len(hits)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == (hits[r.doc_id] > 0) for r in held]) > 0.93
    mean = {k: np.mean([r.expected_severity for r in held if hits[r.doc_id] == k]) for k in (0, 1, 6)}
    assert mean[0] < mean[1] < mean[6]
    for r in found:
        assert 0 <= r.score <= 1 and 0 <= r.expected_severity <= 3 and r.predicted == int(r.score >= 0.35)


def test_gradient_leads_to_the_greatest_likelihood():
    gen = np.random.default_rng(5)
    n, size = 300, 4
    counts = gen.integers(0, 3, size=(n, size))
    place = np.log1p(counts) @ np.array([2.0, -1.0, 0.0, 0.5])
    grades = np.array([int(np.sum(gen.random() < 1 / (1 + np.exp(-(p - np.array([0.0, 1.5])))))) for p in place]).clip(0, 2)
    row, col = np.nonzero(counts)
    sample = Sample(row, col, counts[row, col], [f"f{k}" for k in range(size)], grades)
    model = fit_ordinal(sample, grades, penalty=0, rounds=3000)

    def loss(weights, thresholds):
        s = np.log1p(counts) @ weights
        edges = np.concatenate([[-40], thresholds, [40]])
        sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        return -np.log(np.maximum(sig(edges[grades + 1] - s) - sig(edges[grades] - s), 1e-12)).mean()

    w = np.array([model.weights.get(f"f{k}", 0.0) for k in range(size)])
    best = loss(w, model.thresholds)
    for _ in range(200):  # nothing near is better
        assert loss(w + gen.normal(0, 0.1, size), model.thresholds + gen.normal(0, 0.1, 2)) > best - 1e-4
    assert model.thresholds[0] <= model.thresholds[1]


def test_grades_rise_with_markers():
    labels = np.array([1] * 20 + [0] * 80)
    row = np.concatenate([np.arange(20), np.arange(10), np.arange(100)])
    col = np.concatenate([np.zeros(20, int), np.ones(10, int), np.full(100, 2)])
    count = np.concatenate([np.ones(20, int), np.full(10, 15), np.ones(100, int)])
    grades = graded(Sample(row, col, count, ["bad", "worse", "common"], labels))
    assert set(grades[:10]) == {3} and set(grades[10:20]) == {1} and set(grades[20:]) == {0}


def plain_severity(text, model):
    """Expected grade and likeliest grade of one text, word by word."""
    place = 0.0
    counts = {}
    for word in {"".join(g) for k, g in itertools.groupby((text or "").lower(), str.isalpha) if k}:
        for feature in [word + "$", *(word[:size] for size in (4, 5, 6, 7) if len(word) >= size)]:
            counts[feature] = counts.get(feature, 0) + 1
    for feature, n in counts.items():
        place += model.weights.get(feature, 0.0) * math.log1p(n)
    above = [1.0, *(1 / (1 + math.exp(t - place)) for t in model.thresholds), 0.0]
    chances = [x - y for x, y in zip(above, above[1:])]
    return sum(above[1:]), max(range(len(chances)), key=chances.__getitem__), above[1]


def test_the_query_equals_a_plain_computation(spark, rng):
    docs, labels, _ = corpus(spark, rng, 200)
    model = fit_toxicity(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in severities(docs, labels).collect():
        expected, likeliest, score = plain_severity(texts[r.doc_id], model)
        assert math.isclose(r.expected_severity, expected, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9) and r.severity == likeliest


def test_chances_add_up():
    model = OrdinalModel({"bad$": 3.0}, np.array([0.0, 1.0, 4.0]))
    import pandas as pd

    above = model.above(pd.Series(["fine", "bad bad", None]))
    assert above.shape == (3, 3) and (np.diff(above, axis=1) <= 0).all()
    assert above[1, 0] > above[0, 0] == above[2, 0] == 0.5
    assert features("Bad, bad! Badly") == {"bad$": 1, "badly$": 1, "badl": 1, "badly": 1}


def test_awkward_rows(spark, awkward, rng):
    _, labels, _ = corpus(spark, rng, 30)
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (6, None), (4, 0), (4, 1)], "doc_id long, toxic int"))
    found = severities(awkward, labels).collect()
    assert len(found) == len(AWKWARD) and all(r.score is not None and r.severity is not None for r in found)
    assert {r.score for r in severities(awkward, labels.limit(0)).collect()} == {0.0}
    assert severities(awkward.limit(0), labels).count() == 0
