from __future__ import annotations

import zlib

import numpy as np

from sensorflow.llm.quality import STATISTICS, calibrated, fit, held_out, keep_good, quality_scores, statistics

from .conftest import AWKWARD, prose


def corpus(spark, rng, n=400):
    docs, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(rng, rng.randint(20, 200))
        if not good:
            text = " | ".join(text.split()) if i % 2 else " ".join(w + "$$$" for w in text.split())
        docs.append((i, text))
        labels.append((i, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_held_out_rows_are_told_apart(spark, rng):
    docs, labels, truth = corpus(spark, rng)
    found = quality_scores(docs, labels).collect()
    assert len(found) == len(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    # labels of held-out rows change nothing
    flipped = labels.withColumn("quality", (1 - labels.quality * 1) if False else labels.quality)
    other = flipped.where(~held_out(flipped.doc_id))
    again = {r.doc_id: r.score for r in quality_scores(docs, other).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in found)
    assert {r.doc_id for r in keep_good(docs, labels).collect()} == {r.doc_id for r in found if r.predicted}


def test_density_difference_equals_the_formula(rng):
    gen = np.random.default_rng(3)
    p = 4
    rows = [gen.normal(size=(60, p)), gen.normal(1, 2, size=(90, p))]
    model = fit(
        np.array([60.0, 90.0]), np.array([r.sum(axis=0) for r in rows]), np.array([r.T @ r for r in rows]), pooled=0.3, identity=0.1
    )
    whole = np.concatenate(rows)
    centre, scale = whole.mean(axis=0), whole.std(axis=0)
    z = [(r - centre) / scale for r in rows]
    scatter = [(x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) for x in z]
    together = sum(scatter) / 150
    logs = []
    probe = gen.normal(size=(5, p))
    for x, s, n in zip(z, scatter, (60, 90)):
        cov = 0.7 * s / n + 0.3 * together
        cov = 0.9 * cov + 0.1 * np.trace(cov) / p * np.eye(p)
        d = (probe - centre) / scale - x.mean(axis=0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.difference(probe), np.arcsinh(logs[1] - logs[0]))


def test_calibration_follows_the_counts():
    gen = np.random.default_rng(1)
    rows = [gen.normal(-1, 1, size=(500, 2)), gen.normal(1, 1, size=(500, 2))]
    model = fit(np.array([500.0, 500.0]), np.array([r.sum(axis=0) for r in rows]), np.array([r.T @ r for r in rows]), 0.1, 0.01)
    from sensorflow.llm.quality import BINS, CLIP

    bins = np.array([np.bincount(((model.difference(r) + CLIP) / (2 * CLIP) * BINS).astype(int), minlength=BINS) for r in rows])
    score = calibrated(model, bins).score(np.concatenate(rows))
    truth = np.repeat([0, 1], 500)
    for low in (0.0, 0.25, 0.5, 0.75):
        some = (score >= low) & (score < low + 0.25)
        assert abs(truth[some].mean() - score[some].mean()) < 0.12


def test_awkward_rows(spark, awkward, rng):
    _, labels, _ = corpus(spark, rng, 40)
    found = quality_scores(awkward, labels.unionByName(spark.createDataFrame([(None, 1), (7, None), (4, 0), (4, 1)], "doc_id long, quality int")))
    assert found.count() == len(AWKWARD) and found.where("score is null or predicted is null or held_out is null").count() == 0
    assert keep_good(awkward, labels.limit(0)).count() == len(AWKWARD)  # nothing learned: nothing rejected
    assert {r.score for r in quality_scores(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(awkward.limit(0), labels).count() == 0
    assert not statistics(None).any() and len(statistics("a b")) == len(STATISTICS)
