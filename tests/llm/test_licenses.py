from __future__ import annotations

import re

from pyspark.sql import functions as F

from sensorflow.llm import licenses as module
from sensorflow.llm.licenses import TEMPLATES, UNKNOWN, licenses

from .conftest import prose


def test_families_are_named_and_other_text_is_not(spark, rng):
    docs, want = [], {}
    for i, (family, texts) in enumerate(TEMPLATES.items()):
        for j, text in enumerate(texts):
            number = 100 * i + j
            docs.append((number, prose(rng, 12) + "\n" + text + "\n" + prose(rng, 5)))
            want[number, 1] = family
    docs += [(9000 + i, "\n".join(prose(rng, rng.randint(1, 30)) for _ in range(4))) for i in range(60)]
    found = licenses(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    named = {(r.doc_id, r.paragraph): r.family for r in found}
    assert set(named) == set(want)
    # "SPDX-License-Identifier" lines share most runs of words with others of their kind
    assert sum(named[k] == want[k] for k in want) >= len(want) - 2
    assert all(0.5 <= r.probability <= 1 and 0 <= r.agreement <= 1 for r in found)


def test_changed_wording_and_unknown_licenses(spark, rng):
    rows = [
        (1, "This software is released under the MIT license, see the file."),
        (2, "You may use this file under the terms of some other License agreement."),
        (3, "the license of driving a car in the version of the law"),
        (4, "Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0."),
        (5, "ALL RIGHTS RESERVED"),
    ] + [(100 + i, prose(rng, 40)) for i in range(40)]
    found = {(r.doc_id, r.paragraph): r.family for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1, 0] == "MIT" and found[2, 0] == UNKNOWN and found[5, 0] == "proprietary"
    assert found[4, 0] == found[4, 1] == "Apache-2.0"
    assert {i for i, _ in found} <= {1, 2, 4, 5}


def test_awkward_rows(spark, awkward):
    from pyspark.sql import functions as F

    assert licenses(awkward).count() == 0
    assert licenses(awkward.limit(0)).count() == 0
    noted = awkward.withColumn("text", F.concat(F.col("text"), F.lit("\nReleased under the MIT License.")))
    found = licenses(noted).collect()  # rows without a text have no notice
    assert len(found) == 7 and {r.family for r in found} == {"MIT"}
    assert sum(r.doc_id is None for r in found) == 2


def test_copies_do_not_thin_the_sample_of_other_text(spark, rng):
    texts = [prose(rng, 12) for _ in range(50)]
    chosen = F.get(F.array(*map(F.lit, texts)), F.when(F.col("id") < 50, F.col("id")).otherwise(0).cast("int"))
    docs = spark.range(50_000).select(F.col("id").alias("doc_id"), chosen.alias("text"))  # 99.9 % copies
    fixed = module.template_table(spark, TEMPLATES)
    others = module._examples(docs, fixed, "doc_id", "text", 400, 20).where(F.col("family") == module.OTHER)
    assert others.count() == 50
    some = module._examples(docs, fixed, "doc_id", "text", 5, 20).where(F.col("family") == module.OTHER)
    assert some.count() == 5


def test_every_line_is_scored(spark, rng):
    # no line but the last has a run of three words in common with a template
    notices = ["Eclipse Public License 2.0", "Licensed under MIT", "MIT License", "Licensed under the EPL", "Released under the MIT License."]
    docs = [(i, text) for i, text in enumerate(notices)] + [(100 + i, prose(rng, 40)) for i in range(40)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses(docs, threshold=0.02).collect()}
    assert found[1].family == UNKNOWN and found[1].agreement == 0 and found[4].family == "MIT"

    # the bound leaves out no line that reaches the threshold
    fixed = module.template_table(spark, TEMPLATES)
    model = module.fit_licenses(module._examples(docs, fixed, "doc_id", "text", 400, 20))
    lines = docs.select("doc_id", module._hashes(F.col("text")).alias("hashes"))
    weights = {r.feature: r.weights for r in model.weights.collect()}
    margins = {r.doc_id: r.margin for r in lines.select("doc_id", module._margin(model, F.col("hashes")).alias("margin")).collect()}
    other = model.families.index(module.OTHER)
    for row in lines.select("doc_id", module._features(F.col("hashes")).alias("features")).collect():
        hits = [weights[f] for f in row.features if f in weights]
        raw = [x + sum(w[k] for w in hits) for k, x in enumerate(model.intercepts)]
        assert max(x for k, x in enumerate(raw) if k != other) - raw[other] <= margins[row.doc_id] + 1e-9


def test_short_lines_are_confirmed_by_shorter_runs(spark):
    lines = spark.createDataFrame([(["mit", "license"],), (["mit"],), (["released", "under", "the"],)], "w array<string>")
    sizes = lines.select(F.size(module._longest_runs(F.transform("w", lambda x: F.xxhash64(x)))).alias("n")).collect()
    assert [r.n for r in sizes] == [1, 1, 1]


def plain_runs(text, size=3):
    found = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    size = min(size, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}, size


def test_shared_wording_names_all_its_families(spark, rng):
    shared = "This program is free software; you can redistribute it and/or"
    rows = [(1, shared), (2, "Released under the MIT License.")] + [(100 + i, prose(rng, 40)) for i in range(40)]
    found = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.3).collect()}
    own, size = plain_runs(shared)
    shares = {family: max(len(own & plain_runs(t, size)[0]) / min(len(own), len(plain_runs(t, size)[0])) for t in texts) for family, texts in TEMPLATES.items()}
    best = max(shares.values())
    assert found[1].family == "/".join(sorted(f for f, s in shares.items() if s == best)) and "/" in found[1].family
    assert abs(found[1].agreement - best) < 1e-12 and found[2].family == "MIT"


def test_agreement_and_family_equal_a_plain_comparison(spark, rng):
    """What is reported for every notice, from the model's own chances and the templates, run by run."""
    notices = [text for texts in TEMPLATES.values() for text in texts]
    rows = [(i, text) for i, text in enumerate(notices)] + [(1000 + i, prose(rng, 40)) for i in range(60)]
    found = {r.doc_id: r for r in licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) >= 0.9 * len(notices) and max(found) < 1000
    for doc_id, r in found.items():
        own, size = plain_runs(notices[doc_id])
        shares = {}
        for family, texts in TEMPLATES.items():
            theirs = [plain_runs(t, size)[0] for t in texts]
            shares[family] = max(len(own & t) / min(len(own), len(t)) if t else 0 for t in theirs)
        if r.family == UNKNOWN:
            assert r.agreement < 0.6
        else:
            assert r.family.split("/") == sorted(f for f, s in shares.items() if s >= r.agreement - 1e-12) and r.agreement >= 0.6
