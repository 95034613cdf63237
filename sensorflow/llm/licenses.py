"""License scans: a trained paragraph classifier names the licence family, templates confirm it.

Paragraphs are lines. Their features are runs of one to three words that occur in the licence
templates; a multinomial logistic regression over them tells the families apart and has a class of
its own for other text, learned from paragraphs of the corpus. Its probabilities are calibrated by
one temperature, on other text that is held out and on pieces of the templates, which are few and
are fitted as well: between families the probabilities are too sure. A family is reported if it is
likelier than the threshold and if the paragraph shares enough of its three-word runs with one of
the family's templates; a paragraph that looks like a licence but agrees with no template is
reported as `unknown`. Wording that templates of several families share equally is reported under all their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .decontaminate import words
from .tables import stored

OTHER = "other"
UNKNOWN = "unknown"
THRESHOLD = 0.5  # least calibrated probability of a family
AGREEMENT = 0.6  # least share of three-word runs in common with a template
SAMPLE_DOCS = 400  # documents whose paragraphs are examples of other text: bounds the training rows
SAMPLE_LINES = 20  # paragraphs taken of each of them
SHORTEST = 4  # words of the shortest piece of a template that is an example
PLACES = 8192  # of the arrays in which a paragraph's features are looked up
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
# Paragraphs with such words are no examples of other text.
CUES = r"(?i)licen[sc]|copyright|copyleft|warrant|redistribut|sublicens|public domain|rights reserved|creative commons"

# The wording of common licence notices.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU General Public License version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright, all rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, without the prior written permission of the publisher.",
        "This document is proprietary and confidential.",
    ),
}


def _runs(found: Column, size: int) -> Column:
    """Runs of `size` words, as hashes, of an array of words' hashes; empty if there are fewer."""
    n = F.size(found)
    starts = F.when(n >= size, F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(size), *(F.get(found, i + j) for j in range(size))))


def _longest_runs(found: Column) -> Column:
    """Runs of three words, or of all words where there are fewer."""
    return F.when(F.size(found) >= 3, _runs(found, 3)).when(F.size(found) == 2, _runs(found, 2)).otherwise(_runs(found, 1))


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _features(found: Column) -> Column:
    return F.concat(*(_runs(found, size) for size in (1, 2, 3)))


def template_table(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """`family`, `template` (its number) and `hashes` of the words of each template; fixed input."""
    rows = [(family, text) for family, texts in templates.items() for text in texts]
    schema = T.StructType([T.StructField("family", T.StringType()), T.StructField("template", T.IntegerType()), T.StructField("text", T.StringType())])
    frame = spark.createDataFrame([(family, number, text) for number, (family, text) in enumerate(rows)], schema)
    return stored(frame.select("family", "template", _hashes(F.col("text")).alias("hashes")), "templates")


def _pieces(templates: DataFrame) -> DataFrame:
    """Examples of the families: every template and its stretches of two thirds and of a third of its words."""
    n = F.size("hashes")
    lengths = F.array_distinct(F.array(n, F.greatest(F.ceil(n * 2 / 3), F.least(n, F.lit(SHORTEST))), F.greatest(F.ceil(n / 3), F.least(n, F.lit(SHORTEST)))))
    cut = templates.select("family", "hashes", F.explode(lengths).alias("length"))
    cut = cut.withColumn("start", F.explode(F.sequence(F.lit(1), (F.size("hashes") - F.col("length") + 1).cast("int"))))
    return cut.select("family", F.slice("hashes", F.col("start"), F.col("length").cast("int")).alias("hashes"))


def _examples(docs: DataFrame, templates: DataFrame, id_col: str, text_col: str, sample_docs: int, sample_lines: int) -> DataFrame:
    """Training rows `family` and `hashes`: pieces of templates, and paragraphs of the corpus as `other`.

    The sample are the different texts with the smallest hashes, so it is the same however the table
    is split into files. Only hashes below a bound that some four times as many different texts stay
    under are sorted, so that no task gets a sample of every other one. The bound goes by the number
    of different texts (estimated to a few hundredths), so copies and nulls do not lower it.
    """
    mark = F.xxhash64(text_col)
    texts = docs.where(F.col(text_col).isNotNull()).agg(F.approx_count_distinct(mark)).first()[0]
    share = min(1.0, 4 * sample_docs / max(texts, 1))
    some = docs.where(F.col(text_col).isNotNull() & (mark <= int(share * (1 << 64)) - (1 << 63) - 1))
    some = some.select(F.slice(F.split(text_col, "\n", -1), 1, sample_lines).alias("lines"), mark.alias("mark"))
    some = some.groupBy("mark").agg(F.first("lines").alias("lines"))  # one of equal texts, before they are sent
    some = some.orderBy("mark").limit(sample_docs).select(F.explode("lines").alias("line"))
    some = some.where(~F.rlike("line", F.lit(CUES))).select(F.lit(OTHER).alias("family"), _hashes(F.col("line")).alias("hashes")).distinct()
    return stored(_pieces(templates).distinct().union(some), "license-examples")


@dataclass(frozen=True)
class LicenseModel:
    families: tuple[str, ...]
    weights: DataFrame  # feature, weights by family
    intercepts: tuple[float, ...]
    temperature: float


def fit_licenses(examples: DataFrame, strength: float = 1e-3) -> LicenseModel:
    """Multinomial logistic regression over the templates' runs of words, with its temperature.

    Every fifth example by the hash of its words is held out of the fit and calibrates it.
    """
    spark = examples.sparkSession
    families = tuple(sorted(row.family for row in examples.select("family").distinct().collect()))
    runs = F.transform(_features(F.col("hashes")), lambda h: h.cast("string"))
    rows = examples.select(
        F.array_position(F.lit(list(families)), F.col("family")).cast("double").alias("place"),
        runs.alias("runs"),
        (F.pmod(F.xxhash64("hashes"), F.lit(5)) == 0).alias("held"),
        (F.col("family") == OTHER).alias("other"),
    ).withColumn("label", F.col("place") - 1)
    rows = stored(rows, "license-rows")
    known = sorted(row.run for row in rows.where(~F.col("other")).select(F.explode("runs").alias("run")).distinct().collect())
    vectors = CountVectorizerModel.from_vocabulary(known, inputCol="runs", outputCol="features")
    counted = vectors.transform(rows)
    # held-out pieces of templates are too few to leave out: they calibrate and are also fitted
    fitted = LogisticRegression(family="multinomial", regParam=strength, maxIter=60).fit(counted.where(~F.col("held") | ~F.col("other")))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = spark.createDataFrame(
        [(int(run), [float(x) for x in matrix[:, at]]) for at, run in enumerate(known)], "feature long, weights array<double>"
    )
    judged = fitted.transform(counted.where(F.col("held"))).select(vector_to_array("rawPrediction").alias("raw"), F.col("label").cast("int").alias("label"))
    losses = [
        F.avg(-F.log(F.greatest(F.get(_softmax(F.col("raw"), t), F.col("label")), F.lit(1e-12)))).alias(f"loss{i}") for i, t in enumerate(TEMPERATURES)
    ]
    found = judged.agg(*losses).first()
    temperature = min((loss, t) for loss, t in zip(found, TEMPERATURES))[1] if found[0] is not None else 1.0
    return LicenseModel(families, stored(weights, "license-weights"), tuple(map(float, intercepts)), temperature)


def _softmax(raw: Column, temperature: float) -> Column:
    exps = F.transform(raw, lambda x: F.exp((x - F.array_max(raw)) / temperature))
    return F.transform(exps, lambda e: e / F.aggregate(exps, F.lit(0.0), lambda s, x: s + x))


def licenses(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    agreement: float = AGREEMENT,
    sample_docs: int = SAMPLE_DOCS,
    sample_lines: int = SAMPLE_LINES,
) -> DataFrame:
    """One row for each paragraph that reads like a licence notice.

    Columns: `doc_id`, `paragraph` (the line's number), `family`, `probability` (calibrated, of the
    likeliest family) and `agreement` (share of three-word runs in common with that family's best
    template). Where `agreement` is too small `family` is `unknown`. Wording that templates of other
    families share as well as those of the likeliest is no evidence for one of them: `family` names all of these
    in order, joined by a stroke, and `probability` is that of any of them.

    Null and empty texts have no paragraphs that qualify; repeated rows give repeated rows of the
    result; a null id is kept. An empty table gives no rows, and so does one in which nothing reads
    like a licence. Other columns are not read, whatever their names.

    Every paragraph with a feature of the model is judged by its score. Where the text is read, an
    upper bound of the score leaves out those that cannot reach the threshold. Templates only confirm:
    a paragraph of one or two words agrees with one that has these words as a run.
    """
    fixed = template_table(docs.sparkSession, templates)
    model = fit_licenses(_examples(docs, fixed, id_col, text_col, sample_docs, sample_lines))
    found = _possible(docs, model, id_col, text_col, threshold)

    features = found.select("row", "paragraph", F.explode(_features(F.col("hashes"))).alias("feature"))
    sums = [F.sum(F.get("weights", F.lit(k))).alias(f"sum{k}") for k in range(len(model.families))]
    raw = F.array(*(F.col(f"sum{k}") + F.lit(x) for k, x in enumerate(model.intercepts)))
    scored = features.join(model.weights, "feature").groupBy("row", "paragraph").agg(*sums)
    chances = scored.select("row", "paragraph", raw.alias("raw")).select("row", "paragraph", _softmax(F.col("raw"), model.temperature).alias("chances"))
    best = F.array_max("chances")
    named = chances.select("row", "paragraph", "chances", best.alias("probability"), F.get(F.lit(list(model.families)), F.array_position("chances", best).cast("int") - 1).alias("family"))
    likely = stored(named.where((F.col("probability") >= threshold) & (F.col("family") != OTHER)).join(found, ["row", "paragraph"]), "license-likely")

    compared = F.array_distinct(_longest_runs(F.col("hashes")))
    own = likely.select("row", "paragraph", F.explode(compared).alias("run"))
    theirs = [fixed.select("family", "template", F.array_distinct(_runs(F.col("hashes"), n)).alias("runs")) for n in (1, 2, 3)]
    theirs = reduce(DataFrame.union, (x.select("family", "template", F.size("runs").alias("size"), F.explode("runs").alias("run")) for x in theirs))
    common = own.join(theirs, "run").groupBy("row", "paragraph", F.col("family").alias("name"), "template", "size").agg(F.count("*").alias("common"))
    shares = common.join(likely.select("row", "paragraph", F.size(compared).alias("own")), ["row", "paragraph"])
    shares = shares.groupBy("row", "paragraph", "name").agg(F.max(F.col("common") / F.least("own", "size")).alias("share"))
    shares = shares.groupBy("row", "paragraph").agg(F.map_from_entries(F.collect_list(F.struct("name", "share"))).alias("shares"))  # families at most
    share = F.coalesce(F.try_element_at("shares", F.col("family")), F.lit(0.0))
    alike = F.array_sort(F.map_keys(F.map_filter("shares", lambda _, other: other >= share)))
    chance = F.aggregate(alike, F.lit(0.0), lambda total, name: total + F.get("chances", F.array_position(F.lit(list(model.families)), name).cast("int") - 1))
    return likely.join(shares, ["row", "paragraph"], "left").select(
        "doc_id",
        "paragraph",
        F.when(share >= agreement, F.array_join(alike, "/")).otherwise(UNKNOWN).alias("family"),
        F.when(share >= agreement, F.least(chance, F.lit(1.0))).otherwise(F.col("probability")).alias("probability"),
        share.alias("agreement"),
    )


def _margin(model: LicenseModel, found: Column) -> Column:
    """More than a paragraph's raw score of any family can exceed that of other text, by its words' hashes.

    Every feature counts with the largest weight that some family has beyond other text. The features
    are in arrays by some bits of their hash; those that meet there are in further arrays.
    """
    rest = [k for k, family in enumerate(model.families) if family != OTHER]
    other = model.families.index(OTHER)
    best = {row.feature: max(row.weights[k] - row.weights[other] for k in rest) for row in model.weights.collect()}
    start = max(model.intercepts[k] - model.intercepts[other] for k in rest)

    def dealt(shift: int) -> list[dict[int, int]]:
        layers: list[dict[int, int]] = []
        for feature in best:
            at = feature >> shift & (PLACES - 1)
            layer = next((x for x in layers if at not in x), None)
            if layer is None:
                layers.append(layer := {})
            layer[at] = feature
        return layers

    shift = min(range(0, 48, 4), key=lambda x: len(dealt(x)))
    tables = []
    for layer in dealt(shift):
        keys = (str(layer.get(at, 0)) for at in range(PLACES))
        values = (repr(best[layer[at]] if at in layer else 0.0) for at in range(PLACES))
        tables.append([F.split(F.lit(",".join(x)), ",").cast(kind) for x, kind in ((keys, "array<bigint>"), (values, "array<double>"))])

    def beyond(feature: Column) -> Column:
        at = F.shiftright(feature, shift).bitwiseAND(PLACES - 1).cast("int")
        out = F.lit(0.0)
        for keys, values in reversed(tables):
            out = F.when(F.get(keys, at) == feature, F.get(values, at)).otherwise(out)
        return out

    return F.aggregate(_features(found), F.lit(start), lambda total, feature: total + beyond(feature))


def _possible(docs: DataFrame, model: LicenseModel, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """Paragraphs whose family may be likelier than the threshold: `row`, `doc_id`, `paragraph`, `hashes`, stored."""
    lines = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("paragraph", "line"),
    )
    # Exploded, so that the hashes are made once and not anew for each feature.
    found = lines.select("row", "doc_id", "paragraph", F.explode(F.array(_hashes(F.col("line")))).alias("hashes"))
    found = found.where(F.size("hashes") > 0)
    if OTHER in model.families and 0 < threshold < 1:
        least = max(0.0, model.temperature * log(threshold / (1 - threshold)))
        found = found.where(_margin(model, F.col("hashes")) >= least - 1e-6)  # sums are not in the scores' order
    return stored(found, "license-paragraphs")
