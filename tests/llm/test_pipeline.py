from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sensorflow.llm.quality import quality_scores
from sensorflow.llm.simhash import simhash

from .conftest import prose
from .test_decontaminate import brute as overlapping
from .test_pii import brute as personal
from .test_simhash import groups


def corpus(spark, rng, folder):
    items = [(k, prose(rng, 25)) for k in range(4)]
    docs, labels = [], []
    for i in range(240):
        text = prose(rng, rng.randint(40, 160))
        if i % 6 == 0:
            text = " ".join(w + "$$$" for w in text.split())
        elif i % 10 == 1 and i > 20:
            text = docs[i - 20][1] + (" again" if i % 20 == 1 else "")
        elif i % 15 == 2:
            text += " " + items[i % 4][1] + " " + prose(rng, 9)
        elif i % 9 == 4:
            text += f" write to ann{i}@site.org or 10.1.2.{i} now"
        docs.append((i, text, "en", f"s{i % 5}", len(text)))
        labels.append((i, int(i % 6 > 0), 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_every_stage_equals_brute_force(spark, rng, tmp_path):
    docs, items = corpus(spark, rng, tmp_path)
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")
    tables, frame = [], read("documents")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        frame.write.parquet(f"{tmp_path}/stage{len(tables)}.parquet")
        frame = read(f"stage{len(tables)}")
        tables.append(frame)
    good, single, clean, safe, tokens = tables
    assert all(t.columns == read("documents").columns for t in tables[:-1])

    texts = {i: t for i, t, *_ in docs}
    scores = {r.doc_id: r.predicted for r in quality_scores(read("documents"), read("labels")).collect()}
    kept = sorted(r.doc_id for r in good.collect())
    assert kept == sorted(i for i in texts if scores[i]) and len(kept) > 190

    heads = groups([simhash(texts[i]) for i in kept], 3)
    first = {h: min(i for i, g in zip(kept, heads) if g == h) for h in heads}
    kept = sorted(set(first.values()))
    assert sorted(r.doc_id for r in single.collect()) == kept and len(kept) < len(heads)

    bad = {i for i, _ in overlapping([(i, texts[i]) for i in kept], items)}
    kept = [i for i in kept if i not in bad]
    assert bad and sorted(r.doc_id for r in clean.collect()) == kept

    changed = 0
    rows = {r.doc_id: r for r in safe.collect()}
    for i in kept:
        want, end = "", 0
        for start, kind, stop in personal(texts[i]):
            want, end = want + texts[i][end:start] + ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")[kind], stop
        assert rows[i].text == want + texts[i][end:] and rows[i].n_chars == len(rows[i].text)
        changed += rows[i].text != texts[i]
    assert len(rows) == len(kept) and changed > 5

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in tokens.collect():
        ids = library.encode(rows[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()

    whole = {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {tuple(r) for r in tokens.collect()} and len(whole) == len(kept)


def test_awkward_rows_pass_through(spark, rng, tmp_path):
    corpus(spark, rng, tmp_path)
    schema = spark.read.parquet(f"{tmp_path}/documents.parquet").schema
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "some words", "en", None, 10), (2, "", "en", "s", 0), (None, None, None, None, None)]
    for frame in (spark.createDataFrame(rows, schema).withColumn("columns", F.lit(1)), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, str(tmp_path))
        assert frame.count() <= 2


def test_the_rest_does_not_need_the_operators():
    from pathlib import Path

    package = Path(corpus_pipeline.__file__).parent / "sensorflow"
    for path in package.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", path.read_text(), re.M), path


def test_work_tables_are_released(spark, tmp_path):
    from pathlib import Path

    from sensorflow.llm.tables import scratch, stored

    def there(frame):
        return Path(frame.inputFiles()[0].removeprefix("file://")).exists()

    before = stored(spark.range(3), "kept")
    with scratch(spark) as release_outer:
        with scratch(spark) as release:
            inner = stored(spark.range(4), "inner")
        outer = stored(spark.range(5), "outer")
        files = [f.inputFiles()[0].removeprefix("file://") for f in (before, inner, outer)]
        release()
        assert [Path(f).exists() for f in files] == [True, False, True] and outer.count() == 5
    release_outer()
    assert [Path(f).exists() for f in files] == [True, False, False] and there(before)
