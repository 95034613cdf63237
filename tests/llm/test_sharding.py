from __future__ import annotations

import zlib
from collections import Counter
from hashlib import md5

from sensorflow.llm.sharding import SEED, interleave

from .conftest import AWKWARD, prose


def brute(rows, shards):
    """Shard and slot by id: rank within the source, then the fractional rank over all."""
    ranks, sizes = [], Counter(s for _, s in rows)
    for source in sizes:
        own = sorted((i for i, s in rows if s == source), key=lambda i: (md5(f"{SEED}:{i}".encode()).hexdigest(), i))
        ranks += [((2 * k + 1) / (2.0 * sizes[source]), source, i) for k, i in enumerate(own)]
    ranks.sort()
    place = {i: p * shards // len(rows) for p, (_, _, i) in enumerate(ranks)}
    slots, seen = {}, Counter()
    for _, _, i in ranks:
        slots[i] = seen[place[i]]
        seen[place[i]] += 1
    return {i: (place[i], slots[i]) for i, _ in rows}


def test_shards_equal_brute_force(spark, rng):
    sources = ["big"] * 300 + [f"s{rng.randrange(8)}" for _ in range(200)] + ["rare"]
    rows = [(i, prose(rng, 3), s) for i, s in enumerate(sources)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = brute([(i, s) for i, _, s in rows], 24)
    for parts in (1, 7):  # the same however the table is split
        found = interleave(frame.repartition(parts)).collect()
        assert {r.doc_id: (r.shard, r.slot) for r in found} == want
    texts = {i: t for i, t, _ in rows}
    for r in found:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id].encode()), "rows", None)
    counts = Counter(r.shard for r in found)
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    by_source = Counter((sources[r.doc_id], r.shard) for r in found)
    big = [by_source["big", s] for s in range(24)]
    assert all(abs(n - 300 / 24) < 2 for n in big)


def test_awkward_rows(spark, awkward):
    found = interleave(awkward, shards=3).collect()
    assert len(found) == len(AWKWARD)
    counts = Counter(r.shard for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(counts[shard]))
    assert {(r.size, r.text_crc32) for r in found if r.doc_id == 1} == {(8, 0)}
    assert interleave(awkward.limit(0)).count() == 0
    few = interleave(awkward, shards=24).collect()  # more shards than rows: none has two
    assert sorted(Counter(r.shard for r in few).values()) == [1] * len(AWKWARD)
