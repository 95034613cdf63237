from __future__ import annotations

import re
import time
from itertools import accumulate

from pyspark.sql import functions as F

from sensorflow.llm.pii import KINDS, LABELERS, estimate, fit_spans, listed, luhn, personal_data, redacted, running, with_candidates, without_personal_data

from .conftest import AWKWARD, prose

RULES = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def checks(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 14 <= len(digits) <= 19 and checks(digits))
                or (kind == 3 and 10 <= len(digits) <= 15)
            ):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


PIECES = [
    "a@b.c", "@", ".", "+", "1", "12", "255", "256", "4111111111111111", "4111 1111 1111 1111", "-", " ", "(", ")", "x", "é", "\n", "1.2.3.4",
    "+1 (017) 555-7713", "%", "d@e-f.g", "0", "007", "joe at mail dot com", "\U0001f600", "5500-0000-0000-0004",
]


def test_rules_equal_brute_force(spark, rng):
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(800)]
    texts += ["a" * 30_000, "1" * 30_000, "+1" + "(" * 20_000, "1.2.3.4 " * 200, "a@b.c+d@e.f", "1.2.3.4.5.6.7.8", "1.2.3.0255", "1.2.3.99999999999999999999"]
    found = personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in found:
        base = [tuple(s) for s in r.base]
        assert base == brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(base) <= {tuple(s) for s in r.spans}
        assert [tuple(s) for s in r.spans] == sorted(tuple(s) for s in r.spans)


def test_labels_are_weighed_and_spans_added(spark, rng):
    rows = []
    for i in range(300):
        base = ["mail ann{0}@site.org now", "server 10{0}.20.30.40 up", "phone +49 (171) 555-{0:04d} today", "paid 4111111111111111 now", "item 12345678123456{0:02d} sold"][i % 5]
        rows.append((i, prose(rng, 8) + " " + base.format(i % 50) + " " + prose(rng, 8)))
    rows.append((900, "one 4111111111111111 5500000000000004 two"))  # one run of digits to the rule, two cards
    rows.append((901, "item 1234567812345678 is no card"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in personal_data(frame).collect()}
    assert found[900].n_card == 0 and [tuple(s) for s in found[900].spans] == [(4, 2, 20), (21, 2, 37)]
    assert not found[901].spans
    candidates = [c for r in with_candidates(frame, F.col("text"), F.col("doc_id")).collect() for c in r.candidates]
    assert any(c.votes[0] * c.votes[1] == -1 for c in candidates)  # the rule and the form are not one vote
    model = fit_spans(with_candidates(frame, F.col("text"), F.col("doc_id")))
    assert model.reliability["card"]["rule"] > 0.8


def test_estimation_finds_the_unreliable_labeler(rng):
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = []
        for right in (0.95, 0.9, 0.9, 0.5, 0.85):
            votes.append(1 if (rng.random() < right) == truth else -1)
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    belief, reliability = estimate([(0, votes, n) for votes, n in counts.items()])
    for name, right in zip(LABELERS, (0.95, 0.9, 0.9, 0.5, 0.85)):
        assert abs(reliability["email"][name] - right) < 0.05
    assert belief[0, (1, 1, 1, -1, 1)] > 0.95 and belief[0, (-1, -1, -1, 1, -1)] < 0.05


def test_luhn(spark, rng):
    digits = ["".join(rng.choices("0123456789", k=rng.randint(1, 19))) for _ in range(200)]
    found = spark.createDataFrame([(d,) for d in digits], "d string").select("d", luhn(F.col("d")).alias("ok")).collect()
    assert all(r.ok == checks(r.d) for r in found)


def test_text_is_rewritten(spark):
    frame = spark.createDataFrame([("é ab cdef gh", [(2, 0, 4), (3, 1, 7), (10, 2, 12)]), ("x", [])], "text string, s array<struct<start:int,kind:int,end:int>>")
    found = redacted(frame, F.col("text"), F.col("s")).select("clean").collect()
    assert [r.clean for r in found] == ["é [EMAIL]ef [CARD]", "x"]
    docs = spark.createDataFrame([(1, "to a@b.cd or +1 (222) 333-4444.", 31, "k"), (2, None, None, None), (3, "none", 4, "k")], "doc_id long, text string, n_chars long, clean string")
    kept = {r.doc_id: r for r in without_personal_data(docs).collect()}
    assert kept[1].text == "to [EMAIL] or [PHONE]." and kept[1].n_chars == len(kept[1].text) and kept[1].clean == "k"
    assert kept[2].text is None and kept[3].text == "none" and kept[3].n_chars == 4


def test_awkward_rows(spark, awkward):
    found = personal_data(awkward).collect()
    assert len(found) == len(AWKWARD) and all(not r.spans and not r.base for r in found)
    assert personal_data(awkward.limit(0)).count() == 0
    kept = without_personal_data(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
    assert sorted(map(str, (r.text for r in kept.select("text").collect()))) == sorted(map(str, (t for _, t, _ in AWKWARD)))
    text = spark.createDataFrame([(1, "a@b.c 1.2.3.4")], "doc_id long, text string")
    assert personal_data(text).select(listed(F.col("base")).alias("b")).first().b == "email:0:5,ip:6:13"
    assert KINDS == ("email", "ip", "card", "phone")


def test_local_numbers_are_candidates_beside_a_card(spark):
    far = " and then some more plain words that stand in between here "
    texts = [f"call {number} today" + far + rest for number in ("555-123-4567", "555 123 4567", "(555) 123-4567") for rest in ("", "4111 1111 1111 1111", "1234567890123")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.candidates for r in with_candidates(docs, F.col("text"), F.col("doc_id")).collect()}
    phones = [[(s.start, s.end) for s in found[i] if s.kind == KINDS.index("phone")] for i in range(9)]
    assert phones == [[(5, 17)]] * 6 + [[(5, 19)]] * 3
    assert all(len({(s.start, s.kind, s.end) for s in spans}) == len(spans) for spans in found.values())
    spans = {r.doc_id: [tuple(s) for s in r.spans if s.kind == KINDS.index("phone")] for r in personal_data(docs).collect()}
    assert all(spans[i] == spans[i + 1] == spans[i + 2] for i in (0, 3, 6))


def test_running_results_equal_a_loop(spark, rng):
    lists = [[rng.randint(0, 99) for _ in range(n)] for n in (0, 1, 2, 127, 128, 129, 256, 700)]
    frame = spark.createDataFrame([(v,) for v in lists], "v array<int>")
    found = frame.select("v", running(F.col("v"), lambda x, y: x + y).alias("sums"), running(F.col("v"), lambda x, y: F.greatest(x, y)).alias("most")).collect()
    for row in found:
        assert row.sums == [0, *accumulate(row.v)] and row.most == [0, *accumulate(row.v, max)]


def test_many_matches_in_one_text(spark):
    """Addresses, spelled-out ones and numbers by the ten thousand: time in proportion, and all of them found."""
    seconds = []
    for n in (200, 16_000, 32_000):
        text = "".join(f"mail u{i}@site.org or x{i} at host dot com, +49 171 {i:07d}, 10.1.2.{i % 256}\n" for i in range(n // 4))
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        started = time.monotonic()
        (row,) = personal_data(frame).collect()
        seconds.append(time.monotonic() - started)
        assert (row.n_email, row.n_phone, row.n_ip) == (n // 4,) * 3 and [tuple(s) for s in row.base] == brute(text)
        started = time.monotonic()
        assert "@" not in without_personal_data(frame).first().text
        seconds[-1] += time.monotonic() - started
    assert seconds[2] < 2 * seconds[1] + 3


def test_overlapping_spans_are_replaced_together(spark, rng):
    for _ in range(3):
        spans = sorted((start, rng.randrange(4), start + rng.randint(1, 9)) for start in (rng.randrange(900) for _ in range(150)))
        text = "".join(rng.choices("abc", k=1000))
        frame = spark.createDataFrame([(text, spans)], "text string, s array<struct<start:int,kind:int,end:int>>")
        apart = []
        for start, kind, end in spans:
            if apart and start < apart[-1][2]:
                apart[-1] = (*apart[-1][:2], max(end, apart[-1][2]))
            else:
                apart.append((start, kind, end))
        expected, at = "", 0
        for start, kind, end in apart:
            expected, at = expected + text[at:start] + f"[{KINDS[kind].upper()}]", end
        assert redacted(frame, F.col("text"), F.col("s")).first().clean == expected + text[at:]
