"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

Patterns find candidate spans of four kinds. Five labelers vote for or against each one, or abstain:
the kind's own rule, its form (a checksum or range where no rule has asked for it, else whether it is
written as usual), a gazetteer, cue words around the span and its borders.
Expectation-maximisation estimates, without labels, how reliable each labeler is for each kind and
how likely every pattern of votes is personal data. Those probabilities train a logistic classifier
over the span's surface, which decides about spans that the kinds' strict rules do not settle. Spans
that pass the rules always stay; the classifier only adds to them.

Everything that touches the documents is built-in column functions. The driver gets counts by votes
and surface, whose number is fixed by the labelers and not by the data.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.5
NEAR = 40  # characters on either side in which cue words count

# The kinds' rules. Quantifiers that can never give a character back are possessive and matches start
# at the border of a run, which finds the same matches in time in proportion to the text.
_LOCAL = r"A-Za-z0-9._%+-"
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Other spellings, which are candidates only.
SPELLINGS = {
    "email": rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]++\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[a-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[a-z0-9-]++)+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{16}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# What a text must have before a pattern is tried on it; of several hints, all.
_HINTS = {
    ("email", True): "@",
    ("email", False): (r"(?i)at\]|at\)|\x20at\x20", r"(?i)dot\]|dot\)|\x20dot\x20"),
    ("card", True): r"[0-9](?:[\x20-]?[0-9]){12}",
}
GAZETTEER = {
    "email": r"(?i)\b(?:com|org|net|edu|gov|info|io|co|uk|de|fr|es|it|nl|at|ch|eu|us|ca|au)$",
    "ip": r"^(?!0|10\.|127\.|2(?:2[4-9]|[3-5][0-9])\.|169\.254\.|192\.168\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6)",
    "phone": r"^\+?(?:1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
}
CUES = {
    "email": r"(?i)e-?mail|contact|write|reply|correo|kontakt|courriel|@",
    "ip": r"(?i)\bip\b|addr|host|server|client|login|from",
    "card": r"(?i)card|visa|master|credit|payment|tarjeta|karte|carte",
    "phone": r"(?i)phone|call|tel|mobile|fax|contact|tel[eé]fono|telefon|t[eé]l[eé]phone",
}
COUNTER_CUES = {
    "email": r"(?i)password|regex|example of",
    "ip": r"(?i)version|section|release|chapter|oid\b",
    "card": r"(?i)order|invoice|isbn|serial|tracking|token|hash|\bid\b",
    "phone": r"(?i)order|invoice|isbn|serial|version|token|\bid\b",
}
LABELERS = ("rule", "form", "gazetteer", "cue", "border")
SURFACE = ("digits", "separators", "before", "after", "cue", "checksum", "listed")
VALUES = 4  # each surface feature is 0 to 3


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((size - place) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column, digits: Column) -> Column:
    """The condition beyond the pattern: what the rules ask of a match."""
    if kind == "ip":
        parts = F.split(match, r"\.")
        return (F.size(parts) == 4) & F.forall(parts, lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
            parts, lambda p: F.concat(F.lit("0"), F.substring(F.ltrim(p, F.lit("0")), 1, 3)).cast("int") <= 255
        )
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _plausible(kind: str, match: Column, digits: Column) -> Column:
    """What the rules do not ask: whether a match is written as such data usually is."""
    n = F.length(digits)
    if kind == "email":
        return F.rlike(match, F.lit(r"^[A-Za-z0-9][^@]{0,63}@.*\.[A-Za-z]{2,24}$")) & ~F.contains(match, F.lit(".."))
    if kind == "ip":
        return ~F.rlike(match, F.lit(r"(?:^|\.)0[0-9]|[0-9]{4}"))
    if kind == "card":
        return n.between(13, 19) & F.rlike(match, F.lit(r"^(?:[0-9]+|[0-9]{4}(?:\x20[0-9]{2,7})+|[0-9]{4}(?:-[0-9]{2,7})+)$"))
    return n.between(9, 14) & ~F.rlike(match, F.lit(r"\([^)]*\(|\)[^(]*\)|[.-]{2}|\x20{2}"))


def _votes_and_surface(kind: str, rule: bool, span: Column) -> list[Column]:
    match, before, after = span["match"], span["before"], span["after"]
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    valid = _flag(_valid(kind, match, digits))
    listed = _flag(F.rlike(digits if kind == "card" else match, F.lit(GAZETTEER[kind])))
    around = F.concat_ws(" ", before, after)
    against, cue = _flag(F.rlike(around, F.lit(COUNTER_CUES[kind]))), _flag(F.rlike(around, F.lit(CUES[kind])))

    def side(character: Column) -> Column:
        return F.when((character == "") | F.rlike(character, F.lit(r"\s")), 0).when(F.rlike(character, F.lit(r"[\p{L}\p{N}_]")), 2).otherwise(1)

    left, right = side(F.right(before, F.lit(1))), side(F.left(after, F.lit(1)))
    one = lambda condition: F.when(condition, 1).otherwise(-1)
    separators = (
        F.when(F.rlike(match, F.lit(r"[()\[\]:]")), 3).when(F.rlike(match, F.lit(r"[\x20-]")), 1).when(F.contains(match, F.lit(".")), 2).otherwise(0)
    )
    return [
        (valid if rule else F.lit(False)).alias("base"),
        F.array(
            one(valid) if rule else F.lit(0),
            one(_flag(_plausible(kind, match, digits))) if rule else one(valid),  # the rule has asked for validity already
            one(listed),
            F.when(against, -1).when(cue, 1).otherwise(0),
            F.when((left == 2) | (right == 2), -1).otherwise(1),
        ).alias("votes"),
        F.array(
            F.when(n == 0, 0).when(n < 10, 1).when(n < 16, 2).otherwise(3),
            separators,
            left,
            right,
            F.when(against, 2).when(cue, 1).otherwise(0),
            F.when(valid, 1).otherwise(0),
            F.when(listed, 1).otherwise(0),
        ).alias("surface"),
    ]


def _pattern(kind: str, rule: bool) -> str:
    return (RULES if rule else SPELLINGS)[kind]


def _cut(text: Column, kind: str, rule: bool) -> list[Column]:
    """A text's matches of a pattern and the pieces around them, under names of their own."""
    pattern = _pattern(kind, rule)
    hints = _HINTS.get((kind, rule), pattern)
    there = reduce(Column.__and__, (F.contains(text, F.lit(h)) if h == "@" else F.rlike(text, F.lit(h)) for h in ([hints] if isinstance(hints, str) else hints)))
    none = F.array().cast("array<string>")
    return [
        F.when(there, F.split(text, pattern, -1)).otherwise(none).alias(f"pieces_{kind}_{rule}"),
        F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias(f"matches_{kind}_{rule}"),
    ]


RUN = 128  # elements of an array that are gone through at once


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running results of `merge` over an array of whole numbers, 0 before them.

    Built in runs: an array that grows by one element at a time is copied with each, so it is only
    let grow to a run's length. `values` should be a stored column, for it is looked at several times.
    """
    runs = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    pieces = F.transform(runs, lambda r: F.slice(values, r * RUN + 1, RUN))
    grow = lambda done, x: F.concat(done, F.array(merge(F.element_at(done, -1), x)))
    totals = F.transform(pieces, lambda piece: F.aggregate(piece, F.lit(0), merge))
    carried = F.aggregate(totals, F.array(F.lit(0)), grow)
    parts = F.zip_with(pieces, F.slice(carried, 1, F.size(pieces)), lambda piece, before: F.slice(F.aggregate(piece, F.array(before), grow), 2, RUN))
    return F.concat(F.array(F.lit(0)), F.flatten(parts))


def _lengths(kind: str, rule: bool) -> Column:
    """How far each match ends behind the one before it."""
    pieces, matches = f"pieces_{kind}_{rule}", f"matches_{kind}_{rule}"
    return F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))


def first_behind(spans: str, place: Column) -> Column:
    """How many of the spans of a column, which are in order and apart, end at or before `place`: where the first one behind it is."""
    steps = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(spans, low + step - 1)["end"] <= place, low + step).otherwise(low))


_SPAN_TYPE = "array<struct<start:int,end:int,kind:int,base:boolean,votes:array<int>,surface:array<int>>>"


def _spans(kind: str, rule: bool) -> Column:
    """Candidates of one pattern: where they are, the labelers' votes and the surface."""
    pieces, ends = F.col(f"pieces_{kind}_{rule}"), F.col(f"ends_{kind}_{rule}")
    raw = F.transform(
        f"matches_{kind}_{rule}",
        lambda m, i: F.struct(
            (F.get(ends, i + 1) - F.length(m)).alias("start"),
            F.get(ends, i + 1).alias("end"),
            m.alias("match"),
            F.right(F.get(pieces, i), F.lit(NEAR)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(NEAR)).alias("after"),
        ),
    )
    return F.transform(
        raw,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"), *_votes_and_surface(kind, rule, s)
        ),
    ).cast(_SPAN_TYPE)


def with_candidates(docs: DataFrame, text: Column, *columns: Column) -> DataFrame:
    """A stored table of `columns` with the candidate spans of `text` in `candidates`; null counts as empty.

    Spellings that overlap with a span of the rules, or repeat a candidate of their kind, are left
    out. Pieces and sums are columns of their own: inside a function over an array they would be made anew for each
    element.
    """
    ways = [(kind, rule) for rule in (True, False) for kind in KINDS]
    names = docs.select(*columns).columns
    found = docs.select(*columns, F.coalesce(text, F.lit("")).alias("__text"))
    found = found.select(*names, *(c for kind, rule in ways for c in _cut(F.col("__text"), kind, rule)))
    found = found.select("*", *(_lengths(kind, rule).alias(f"lengths_{kind}_{rule}") for kind, rule in ways))
    found = found.select("*", *(running(F.col(f"lengths_{kind}_{rule}"), Column.__add__).alias(f"ends_{kind}_{rule}") for kind, rule in ways))
    found = found.select(*names, *(_spans(kind, rule).alias(f"spans_{kind}_{rule}") for kind, rule in ways))
    found = found.select("*", *(F.filter(f"spans_{kind}_True", lambda s: s["base"]).alias(f"base_{kind}") for kind in KINDS))

    def free(own: str, s: Column) -> Column:
        """Whether nothing is there. The matches of one pattern are in order and apart, so one of them at most can be in the way: the first behind the start."""
        same = F.get(f"spans_{own}_True", first_behind(f"spans_{own}_True", s["start"]))
        overlaps = (F.get(f"base_{kind}", first_behind(f"base_{kind}", s["start"]))["start"] < s["end"] for kind in KINDS)
        return ~reduce(Column.__or__, map(_flag, (*overlaps, (same["start"] == s["start"]) & (same["end"] == s["end"]))))

    strict = (F.col(f"spans_{kind}_True") for kind in KINDS)
    loose = (F.filter(f"spans_{kind}_False", (lambda own: lambda s: free(own, s))(kind)) for kind in KINDS)
    return stored(found.select(*names, F.concat(*strict, *loose).alias("candidates")), "pii")


@dataclass(frozen=True)
class SpanModel:
    """Weights by kind, surface feature and value; the last feature is the kind itself."""

    weights: tuple[float, ...]
    reliability: dict[str, dict[str, float]]

    def probability(self, span: Column) -> Column:
        table = F.array(*map(F.lit, self.weights))
        start = span["kind"] * ((len(SURFACE) + 1) * VALUES)
        total = reduce(
            lambda x, y: x + y,
            (F.get(table, start + f * VALUES + F.get(span["surface"], f)) for f in range(len(SURFACE))),
            F.get(table, start + len(SURFACE) * VALUES),
        )
        return 1 / (1 + F.exp(-total))


def estimate(counts: Iterable[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> tuple[dict, dict]:
    """Probability of personal data for every kind and pattern of votes, and the labelers' reliability.

    Labelers are independent given the truth and answer -1, 0 or 1 with unknown probabilities.
    Starts from the majority of votes; each answer is smoothed by one row.
    """
    by_kind = defaultdict(lambda: defaultdict(int))
    for kind, votes, n in counts:
        by_kind[kind][votes] += n
    posterior, reliability = {}, {}
    for kind, patterns in by_kind.items():
        belief = {votes: min(max(0.5 + 0.15 * sum(votes), 0.05), 0.95) for votes in patterns}
        for _ in range(rounds):
            mass = [sum(n * (belief[v] if c else 1 - belief[v]) for v, n in patterns.items()) for c in (0, 1)]
            answers = [
                [
                    {a: (1 + sum(n * (belief[v] if c else 1 - belief[v]) for v, n in patterns.items() if v[j] == a)) / (3 + mass[c]) for a in (-1, 0, 1)}
                    for j in range(len(LABELERS))
                ]
                for c in (0, 1)
            ]
            prior = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            for votes in patterns:
                odds = log(prior / (1 - prior)) + sum(log(answers[1][j][a] / answers[0][j][a]) for j, a in enumerate(votes))
                belief[votes] = 1 / (1 + exp(-max(min(odds, 30), -30)))
        posterior |= {(kind, votes): p for votes, p in belief.items()}
        reliability[KINDS[kind]] = {  # how often an answer is right, where there is one
            name: ((1 - prior) * answers[0][j][-1] + prior * answers[1][j][1]) / ((1 - prior) * (1 - answers[0][j][0]) + prior * (1 - answers[1][j][0]))
            for j, name in enumerate(LABELERS)
        }
    return posterior, reliability


def fit_spans(found: DataFrame, rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> SpanModel:
    """Span classifier from the `candidates` of a table, with no labels but the labelers' votes."""
    counts = (
        found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.surface").agg(F.count("*").alias("n")).collect()
    )
    rows = sorted((r.kind, tuple(r.votes), tuple(r.surface), r.n) for r in counts)
    posterior, reliability = estimate((kind, votes, n) for kind, votes, _, n in rows)
    size = (len(SURFACE) + 1) * VALUES
    weights = [0.0] * (len(KINDS) * size)
    totals = defaultdict(int)
    for kind, _, _, n in rows:
        totals[kind] += n
    for _ in range(rounds):
        gradient = [decay * w for w in weights]
        for kind, votes, surface, n in rows:
            at = [kind * size + f * VALUES + value for f, value in enumerate(surface)] + [kind * size + len(SURFACE) * VALUES]
            p = 1 / (1 + exp(-max(min(sum(weights[i] for i in at), 30), -30)))
            for i in at:
                gradient[i] += n / totals[kind] * (p - posterior[kind, votes])
        weights = [w - rate * g for w, g in zip(weights, gradient)]
    return SpanModel(tuple(weights), reliability)


def accepted(model: SpanModel, threshold: float = ACCEPT) -> Column:
    """Spans (`start`, `kind`, `end`) of the rules and those the classifier adds, in order."""
    chosen = F.filter("candidates", lambda s: s["base"] | (model.probability(s) >= threshold))
    return F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def listed(spans: Column) -> Column:
    """`kind:start:end` of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = ACCEPT) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone`, `base` and `spans`.

    Counts and `base` are of the spans that pass the kinds' rules; `spans` also has those that the
    classifier adds. Both are arrays of `start`, `kind` (its place in `KINDS`) and `end`, in code
    points, the end exclusive.

    A null or empty text has no spans. Repeated rows give equal rows; an empty table gives none;
    other columns are not read, whatever their names.
    """
    found = with_candidates(docs, F.col(text_col), F.col(id_col).alias("doc_id"))
    spans = found.select("doc_id", "candidates", accepted(fit_spans(found), threshold).alias("spans"))
    base = F.filter("candidates", lambda s: s["base"])
    base = F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = spans.select("doc_id", "spans", base.alias("base"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return spans.select("doc_id", *counts, "base", "spans")


def redacted(found: DataFrame, text: Column, spans: Column) -> DataFrame:
    """`found` with `clean`: `text` in which each of the ordered `spans` is replaced by its kind's name in brackets.

    Spans that overlap are replaced together, by the name of the first.
    """
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    found = found.withColumn("__spans", spans)
    # How far the spans up to each one reach: one that begins behind that is the first of a group.
    found = found.withColumn("__ends", F.transform("__spans", lambda s: s["end"]))
    found = found.withColumn("__reach", running(F.col("__ends"), lambda x, y: F.greatest(x, y)))
    found = found.withColumn("__heads", F.filter(F.transform("__spans", lambda s, i: F.when(s["start"] >= F.get("__reach", i), i)), lambda i: i.isNotNull()))

    def group(i: Column, k: Column) -> Column:
        behind = F.coalesce(F.get("__heads", k + 1), F.size("__spans"))
        return F.struct(F.get("__spans", i)["start"].alias("start"), F.get("__spans", i)["kind"].alias("kind"), F.get("__reach", behind).alias("end"))

    found = found.withColumn("__apart", F.transform("__heads", group))

    # A place in a long text is found by going through the text, so it is cut into stretches of some groups first.
    groups = F.size("__apart")
    runs = F.sequence(F.lit(0), F.greatest(F.floor((groups - 1) / RUN), F.lit(0)).cast("int"))

    def begin(r: Column) -> Column:
        return F.coalesce(F.get("__apart", r * RUN - 1)["end"], F.lit(0))

    last = F.floor((groups - 1) / RUN).cast("int")
    stretch = lambda r: F.substring(text, begin(r) + 1, F.when(r < last, begin(r + 1)).otherwise(F.length(text)) - begin(r))
    found = found.withColumn("__stretches", F.transform(runs, stretch))

    def rewritten(piece: Column, r: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get("__apart", r * RUN + i - 1)["end"], F.lit(0))
            return F.concat(F.substring(piece, before - begin(r) + 1, s["start"] - before), F.get(names, s["kind"]))

        rest = F.when(r == last, F.substring(piece, F.get("__apart", groups - 1)["end"] - begin(r) + 1, F.length(piece))).otherwise("")
        return F.concat(F.array_join(F.transform(F.slice("__apart", r * RUN + 1, RUN), part), ""), rest)

    rewritten_text = F.array_join(F.transform("__stretches", rewritten), "")
    return found.withColumn("clean", F.when(F.size("__apart") == 0, text).otherwise(rewritten_text)).drop("__spans", "__ends", "__reach", "__heads", "__apart", "__stretches")


def without_personal_data(
    docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", threshold: float = ACCEPT
) -> DataFrame:
    """`docs`, all columns, with personal data in the text replaced; `length_col`, if any, is the new length."""
    found = with_candidates(docs, F.col(text_col), F.struct("*").alias("row"))
    model = fit_spans(found)
    text = F.col("row").getField(text_col)
    clean = redacted(found, text, accepted(model, threshold))
    changed = {text_col: F.col("clean")} | ({length_col: F.length("clean").cast("long")} if length_col in docs.columns else {})
    return clean.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
