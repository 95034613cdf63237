"""Chat formatting with minimum-cost repair of roles.

A legal chat is an optional system turn, then user and assistant in turn, ending with the assistant.
Dynamic programming over that automaton finds the cheapest way to make any sequence of turns legal:
a turn keeps its role, takes another, or is merged into the turn before it, and empty turns may be
inserted. The repaired sequence is then rendered with the tags of a chat template.

A step of the automaton is a small table of costs from state to state, and steps combine: the cost
of a stretch of turns is again such a table. So a conversation is cut into blocks of turns whose
tables are made everywhere at once; what is handled in one place is one table per block.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import numbered, stored, width

BLOCK, SMALLEST_BLOCK = 4096, 256  # turns handled together
ROLES = ("system", "user", "assistant", "other")
ALIASES = {
    "human": "user", "prompter": "user", "customer": "user",
    "bot": "assistant", "gpt": "assistant", "ai": "assistant", "model": "assistant",
    "developer": "system",
}
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_ROLE_OF = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
ACTIONS = ("keep", "merge", "relabel")


@dataclass(frozen=True)
class Costs:
    merge: int = 2
    relabel: int = 5
    name: int = 1  # give a role to a turn whose role is unknown
    insert: int = 3


@dataclass(frozen=True)
class Step:
    cost: float
    state: int  # the turn's role after the step
    action: str = ""
    inserted: int = START  # the empty turn before it, if any


@lru_cache(maxsize=None)
def steps(costs: Costs) -> list[list[list[Step]]]:
    """The cheapest step for each role of a turn, state before and state after it; ties go by the order here."""

    def cheapest(role: int, before: int, after: int) -> Step:
        same = ROLES[role] == _ROLE_OF.get(after)
        change = 0 if same else costs.name if ROLES[role] == "other" else costs.relabel
        label = "keep" if same else "relabel"
        ways = []
        if after in NEXT[before]:
            ways.append(Step(change, after, label))
        if after == before != START:
            ways.append(Step(costs.merge + change, after, "merge"))
        ways += [Step(costs.insert + change, after, label, between) for between in NEXT[before] if between != SYSTEM and after in NEXT[between]]
        return min(ways, key=lambda step: step.cost, default=Step(inf, after))

    return [[[cheapest(role, before, after) for after in range(4)] for before in range(4)] for role in range(len(ROLES))]


def closing(costs: Costs) -> list[float]:
    """What it costs to end in each state: the empty turns that lead to the assistant's."""
    return [2 * costs.insert, 2 * costs.insert, costs.insert, 0]


_APPENDED = {START: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def stretch(roles: np.ndarray, costs: Costs) -> np.ndarray:
    """Table of the least cost from each state to each state over a stretch of turns."""
    tables = np.array([[[step.cost for step in row] for row in rows] for rows in steps(costs)])
    total = np.where(np.eye(4) == 1, 0.0, inf)
    for role in roles:
        total = (total[:, :, None] + tables[role][None, :, :]).min(axis=1)
    return total


def repair(roles: np.ndarray, costs: Costs, begin: int = START, end: int | None = None) -> list[Step]:
    """The cheapest steps of a stretch from state `begin` to `end`, or to the cheapest ending if that is None."""
    table = steps(costs)
    reached, back = [0.0 if state == begin else inf for state in range(4)], []
    for role in roles:
        ways = [[reached[before] + table[role][before][after].cost for before in range(4)] for after in range(4)]
        back.append([min(range(4), key=way.__getitem__) for way in ways])
        reached = [way[before] for way, before in zip(ways, back[-1])]
    last = closing(costs)
    state = min(range(4), key=lambda s: reached[s] + last[s]) if end is None else end
    chosen = []
    for role, before in zip(roles[::-1], back[::-1]):
        chosen.append(table[role][before[state]][state])
        state = before[state]
    return chosen[::-1]


def carried(tables: list[np.ndarray], costs: Costs) -> list[int]:
    """States between a conversation's stretches on its cheapest way: before the first, ..., after the last."""
    reached, back = np.where(np.arange(4) == START, 0.0, inf), []
    for table in tables:
        ways = reached[:, None] + table
        back.append(ways.argmin(axis=0))
        reached = ways.min(axis=0)
    states = [int((reached + closing(costs)).argmin())]
    for before in back[::-1]:
        states.append(int(before[states[-1]]))
    return states[::-1]


def _segments(block: pd.DataFrame) -> list[pd.DataFrame]:
    """A block's turns by conversation, in order."""
    block = block.sort_values("place", kind="stable")
    number = block["conversation"].to_numpy()
    cuts = np.flatnonzero(number[1:] != number[:-1]) + 1
    return [block.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, len(block)])]


def role_code(role: Column) -> Column:
    """Place in `ROLES` of a role's name, after trimming, lower-casing and aliases."""
    name = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    known = F.create_map(*(F.lit(x) for alias, name in {**{r: r for r in ROLES[:3]}, **ALIASES}.items() for x in (alias, ROLES.index(name))))
    return F.coalesce(F.element_at(known, name), F.lit(ROLES.index("other")))


def format_chats(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs = Costs(),
    block: int | None = None,
) -> DataFrame:
    """One row per row of `turns`: its place in the repaired chat and its part of the rendered text.

    Columns: `conv_id`, `turn`, `place` (from 0 in its conversation), `role` (after the repair),
    `action` (`keep`, `relabel`, or `merge` into the turn before), `inserted` and `appended` (roles
    of the empty turns before it and, at the end of a conversation, after it, comma-joined) and
    `rendered`. A conversation's chat is its `rendered` parts joined in order of `place`; they are
    not joined here, since one conversation may be a large share of all rows. Tags inside a text are
    escaped (`escaped`), so the joined chat has the repaired turns and no others.

    Turns are worked on in blocks of `block` turns, of conversations or stretches of one; the result
    does not depend on it. Without `block` there are a few for each task.

    Turns are ordered by their number, nulls first, then by role and text, so repeated rows follow one another and
    are merged. A null text is empty. A null or unknown role is `other` and costs little to name. A
    null conversation id is an id like any other. An empty table gives no rows; other columns are not
    read, whatever their names.
    """
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role_code(F.col(role_col)).alias("code"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumns({"mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col(c) for c in ("conv_id", "turn", "code", "mark", "row")]
    ordered = stored(numbered(rows, order, "place", "chat").drop("mark", "row"), "chat-ordered")
    tasks = width(turns.sparkSession)
    if block is None:
        block = min(BLOCK, max(SMALLEST_BLOCK, ceil(ordered.count() / (4 * tasks))))
    bounds = ordered.groupBy("conv_id").agg(F.min("place").alias("conversation"), F.max("place").alias("last"))
    bounds = stored(bounds, "chat-bounds")
    # A conversation is known by its first place.
    same = ordered["conv_id"].eqNullSafe(bounds["conv_id"])
    known = stored(
        ordered.join(bounds, same).select("place", "conversation", "last", "code", F.expr(f"place div {block}").alias("block")), "chat-codes"
    )
    split = known.where(F.expr(f"conversation div {block} != last div {block}"))

    def tables(piece: pd.DataFrame) -> pd.DataFrame:
        found = [(s["conversation"].iloc[0], s["block"].iloc[0], stretch(s["code"].to_numpy(), costs).ravel().tolist()) for s in _segments(piece)]
        return pd.DataFrame(found, columns=["conversation", "block", "costs"])

    def states(stretches: pd.DataFrame) -> pd.DataFrame:
        stretches = stretches.sort_values("block")
        found = carried([np.reshape(c, (4, 4)) for c in stretches["costs"]], costs)
        return pd.DataFrame(
            {"conversation": stretches["conversation"], "block": stretches["block"], "begin": found[:-1], "end": [*found[1:-1], -1]}
        )

    # Two stretches of a block at most belong to conversations that go on beyond it.
    between = (
        split.groupBy("block")
        .applyInPandas(tables, "conversation long, block long, costs array<double>")
        .groupBy("conversation")
        .applyInPandas(states, "conversation long, block long, begin int, end int")
    )
    between = stored(between, "chat-states")

    def repaired(key: tuple, piece: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        at = {conversation: (begin, end) for conversation, begin, end in zip(edges["conversation"], edges["begin"], edges["end"])}
        out = []
        for segment in _segments(piece):
            begin, end = at.get(segment["conversation"].iloc[0], (START, -1))
            chosen = repair(segment["code"].to_numpy(), costs, begin, None if end < 0 else end)
            for (place, conversation, last), step in zip(segment[["place", "conversation", "last"]].itertuples(index=False), chosen):
                appended = ",".join(_ROLE_OF[s] for s in _APPENDED[step.state]) if place == last else ""
                inserted = _ROLE_OF[step.inserted] if step.inserted else ""
                out.append((place, place - conversation, place == last, _ROLE_OF[step.state], step.action, inserted, appended))
        return pd.DataFrame(out, columns=["key", "place", "last", "role", "action", "inserted", "appended"])

    # The rows are narrow and Python's share is the cost, so the number of tasks is not left to their size.
    decided = (
        known.repartition(tasks, "block")
        .groupBy("block")
        .cogroup(between.repartition(tasks, "block").groupBy("block"))
        .applyInPandas(repaired, "key long, place long, last boolean, role string, action string, inserted string, appended string")
    )
    texts = ordered.select(F.col("place").alias("key"), "conv_id", "turn", "text")
    return texts.join(decided, "key").select("conv_id", "turn", "place", "role", "action", "inserted", "appended", rendered().alias("rendered"))


def rendered(opening: str = "<|im_start|>", closing_tag: str = "<|im_end|>") -> Column:
    """A repaired turn's part of the chat's text: the tags that come before it, its text, and at the end the last tags."""

    def empty(roles: Column) -> Column:
        made = F.transform(F.filter(F.split(roles, ","), lambda r: r != ""), lambda r: F.concat(F.lit(opening), r, F.lit(f"\n{closing_tag}\n")))
        return F.array_join(made, "")

    before = F.when(F.col("action") == "merge", "\n").otherwise(
        F.concat(F.when(F.col("place") > 0, f"{closing_tag}\n").otherwise(""), empty(F.col("inserted")), F.lit(opening), F.col("role"), F.lit("\n"))
    )
    after = F.when(F.col("last"), F.concat(F.lit(f"{closing_tag}\n"), empty(F.col("appended")))).otherwise("")
    return F.concat(before, escaped(F.col("text"), opening, closing_tag), after)


def escaped(text: Column, *tags: str) -> Column:
    """Text in which no tag stands: a backslash goes behind the tag's first character, one more where some are there."""
    for tag in tags:
        text = F.regexp_replace(text, re.escape(tag[0]) + r"(\\*)" + re.escape(tag[1:]), _literal(tag[0]) + r"\\$1" + _literal(tag[1:]))
    return text


def unescaped(text: Column, *tags: str) -> Column:
    """What `escaped` was given."""
    for tag in tags:
        text = F.regexp_replace(text, re.escape(tag[0]) + r"\\(\\*)" + re.escape(tag[1:]), _literal(tag[0]) + "$1" + _literal(tag[1:]))
    return text


def _literal(text: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", text)


def joined_chats(formatted: DataFrame) -> DataFrame:
    """`conv_id` and `chat`, the whole rendered text, for conversations that fit into a row."""
    parts = F.array_sort(F.collect_list(F.struct("place", "rendered")))
    return formatted.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["rendered"]), "").alias("chat"))
