"""Alert classification from a rule table."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class AlertRule(NamedTuple):
    """Readings of `type` whose value compares true with `threshold` get `level`."""

    type: str
    op: str
    threshold: float
    level: str


# Alert rules in priority order, and the level of everything they do not match.
DEFAULT_RULES = (
    AlertRule("temperature", ">", 28.0, "HIGH"),
    AlertRule("co2", ">", 1000.0, "HIGH"),
    AlertRule("humidity", "<", 30.0, "MEDIUM"),
    AlertRule("humidity", ">", 70.0, "MEDIUM"),
)
DEFAULT_LEVEL = "LOW"

COMPARISONS = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}


def matches(rule: AlertRule, type_column: str, value_column: str) -> Column:
    return (F.col(type_column) == rule.type) & COMPARISONS[rule.op](F.col(value_column), F.lit(float(rule.threshold)))


def alert_level(
    rules: Sequence[AlertRule] = DEFAULT_RULES,
    default: str = DEFAULT_LEVEL,
    type_column: str = "type",
    value_column: str = "value",
) -> Column:
    """The level of the first rule that matches.

    The rules become one expression in the plan, so classification costs no join and no shuffle.
    """
    level = None
    for rule in rules:
        condition = matches(rule, type_column, value_column)
        level = F.when(condition, rule.level) if level is None else level.when(condition, rule.level)
    return F.lit(default) if level is None else level.otherwise(default)
