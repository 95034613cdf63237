"""The rule compiler against a formulation that shares no code with it."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorflow.functions.alerts import DEFAULT_RULES, AlertRule, alert_level
from sensorflow.schemas import ALERT_RULE

KINDS = ["temperature", "co2", "humidity", "vibration"]
values = st.one_of(st.none(), st.integers(-3, 3).map(float), st.just(float("nan")))
rules = st.lists(
    st.builds(
        AlertRule,
        st.sampled_from(KINDS),
        st.sampled_from([">", ">=", "<", "<="]),
        st.integers(-2, 2).map(float),
        st.sampled_from(["HIGH", "MEDIUM"]),
    ),
    max_size=5,
)
rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(KINDS)), values), min_size=1, max_size=8)


@given(rules=rules, rows=rows)
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_first_matching_rule_wins_as_in_a_join(spark, rules, rows):
    numbered = [(i, *row) for i, row in enumerate(rows)]
    readings = spark.createDataFrame(numbered, "id int, type string, value double")
    compiled = {row.id: row.level for row in readings.select("id", alert_level(rules).alias("level")).collect()}

    table = spark.createDataFrame([(i, *rule) for i, rule in enumerate(rules)], "priority int, rule_type string, "
                                  "op string, threshold double, level string")
    holds = F.expr(
        "type = rule_type AND CASE op WHEN '>' THEN value > threshold WHEN '>=' THEN value >= threshold "
        "WHEN '<' THEN value < threshold ELSE value <= threshold END"
    )
    first = Window.partitionBy("id").orderBy("priority")
    joined = (
        readings.join(table, holds, "left")
        .withColumn("rank", F.row_number().over(first))
        .filter("rank = 1")
        .select("id", F.coalesce("level", F.lit("LOW")).alias("level"))
    )
    assert compiled == {row.id: row.level for row in joined.collect()}


def test_rule_rows_fit_the_declared_rule_schema(spark):
    table = spark.createDataFrame([tuple(rule) for rule in DEFAULT_RULES], ALERT_RULE)
    assert [AlertRule(*row) for row in table.collect()] == list(DEFAULT_RULES)
