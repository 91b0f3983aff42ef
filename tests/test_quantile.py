from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.operators.quantile import exact_quantile, mean_of, rank_discrete, rank_floor, value_counts


def found(spark, values, p, rule=rank_floor, task_rows=100_000):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    counted = value_counts(frame, "x")
    return spark.range(1).select(exact_quantile(counted, p, rule, task_rows)).first()[0]


def by_floor(values, p):
    ordered = sorted(v for v in values if v is not None)
    return ordered[min(math.floor(p * len(ordered)), len(ordered) - 1)]


def test_the_two_rules_differ_on_even_counts(spark):
    values = [1.0, 2.0, 3.0, 4.0]
    assert found(spark, values, 0.5, rank_floor) == 3.0
    assert found(spark, values, 0.5, rank_discrete) == 2.0


def test_discrete_rule_is_percentile_disc(spark):
    random.seed(3)
    values = [random.choice([0.0, 0.5, 1 / 3, random.random()]) for _ in range(401)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.25, 0.5, 0.95, 1.0):
        expected = frame.agg(F.expr(f"percentile_disc({p}) within group (order by x)")).first()[0]
        assert found(spark, values, p, rank_discrete, task_rows=20) == expected


@pytest.mark.parametrize("task_rows", [1, 7, 1000])
def test_histogram_rounds_do_not_change_the_value(spark, task_rows):
    random.seed(task_rows)
    heavy_tail = [random.paretovariate(0.4) * random.choice([1, -1]) for _ in range(300)]
    values = heavy_tail + [0.5] * 200 + [None] * 5
    for p in (0.0, 0.5, 0.95, 1.0):
        assert found(spark, values, p, task_rows=task_rows) == by_floor(values, p)


def test_extreme_widths_terminate(spark):
    values = [-1e308, 0.0, 5e-324, 1.0, 1e308]
    assert [found(spark, values, p, task_rows=1) for p in (0.0, 0.3, 0.5, 0.9)] == [-1e308, 0.0, 5e-324, 1e308]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.sampled_from([0.0, 0.1, 0.25, 1 / 3, 0.5, 2.0, 7.5]), min_size=1, max_size=40),
    p=st.sampled_from([0.1, 0.5, 0.95]),
)
def test_against_sorting(spark, values, p):
    assert found(spark, values, p, task_rows=2) == by_floor(values, p)


def test_nothing_to_rank(spark):
    assert found(spark, [None, None], 0.5) is None


def test_mean_counts_repeats(spark):
    frame = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (None,)], "x double")
    assert value_counts(frame, "x").agg(mean_of(value_counts(frame, "x"))).first()[0] == 2.0
