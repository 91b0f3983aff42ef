from __future__ import annotations

import math

from pyspark.ml.evaluation import RegressionEvaluator

from tallyworks.ml import tuning
from tallyworks.sources import files, workspace


def test_partitions_of_a_fit_grow_with_the_root_of_the_rows(spark, monkeypatch):
    assert [workspace.fit_partitions(n) for n in (0, 1, 20_000, 20_001, 640_000)] == [1, 1, 1, 2, 32]
    a, b = (workspace.fit_partitions(n) for n in (8_000_000, 128_000_000))
    assert 32 < a < 400 and math.isclose(b / a, 4, rel_tol=0.05)
    monkeypatch.setattr(workspace, "FIT_ROWS", 10)
    rows = workspace.placed(spark.range(10_240), "id")
    assert rows.rdd.getNumPartitions() == 181
    assert rows.count() == rows.distinct().count() == 10_240


def test_fewer_fits_at_a_time_on_many_rows(spark, monkeypatch):
    made = []

    class Search:
        def __init__(self, **settings):
            made.append(settings["parallelism"])

        def fit(self, rows):
            return rows.count()

    monkeypatch.setattr(tuning, "TrainValidationSplit", Search)
    rows = spark.range(100)
    for limit in (1000, 300, 250, 1):
        monkeypatch.setattr(tuning, "FITTED_ROWS", limit)
        assert tuning.tune(None, [], RegressionEvaluator(), rows) == 100
    assert made == [4, 3, 2, 1]


def odd_values(spark):
    return spark.createDataFrame(
        [
            (1, 1, 0.0, float("nan"), "a", None),
            (1, 2, -0.0, float("nan"), "", None),
            (None, 2, 1.5, None, "a", None),
        ],
        "id long, n int, x double, `y.z` double, t string, none string",
    )


def test_profile_counts_distinct_values_of_every_type(spark):
    found = {r.column_name: (r.position, r["rows"], r.non_null, r.distinct_values) for r in files.column_profile(odd_values(spark)).collect()}
    assert found == {"id": (1, 3, 2, 1), "n": (2, 3, 3, 2), "x": (3, 3, 3, 2), "y.z": (4, 3, 2, 1), "t": (5, 3, 3, 2), "none": (6, 3, 0, 0)}


def test_type_check_leaves_out_distinct_values(spark):
    checked = files.csv_type_check(spark.range(5).selectExpr("id", "cast(id as string) as t", "id / 2D as x"))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Join" not in plan
    assert {(r.column_name, r.read_type, r.non_null) for r in checked.collect()} == {("id", "int", 5), ("t", "int", 5), ("x", "double", 5)}
