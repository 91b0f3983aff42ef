from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyworks import registry
from tallyworks.ml import checks, models, scoring, tuning, vectors
from tallyworks.plans import ads
from tallyworks.sources import tables

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    train, test = registry.ctr_parts(spark, sf_dir)
    return train, test


def test_full_grids(spark):
    families = tuning.regressors()
    joint = {name: tuning.settings_count(families[name], chosen) for name, chosen in tuning.JOINT_GRID.items()}
    assert joint == {"lr": 1, "gbt": 24, "rf": 36, "dt": 27}
    family = {name: tuning.settings_count(families[name], chosen) for name, chosen in tuning.FAMILY_GRID.items()}
    assert family == {"dt": 27, "rf": 27, "gbt": 18}
    assert tuning.settings_count(RandomForestClassifier(), tuning.FOREST_GRID) == 56


def test_joint_grid_swaps_the_last_stage(spark):
    pipeline = Pipeline(stages=[vectors.assembler(["a"])])
    grid = tuning.joint_grid(pipeline, tuning.regressors(), tuning.JOINT_GRID)
    assert len(grid) == 88
    assert {tuning.describe_setting(params)[0] for params in grid} == {
        "LinearRegression", "GBTRegressor", "RandomForestRegressor", "DecisionTreeRegressor",
    }
    assert all(len(params[pipeline.stages]) == 2 for params in grid)


def test_features_leave_out_id_and_label(parts):
    train, _ = parts
    assert vectors.middle_columns(train) == [
        "target_audience_count", "has_video", "is_cpm", "is_cpc", "ad_cost", "day_count",
    ]
    assert train.where("ctr is null").count() == 0


def test_elastic_net_meets_its_optimality_conditions(spark, sf_dir):
    """The gradient of the penalised loss vanishes at the fitted weights (checked with numpy)."""
    items = tables.stored(spark, sf_dir, "lineitem")
    model = models.price_fit(items)
    rows = np.array(models.price_rows(items).collect(), dtype=float)
    x, y = rows[:, :3], rows[:, 3]
    sx, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
    xs, ys = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    weights = np.array(model.coefficients) * sx / sy
    penalty, mix = 0.5 / sy, 0.75
    gradient = xs.T @ (xs @ weights - ys) / len(ys) + penalty * (1 - mix) * weights
    assert np.all(np.abs(gradient) <= penalty * mix + 1e-3)
    assert model.intercept == pytest.approx(y.mean() - np.array(model.coefficients) @ x.mean(axis=0))


def test_tree_predicts_leaf_means(parts):
    train, _ = parts
    inputs = vectors.middle_columns(train)
    model = Pipeline(stages=[vectors.assembler(inputs), tuning.regressors()["dt"]]).fit(train)
    leaves = model.transform(train).groupBy("prediction").agg(F.avg("ctr").alias("mean")).collect()
    assert len(leaves) > 1
    assert all(row.prediction == pytest.approx(row.mean) for row in leaves)


def test_rmse_is_what_it_says(parts):
    train, test = parts
    scored = models.ctr_predictions(train, test, "rf", vectors.middle_columns(train))
    by_hand = scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("ctr"), 2)))).first()[0]
    assert tuning.rmse().evaluate(scored) == pytest.approx(by_hand)


def test_winner_has_the_least_validation_error(spark, parts):
    train, test = parts
    settings = {"dt": {"maxDepth": [2]}, "lr": {"regParam": [0.4]}}
    results = tuning.tune_families(train, test, vectors.assembler(vectors.middle_columns(train)), settings)
    assert [r.validation_rmse for r in results] == sorted(r.validation_rmse for r in results)
    report = scoring.family_report(spark, results)
    assert {r.family for r in report.collect()} == {"dt", "lr"}


def test_report_lists_every_setting(spark, parts):
    train, _ = parts
    grid = {"dt": {"maxDepth": [2, 4]}, "lr": {"maxIter": [40]}}
    report = tuning.tuning_report(spark, scoring.tune_jointly(train, grid)).collect()
    assert [(r.family, r.params) for r in report] == [
        ("DecisionTreeRegressor", "maxDepth=2"),
        ("DecisionTreeRegressor", "maxDepth=4"),
        ("LinearRegression", "maxIter=40"),
    ]


@pytest.mark.parametrize("name", ["logistic", "tree", "forest", "boosted"])
def test_classifiers_report_accuracy_and_error(spark, sf_dir, name):
    row = models.survival_accuracy(tables.passengers(spark, sf_dir), name).first()
    assert row.model == name and row.test_rows > 200
    assert row.accuracy + row.error == pytest.approx(1) and 0.5 < row.accuracy < 1


def bent(scored, by=0.5):
    """Predictions of a broken model."""
    return scored.withColumn("prediction", F.col("prediction") + by)


@pytest.fixture(scope="module")
def regressions(parts):
    train, test = parts
    inputs = vectors.middle_columns(train)
    return {f: (models.ctr_model(train, f, inputs), train, test) for f in ("dt", "rf", "gbt")}


def test_a_broken_regression_is_seen(regressions):
    tree, train, test = regressions["dt"]
    learned, scored = tree.transform(train), tree.transform(test)
    assert (checks.wrong_leaf_means(learned, "ctr"), checks.unknown_values(scored, learned)) == (0, 0)
    assert checks.wrong_leaf_means(bent(learned), "ctr") > 0 and checks.unknown_values(bent(scored), learned) > 0
    for family in ("rf", "gbt"):
        model, _, _ = regressions[family]
        scored = model.transform(test)
        assert checks.wrong_sums(model.stages[-1], scored, family == "rf") == 0
        assert checks.wrong_sums(model.stages[-1], bent(scored), family == "rf") == scored.count()


def test_broken_line_weights_are_seen(spark, sf_dir):
    items = tables.stored(spark, sf_dir, "lineitem")
    *weights, intercept = (w for _, w in models.price_coefficients(items))
    rows = vectors.assembler(models.PRICE_INPUTS).transform(models.price_rows(items))
    wrong = lambda w, b: checks.wrong_elastic_net(rows, w, b, models.PENALTY, models.MIX)
    assert wrong(weights, intercept) == 0
    assert wrong([weights[0] * 1.01, *weights[1:]], intercept) > 0 and wrong(weights, intercept + 1) > 0


@pytest.mark.parametrize("name", ["logistic", "tree", "forest", "boosted"])
def test_a_broken_classifier_is_seen(spark, sf_dir, name):
    people = tables.passengers(spark, sf_dir)
    row = models.survival_check(people, name).first()
    assert (row.wrong_accuracy, row.wrong_parts) == (False, 0) and row.test_rows > 200
    fitted, train, test, inputs = models.survival_model(people, name)
    learned, scored = fitted.transform(train), fitted.transform(test)
    swapped = lambda df: df.withColumn(
        "probability", array_to_vector(F.reverse(vector_to_array("probability")))
    ).withColumn("prediction", 1 - F.col("prediction"))
    if name == "logistic":
        assert checks.wrong_logistic(swapped(learned), "Survived", len(inputs)) > 0
    elif name == "tree":
        assert checks.wrong_leaf_shares(swapped(learned), "Survived", 2) > 0
    elif name == "forest":
        assert checks.wrong_votes(fitted.stages[-1], swapped(scored)) > 0
    else:
        assert checks.wrong_signs(fitted.stages[-1], scored.withColumn("prediction", 1 - F.col("prediction"))) > 0
    row = models.survival_accuracy(people, name).first()
    assert row.accuracy + row.error == pytest.approx(1) and 0.5 < row.accuracy < 1


def test_broken_clusters_are_seen(spark, sf_dir):
    model, clustered = models.cluster_model(tables.stored(spark, sf_dir, "embeddings"))
    centres = [list(c) for c in model.clusterCenters()]
    moved = clustered.withColumn("prediction", F.when(F.col("vec_id") == 0, (F.col("prediction") + 1) % 3).otherwise(F.col("prediction")))
    assert (checks.misplaced(clustered, centres), checks.misplaced(moved, centres)) == (0, 1)
    told = models.silhouette(clustered)
    assert checks.silhouette_of(clustered) == pytest.approx(told, abs=1e-9)
    assert not checks.close(told, checks.silhouette_of(moved), 1e-6)


def test_broken_logits_are_seen(spark, sf_dir):
    model, _, test = models.embedding_model(tables.stored(spark, "/root/testdata/sf0.01", "embeddings"), (0, 1))
    scored, weights = model.transform(test), list(model.coefficients)
    assert checks.wrong_logits(scored, weights, model.intercept) == 0
    assert checks.wrong_logits(scored, weights, model.intercept + 0.1) == scored.count()


def test_a_wrong_choice_is_seen(spark, parts):
    train, _ = parts
    search = scoring.tune_jointly(train, {"dt": {"maxDepth": [2, 4]}, "lr": {"maxIter": [40]}}, keep_models=True)
    metric = lambda scored: checks.rmse_of(scored, "ctr")
    faults = models.search_faults(search, train, train.columns, metric, False)
    assert faults == {"wrong_choice": False, "wrong_metric": False}
    assert models.search_faults(search, train, train.columns, lambda s: metric(s) + 1e-3, False)["wrong_metric"]


def test_missing_predictions_are_seen(spark, sf_dir, monkeypatch):
    features = registry.ctr_rows(spark, sf_dir)
    assert tuple(registry.score_check(features).first()) == (142, 0, 0)
    stored, expected = scoring.scored_ads(features)
    monkeypatch.setattr(scoring, "scored_ads", lambda _: (bent(stored.limit(140)), expected))
    assert tuple(registry.score_check(features).first()) == (142, 2, 142)


def test_errors_of_predictions(spark, sf_dir):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "prediction double, label double")
    assert checks.rmse_of(rows, "label") == pytest.approx((2 / 3) ** 0.5)
    assert checks.r2_of(rows, "label") == pytest.approx(0.0)
    assert checks.accuracy_of(rows, "label") == pytest.approx(1 / 3)


def test_an_estimate_out_of_bounds_is_seen(spark, sf_dir, monkeypatch):
    events = tables.ads_data(spark, sf_dir)
    assert not ads.click_first_ads_check(events).first().outside_bound
    monkeypatch.setattr(ads, "click_first_ads_approx", lambda df: ads.click_first_ads(df).selectExpr("ads * 2 as ads"))
    assert ads.click_first_ads_check(events).first().outside_bound


QUERIES = (
    "models.survival_accuracy(people, 'tree')",
    "models.port_accuracy(people)",
    "models.ctr_predictions(*registry.ctr_parts(spark, sf), 'gbt', INPUTS).orderBy('ad_id')",
)


def test_fits_do_not_depend_on_the_number_of_cores(sf_dir):
    """The same script in two sessions of its own, with several partitions to fit on."""
    script = (
        "import sys; from tallyworks.sources import workspace; workspace.FIT_ROWS = 300; from pyspark.sql import SparkSession; from tallyworks import registry; from tallyworks.ml import models; "
        "from tallyworks.sources import tables; sf = sys.argv[2]; "
        "spark = SparkSession.builder.master(f'local[{sys.argv[1]}]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', sys.argv[1]).getOrCreate(); people = tables.passengers(spark, sf); "
        "INPUTS = ['target_audience_count', 'has_video', 'is_cpm', 'is_cpc', 'ad_cost', 'day_count']; "
        + "; ".join(f"print('RESULT', {q}.collect())" for q in QUERIES)
    )
    outputs = []
    for cores in ("2", "4"):
        run = subprocess.run([sys.executable, "-c", script, cores, sf_dir], capture_output=True, text=True, cwd=ROOT, timeout=600)
        outputs.append([line for line in run.stdout.splitlines() if line.startswith("RESULT")])
    assert len(outputs[0]) == len(QUERIES) and outputs[0] == outputs[1]


def test_accuracy_equals_the_evaluator(spark):
    rows = [(0.0, 0), (1.0, 1), (1.0, 0), (2.0, 2)]
    scored = spark.createDataFrame(rows, "prediction double, label int")
    row = models.scored_row("m", "label", scored).first()
    exact = models.accuracy("label").evaluate(scored.withColumn("label", F.col("label").cast("double")))
    assert (row.test_rows, row.accuracy, row.error) == (4, exact, 1 - exact) == (4, 0.75, 0.25)
