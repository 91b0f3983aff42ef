"""Fits on the wrong labels, moved centres and swapped winners turn the checks of the model queries red."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyworks import registry
from tallyworks.ml import checks, models, ranking, replay, scoring, tuning, vectors
from tallyworks.sources import tables
from tallyworks.sources.workspace import new_folder, placed, written


def shuffled(rows, label):
    """The rows with their labels dealt anew."""
    nth = lambda order: F.row_number().over(Window.orderBy(order))
    keys = rows.withColumn("_row", nth(F.rand(1))).drop(label)
    labels = rows.select(label, nth(F.rand(2)).alias("_row"))
    return written(keys.join(labels, "_row").select(*rows.columns), "shuffled")


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    train, test = registry.ctr_parts(spark, sf_dir)
    return written(train, "train"), test


@pytest.mark.parametrize("family", ["rf", "gbt"])
def test_a_regression_on_shuffled_labels_is_seen(parts, family):
    train, test = parts
    inputs = vectors.middle_columns(train)
    right = models.ctr_model(train, family, inputs)
    assert models.ctr_faults(right, train, test, family).first().asDict() == {
        "rows": train.count() + test.count(), "wrong_sums": 0, "wrong_nodes": 0,
    }
    wrong = models.ctr_model(shuffled(train, "ctr"), family, inputs)
    row = models.ctr_faults(wrong, train, test, family).first()
    assert row.wrong_sums == 0 and row.wrong_nodes > 0


@pytest.fixture(scope="module")
def passenger_parts(spark, sf_dir):
    rows = models.survival_rows(tables.passengers(spark, sf_dir))
    train, test = models.split_rows(rows)
    return written(train, "people"), test, [c for c in rows.columns if c not in (models.KEY, "Survived")]


@pytest.mark.parametrize("name", ["forest", "boosted", "tree", "logistic"])
def test_a_classifier_on_shuffled_labels_is_seen(passenger_parts, name):
    train, test, inputs = passenger_parts
    fit = lambda rows: Pipeline(stages=[vectors.assembler(inputs), models.survival_classifiers()[name]]).fit(placed(rows, models.KEY))
    assert models.survival_faults(fit(train), train, test, inputs, name).first().wrong_parts == 0
    assert models.survival_faults(fit(shuffled(train, "Survived")), train, test, inputs, name).first().wrong_parts > 0


def test_a_forest_of_three_classes_on_shuffled_labels_is_seen(spark, sf_dir):
    fitted, train, _ = models.port_models(tables.passengers(spark, sf_dir))
    assert replay.forest_faults(fitted["forest"], train, "type", 3) == 0
    forest = models.RandomForestClassifier(labelCol="type", numTrees=10, seed=models.SEED)
    wrong = forest.fit(placed(shuffled(train, "type"), models.KEY))
    assert replay.forest_faults(wrong, train, "type", 3) > 0


def test_a_changed_node_is_seen(parts):
    train, _ = parts
    inputs = vectors.middle_columns(train)
    nodes = replay.stored_nodes(models.ctr_model(train, "rf", inputs).stages[-1])[0]
    assert replay.wrong_nodes(nodes, 0) == 0 and replay.leaf_ways(nodes)[0][0] == 0
    inner = next(n for n in nodes.values() if n.left >= 0)
    inner.gain += 0.01
    assert replay.wrong_nodes(nodes, 0) == 1


def test_stages_of_a_model_with_another_step_are_seen(parts):
    """The replay reads the weights of the trees, so a model whose trees were fitted with other ones does not fit."""
    train, _ = parts
    learned = vectors.assembler(vectors.middle_columns(train)).transform(placed(train)).select("features", "ctr")
    fitted = models.regressors()["gbt"].copy().setMaxIter(4).setStepSize(0.5).fit(learned)
    assert replay.wrong_stages(fitted, learned, "ctr") == 0
    other = learned.withColumn("ctr", F.col("ctr") + F.when(F.col("ctr") > 0.5, 0.01).otherwise(0.0))
    assert replay.wrong_stages(fitted, other, "ctr") > 0


def test_moved_centres_with_rightly_assigned_rows_are_seen(spark, sf_dir):
    model, clustered = models.cluster_model(tables.stored(spark, sf_dir, "embeddings"))
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    row = models.cluster_faults(clustered, centres, True).first()
    assert (row.misplaced, row.moved_centres, row.costly) == (0, 0, False)
    moved = [[x * 0.9 + 0.01 for x in centres[0]], *centres[1:]]
    own = F.array(*(checks.distance(vector_to_array("features"), c) for c in moved))
    nearest = F.array_position(own, F.array_min(own)) - 1
    row = models.cluster_faults(clustered.withColumn("prediction", nearest), moved, True).first()
    assert row.misplaced == 0 and row.moved_centres > 0
    far = [[x + 3.0 * (i == k) for i, x in enumerate(c)] for k, c in enumerate(centres)]
    assert models.cluster_faults(clustered, far, True).first().costly


def test_clusters_of_one_repeated_vector(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], "vec_id long, embedding array<double>, label int")
    model, clustered = models.cluster_model(rows)
    row = models.cluster_faults(clustered, [list(map(float, c)) for c in model.clusterCenters()], True).first()
    assert (row.misplaced, row.moved_centres, row.costly) == (0, 0, False)


def test_other_weights_than_those_of_the_first_step_are_seen(spark):
    embeddings = tables.stored(spark, "/root/testdata/sf0.01", "embeddings")
    model, train, _ = models.embedding_model(embeddings, (0, 1))
    weights, intercept = list(map(float, model.coefficients)), float(model.intercept)
    wrong = lambda w, b: checks.wrong_first_step(train, "label", w, b, *models.WEAK_STEP)
    assert wrong(weights, intercept) == 0
    largest = max(range(len(weights)), key=lambda i: abs(weights[i]))
    assert wrong([w * (1.001 if i == largest else 1) for i, w in enumerate(weights)], intercept) > 0
    assert wrong([w * 1.5 for w in weights], intercept) > 0 and wrong(weights, intercept + 0.01) > 0
    more_steps = models.LogisticRegression(maxIter=2, regParam=0.05, elasticNetParam=0.3).fit(train)
    assert wrong(list(map(float, more_steps.coefficients)), float(more_steps.intercept)) > 0


SETTINGS = {"dt": {"maxDepth": [2, 4]}, "lr": {"regParam": [0.4]}, "gbt": {"maxIter": [2]}}


def test_a_swapped_winner_is_seen(spark, sf_dir):
    paths, folder, winner = registry.ctr_files(spark, sf_dir), new_folder(spark, "families"), new_folder(spark, "winner")
    results = scoring.fit_best_family(spark, paths["train"], paths["test"], winner, SETTINGS, families_path=folder)
    train, test = (vectors.labelled(spark.read.parquet(paths[name])) for name in ("train", "test"))
    assert [r.test_rmse for r in results] == sorted(r.test_rmse for r in results)
    rows = registry.family_faults(results, folder, winner, train, test).collect()
    assert [(r.family, r.wrong_rmse, r.wrong_fit, r.wrong_winner) for r in rows] == [(r.family, False, 0, False) for r in results]
    scoring.save(results[-1].model, winner, True)
    rows = registry.family_faults(results, folder, winner, train, test).collect()
    assert all(r.wrong_winner for r in rows) and not any(r.wrong_rmse for r in rows)
    by_validation = scoring.fit_best_family(
        spark, paths["train"], paths["test"], new_folder(spark, "winner"), SETTINGS, by="validation"
    )
    assert [r.validation_rmse for r in by_validation] == sorted(r.validation_rmse for r in by_validation)


def test_the_training_jobs_winner_and_fit_are_checked(spark, sf_dir):
    paths, stored = registry.ctr_files(spark, sf_dir), new_folder(spark, "job")
    search, report = scoring.searched_ctr_model(spark, paths["train"], paths["test"], stored, SETTINGS, keep_models=True)
    train, test = (vectors.labelled(spark.read.parquet(paths[name])) for name in ("train", "test"))
    row = registry.job_faults(search, report, stored, train, test).first()
    assert (row.wrong_rmse, row.wrong_fit, row.wrong_winner) == (False, 0, False)
    settings = ranking.search_report(search, train, "ctr")
    worst = settings.orderBy(F.desc("recomputed")).first()
    told = report.withColumns({"family": F.lit(worst.family), "params": F.lit(worst.params)})
    assert registry.job_faults(search, told, stored, train, test).first().wrong_winner
    inputs = vectors.middle_columns(train)
    scoring.save(models.ctr_model(shuffled(train, "ctr"), "gbt", inputs), stored, True)
    row = registry.job_faults(search, report, stored, train, test).first()
    assert row.wrong_rmse and row.wrong_fit > 0


def test_the_report_ranks_all_settings_and_recomputes_their_metrics(spark, parts):
    train, _ = parts
    search = scoring.tune_jointly(train, SETTINGS, keep_models=True)
    report = ranking.search_report(search, train, "ctr")
    rows = report.orderBy("metric_rank").collect()
    assert [r.metric_rank for r in rows] == [1, 2, 3, 4] and {r.family_rank for r in rows} == {1, 2}
    assert [r.validation_metric for r in rows] == sorted(search.validationMetrics)
    by_hand = [tuning.rmse().evaluate(m.transform(ranking.validation_rows(train))) for m in search.subModels]
    assert [r.recomputed for r in sorted(rows, key=lambda r: r.setting)] == pytest.approx(by_hand)
    faults = lambda df: [(r.wrong_metric, r.wrong_rank) for r in ranking.report_faults(df).collect()]
    assert faults(report) == [(False, False)] * 4
    assert faults(report.withColumn("validation_metric", F.col("validation_metric") * 1.01)) == [(True, False)] * 4
    assert any(rank for _, rank in faults(report.withColumn("metric_rank", 5 - F.col("metric_rank"))))


def test_compared_families_on_shuffled_labels_are_seen(parts):
    train, test = parts
    inputs = vectors.middle_columns(train)
    wrong, right = shuffled(train, "ctr"), placed(train)
    rows = models.compare_check(train, test, inputs).collect()
    assert {r.model: (r.wrong_rmse, r.wrong_fit) for r in rows} == dict.fromkeys(("lr", "gbt", "rf", "dt"), (False, 0))
    features = vectors.assembler(inputs)
    learned, true = (features.transform(placed(df)).select("features", "ctr") for df in (wrong, right))
    for name in ("gbt", "rf", "dt"):  # the penalty of the line leaves no weight on either labels
        assert ranking.fit_faults(models.regressors()[name].fit(learned), true, "ctr") > 0
