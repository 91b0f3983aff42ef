"""Fits and evaluations of single models."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import (
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import TrainValidationSplitModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.ml import checks, ranking, replay
from tallyworks.ml.forests import NestedForestClassifier
from tallyworks.ml.tuning import (
    FOREST_GRID,
    SEED,
    best_position,
    describe_setting,
    grid_of,
    regressors,
    rmse,
    tune,
)
from tallyworks.ml.vectors import assembler, embedding_vectors, labelled_union
from tallyworks.operators.splits import hash_split
from tallyworks.plans import passengers
from tallyworks.sources.workspace import placed, written


# --- linear regression ------------------------------------------------------------------------


def price_rows(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))


def _line_fit(rows: DataFrame, inputs: list[str], estimator: LinearRegression) -> LinearRegressionModel:
    return estimator.fit(assembler(inputs).transform(rows).select("features", "label"))


PRICE_INPUTS = ["l_quantity", "l_discount", "l_tax"]
PENALTY, MIX = 0.5, 0.75  # fixed values: elastic net of the price model


def price_fit(lineitem: DataFrame) -> LinearRegressionModel:
    estimator = LinearRegression(maxIter=20, regParam=PENALTY, elasticNetParam=MIX)
    return _line_fit(price_rows(lineitem), PRICE_INPUTS, estimator)


def price_coefficients(lineitem: DataFrame) -> list[tuple[str, float]]:
    model = price_fit(lineitem)
    return [*((f"f{i}", float(value)) for i, value in enumerate(model.coefficients)), ("intercept", float(model.intercept))]


def price_check(lineitem: DataFrame) -> DataFrame:
    """Conditions of the best elastic net that the fitted weights violate."""
    *weights, intercept = (weight for _, weight in price_coefficients(lineitem))
    rows = assembler(PRICE_INPUTS).transform(price_rows(lineitem)).select("features", "label")
    wrong = checks.wrong_elastic_net(rows, weights, intercept, PENALTY, MIX)
    return one_row(rows, F.count(F.lit(1)).alias("rows"), violations=wrong)


def one_row(rows: DataFrame, *counts: Column, **found) -> DataFrame:
    """One row with aggregates of the rows and values found elsewhere."""
    values = [F.lit(v).cast("boolean" if isinstance(v, bool) else "bigint").alias(k) for k, v in found.items()]
    return rows.agg(*counts).select("*", *values)


def price_summary(lineitem: DataFrame) -> DataFrame:
    """The training summary against the same errors summed up from the predictions."""
    model = price_fit(lineitem)
    scored = model.transform(assembler(PRICE_INPUTS).transform(price_rows(lineitem)))
    summary = model.summary
    return one_row(
        scored,
        F.count(F.lit(1)).alias("rows"),
        summarised=summary.numInstances,
        wrong_rmse=not checks.close(summary.rootMeanSquaredError, checks.rmse_of(scored, "label")),
        wrong_r2=not checks.close(summary.r2, checks.r2_of(scored, "label")),
    )


def price_line(lineitem: DataFrame) -> DataFrame:
    """Unpenalised line through (quantity, price), with its error."""
    model = _line_fit(price_rows(lineitem), ["l_quantity"], LinearRegression(solver="normal"))
    summary = model.summary
    row = [
        (
            round(float(model.coefficients[0]), 4),
            round(float(model.intercept), 4),
            round(summary.rootMeanSquaredError, 3),
            round(summary.r2, 6),
        )
    ]
    schema = "slope double, intercept double, rmse double, r2 double"
    return lineitem.sparkSession.createDataFrame(row, schema)


# --- click-rate regression --------------------------------------------------------------------


def ctr_model(train: DataFrame, family: str, inputs: list[str]) -> PipelineModel:
    return Pipeline(stages=[assembler(inputs), regressors()[family]]).fit(placed(train))


def ctr_predictions(train: DataFrame, test: DataFrame, family: str, inputs: list[str]) -> DataFrame:
    """Predicted click rate per test ad, from one model family."""
    return ctr_model(train, family, inputs).transform(test).select("ad_id", "ctr", "prediction")


def ctr_check(train: DataFrame, test: DataFrame, family: str, inputs: list[str]) -> DataFrame:
    """One family fitted: labelled rows, predictions that are not what its trees say, and nodes of the trees that
    are not what their training rows make of them."""
    return ctr_faults(ctr_model(train, family, inputs), train, test, family)


def ctr_faults(model: PipelineModel, train: DataFrame, test: DataFrame, family: str) -> DataFrame:
    learned, scored = model.transform(train), model.transform(test)
    rows = learned.unionByName(scored)
    count = F.count("prediction").alias("rows")
    if family == "dt":
        wrong = checks.wrong_leaf_means(learned, "ctr")
        return one_row(rows, count, wrong_leaves=wrong, unknown_values=checks.unknown_values(scored, learned))
    trees, vectors = model.stages[-1], learned.drop("prediction")
    nodes = replay.forest_faults(trees, vectors, "ctr") if family == "rf" else replay.wrong_stages(trees, vectors, "ctr")
    return one_row(rows, count, wrong_sums=checks.wrong_sums(trees, rows, mean=family == "rf"), wrong_nodes=nodes)


def compare_regressors(train: DataFrame, test: DataFrame, inputs: list[str]) -> list[tuple[str, float, float, int]]:
    """Test error of each family by the evaluator and by plain sums, and what is wrong with its fit; the vectors are
    assembled once for all."""
    features = assembler(inputs)
    train_vectors = placed(features.transform(placed(train)).select("ad_id", "features", "ctr"), "ad_id").persist()
    test_vectors = features.transform(test).select("features", "ctr").persist()
    rows = []
    for name, estimator in regressors().items():
        model = estimator.fit(train_vectors)
        scored, faults = model.transform(test_vectors), ranking.fit_faults(model, train_vectors.select("features", "ctr"), "ctr")
        rows.append((name, float(rmse().evaluate(scored)), float(checks.rmse_of(scored, "ctr")), faults))
    train_vectors.unpersist()
    test_vectors.unpersist()
    return rows


def compare_check(train: DataFrame, test: DataFrame, inputs: list[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(name).alias("model"),
            F.lit(not checks.close(told, summed)).alias("wrong_rmse"),
            F.lit(faults).cast("bigint").alias("wrong_fit"),
        )
        for name, told, summed, faults in compare_regressors(train, test, inputs)
    ]
    rows = train.unionByName(test).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("rows", F.inline(F.array(*entries)))


# --- metrics of given predictions -------------------------------------------------------------


def rmse_of_prices(lineitem: DataFrame) -> DataFrame:
    """Error of a fixed rule: 1500 per unit of quantity."""
    scored = lineitem.select(
        (F.col("l_quantity") * 1500).alias("prediction"), F.col("l_extendedprice").alias("label")
    )
    error = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse").evaluate(scored)
    return lineitem.sparkSession.createDataFrame([(round(error, 4),)], "rmse double")


def accuracy(label: str) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="accuracy"
    )


def accuracy_of_class_rule(passenger_rows: DataFrame) -> DataFrame:
    """Accuracy of a fixed rule: passengers of the first two classes survive."""
    scored = passenger_rows.select(
        (F.col("Pclass") <= 2).cast("double").alias("prediction"), F.col("Survived").cast("double").alias("Survived")
    )
    share = accuracy("Survived").evaluate(scored)
    row = [(round(share, 9), round(1 - share, 9))]
    return passenger_rows.sparkSession.createDataFrame(row, "accuracy double, error double")


# --- classification ---------------------------------------------------------------------------


def survival_classifiers() -> dict[str, Estimator]:
    return {
        "logistic": LogisticRegression(labelCol="Survived"),
        "tree": DecisionTreeClassifier(labelCol="Survived", seed=SEED),
        "forest": RandomForestClassifier(labelCol="Survived", seed=SEED),
        "boosted": GBTClassifier(labelCol="Survived", maxIter=10, seed=SEED),
    }


KEY = "PassengerId"


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """80 % to train on and 20 % to test with, by the passenger's number; placed by it too."""
    parts = hash_split(rows, KEY, 80)
    train, test = (parts.where(F.col("part") == name).drop("part") for name in ("train", "test"))
    return placed(train, KEY), test


def survival_rows(passenger_rows: DataFrame) -> DataFrame:
    """Assembled passenger features, stored once so that split and fit read files."""
    ready = passengers.with_category_index(passengers.prepared(passenger_rows, keep=(KEY,))).drop(*passengers.INDEXED)
    return written(ready, "passengers")


def scored_row(name: str, label: str, scored: DataFrame) -> DataFrame:
    """Test rows, accuracy and error of one set of predictions, in one pass."""
    hits = F.avg((F.col("prediction") == F.col(label)).cast("int"))
    return scored.agg(
        F.lit(name).alias("model"),
        F.count(F.lit(1)).alias("test_rows"),
        hits.alias("accuracy"),
        (1 - hits).alias("error"),
    )


def survival_model(passenger_rows: DataFrame, name: str) -> tuple[PipelineModel, DataFrame, DataFrame, list[str]]:
    """A fitted classifier, its training and test rows, and its inputs."""
    rows = survival_rows(passenger_rows)
    train, test = split_rows(rows)
    inputs = [c for c in rows.columns if c not in (KEY, "Survived")]
    return Pipeline(stages=[assembler(inputs), survival_classifiers()[name]]).fit(train), train, test, inputs


def survival_accuracy(passenger_rows: DataFrame, name: str) -> DataFrame:
    """Accuracy and error of one classifier on the 20 % it was not trained on."""
    model, _, test, _ = survival_model(passenger_rows, name)
    return scored_row(name, "Survived", model.transform(test))


def survival_check(passenger_rows: DataFrame, name: str) -> DataFrame:
    """One classifier fitted: test rows, whether the evaluator's accuracy is that of its predictions, and what is
    wrong with the model: slopes of the loss, leaves, votes of the trees or signs of their sum, and their nodes."""
    return survival_faults(*survival_model(passenger_rows, name), name)


def survival_faults(fitted: PipelineModel, train: DataFrame, test: DataFrame, inputs: list[str], name: str) -> DataFrame:
    model, learned, scored = fitted.stages[-1], fitted.transform(train), fitted.transform(test)
    vectors = learned.select("features", "Survived")
    wrong = {
        "logistic": lambda: checks.wrong_logistic(learned, "Survived", len(inputs)),
        "tree": lambda: checks.wrong_leaf_shares(learned, "Survived", 2),
        "forest": lambda: checks.wrong_votes(model, scored) + replay.forest_faults(model, vectors, "Survived", 2),
        "boosted": lambda: checks.wrong_signs(model, scored) + replay.wrong_stages(model, vectors, "Survived", True),
    }[name]()
    told = accuracy("Survived").evaluate(scored.withColumn("Survived", F.col("Survived").cast("double")))
    return one_row(
        scored,
        F.lit(name).alias("model"),
        F.count(F.lit(1)).alias("test_rows"),
        wrong_accuracy=not checks.close(told, checks.accuracy_of(scored, "Survived")),
        wrong_parts=wrong,
    )


def port_rows(passenger_rows: DataFrame) -> DataFrame:
    """Numeric passenger columns with the text target Embarked last, after the passenger's number."""
    ready = passengers.prepared(passenger_rows, keep=(KEY,))
    return ready.select(KEY, "Pclass", "Age", "SibSp", "Parch", "Fare", "Family_Size", "Alone", "Embarked")


def port_vectors(passenger_rows: DataFrame) -> DataFrame:
    """All columns between the first and the last as features, the last one indexed as `type`."""
    rows = written(port_rows(passenger_rows), "ports")
    stages = [assembler(rows.columns[1:-1]), StringIndexer(inputCol=rows.columns[-1], outputCol="type")]
    return Pipeline(stages=stages).fit(rows).transform(rows).select(KEY, "features", "type")


def port_models(passenger_rows: DataFrame) -> tuple[dict[str, Model], DataFrame, DataFrame]:
    """Tree and ten-tree forest on the three-valued target, with their training and test rows."""
    train, test = split_rows(written(port_vectors(passenger_rows), "port-vectors"))
    estimators = {
        "tree": DecisionTreeClassifier(labelCol="type", seed=SEED),
        "forest": RandomForestClassifier(labelCol="type", numTrees=10, seed=SEED),
    }
    return {name: estimator.fit(train) for name, estimator in estimators.items()}, train, test


def port_accuracy(passenger_rows: DataFrame) -> DataFrame:
    """Accuracy of both, each scored on its own predictions."""
    models, _, test = port_models(passenger_rows)
    reports = [scored_row(name, "type", model.transform(test)) for name, model in models.items()]
    return reports[0].unionByName(reports[1])


def port_check(passenger_rows: DataFrame) -> DataFrame:
    models, train, test = port_models(passenger_rows)
    wrong = {
        "tree": checks.wrong_leaf_shares(models["tree"].transform(train), "type", 3),
        "forest": checks.wrong_votes(models["forest"], models["forest"].transform(test))
        + replay.forest_faults(models["forest"], train, "type", 3),
    }
    reports = []
    for name, model in models.items():
        scored = model.transform(test)
        off = not checks.close(accuracy("type").evaluate(scored), checks.accuracy_of(scored, "type"))
        counts = (F.lit(name).alias("model"), F.count(F.lit(1)).alias("test_rows"))
        reports.append(one_row(scored, *counts, wrong_accuracy=off, wrong_parts=wrong[name]))
    return reports[0].unionByName(reports[1])


def tune_port_forest(passenger_rows: DataFrame, settings: dict[str, list] | None = None):
    """The fitted search for the best forest for the three-valued target, by validation accuracy, and its rows."""
    train, _ = split_rows(written(port_vectors(passenger_rows), "port-vectors"))
    forest = NestedForestClassifier(labelCol="type", numTrees=10, seed=SEED)
    grid = grid_of(forest, settings or FOREST_GRID)
    return tune(forest, grid, accuracy("type"), train, keep_models=True, keys=[KEY]), train


def best_port_forest(passenger_rows: DataFrame, settings: dict[str, list] | None = None) -> DataFrame:
    model, train = tune_port_forest(passenger_rows, settings)
    position, best = best_position(model, larger_is_better=True), model.bestModel
    row = [
        (
            best.getNumTrees,
            best.getOrDefault("maxDepth"),
            best.getOrDefault("impurity"),
            describe_setting(model.getEstimatorParamMaps()[position])[1],
            float(model.validationMetrics[position]),
            len(model.subModels),
        )
    ]
    schema = "num_trees int, max_depth int, impurity string, params string, accuracy double, models int"
    return train.sparkSession.createDataFrame(row, schema)


def search_faults(model: TrainValidationSplitModel, train: DataFrame, keys: list[str], metric, larger: bool) -> dict[str, bool]:
    """What is wrong with a search: a setting better than the chosen one, or a metric of the chosen one that is not
    that of its sub-model on the rows kept for validation, which are drawn here again."""
    metrics = list(model.validationMetrics)
    position = best_position(model, larger)
    better = any(m > metrics[position] if larger else m < metrics[position] for m in metrics)
    faults = {"wrong_choice": better}
    if model.subModels:
        scored = model.subModels[position].transform(ranking.validation_rows(train, *keys))
        faults["wrong_metric"] = not checks.close(metric(scored), metrics[position], 1e-6)
    return faults


def port_search_check(passenger_rows: DataFrame, settings: dict[str, list] | None = None) -> DataFrame:
    model, train = tune_port_forest(passenger_rows, settings)
    faults = search_faults(model, train, [KEY], lambda scored: checks.accuracy_of(scored, "type"), True)
    return one_row(train, F.count(F.lit(1)).alias("rows"), settings=len(model.validationMetrics), **faults)


# --- clustering and vectors that come ready-made ----------------------------------------------


def cluster_model(embeddings: DataFrame, k: int = 3, seed: int = 1) -> tuple[KMeansModel, DataFrame]:
    vectors = embedding_vectors(embeddings)
    model = KMeans(k=k, seed=seed).fit(placed(embeddings, "vec_id").transform(embedding_vectors))
    return model, model.transform(vectors)


def cluster_assignment(embeddings: DataFrame) -> DataFrame:
    return cluster_model(embeddings)[1].select("vec_id", F.col("prediction").alias("cluster"))


def cluster_check(embeddings: DataFrame) -> DataFrame:
    """Rows, clusters that have some, rows that are not at their nearest centre, centres that are not the means of
    their rows, and whether the cost is not below that of the start from as many rows drawn by hash."""
    model, clustered = cluster_model(embeddings)
    centres = [list(c) for c in model.clusterCenters()]
    return cluster_faults(clustered, centres, model.summary.numIter < model.getMaxIter())


def cluster_faults(clustered: DataFrame, centres: list[list[float]], converged: bool) -> DataFrame:
    counts = (F.count(F.lit(1)).alias("rows"), F.count_distinct("prediction").alias("clusters"))
    return one_row(
        clustered,
        *counts,
        misplaced=checks.misplaced(clustered, centres),
        moved_centres=checks.moved_centres(clustered, centres, converged),
        costly=checks.costs_more_than_drawn(clustered, centres, "vec_id"),
    )


def silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(clustered)


def silhouette_check(embeddings: DataFrame) -> DataFrame:
    _, clustered = cluster_model(embeddings)
    off = not checks.close(silhouette(clustered), checks.silhouette_of(clustered), 1e-6)
    return one_row(clustered, F.count(F.lit(1)).alias("rows"), wrong_silhouette=off)


# The penalty of the weak step, and the part of it that is on absolute weights.
WEAK_STEP = (0.05, 0.3)


def embedding_model(embeddings: DataFrame, kinds: tuple[int, ...]) -> tuple[Model, DataFrame, DataFrame]:
    """Two classes of stored feature vectors, one weak logistic step on 70 %; the model, these and the other 30 %."""
    rows = written(labelled_union(embeddings, kinds).withColumnRenamed("kind", "label"), "pair")
    parts = hash_split(rows, "vec_id", 70)
    train, test = (parts.where(F.col("part") == name).drop("part") for name in ("train", "test"))
    penalty, mix = WEAK_STEP
    estimator = LogisticRegression(maxIter=1, regParam=penalty, elasticNetParam=mix)
    learned = placed(train, "vec_id").transform(embedding_vectors)
    return estimator.fit(learned), learned, embedding_vectors(test)


def embedding_classifier(embeddings: DataFrame, kinds: tuple[int, ...] = (0, 1)) -> DataFrame:
    model, _, test = embedding_model(embeddings, kinds)
    return scored_row("logistic", "label", model.transform(test))


def embedding_check(embeddings: DataFrame, kinds: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Test rows, those whose probability or prediction is not what the weights say, and weights that are not where
    one step of the optimiser leads from the start."""
    model, train, test = embedding_model(embeddings, kinds)
    scored, weights = model.transform(test), list(model.coefficients)
    wrong = checks.wrong_logits(scored, weights, model.intercept)
    steps = checks.wrong_first_step(train, "label", weights, model.intercept, *WEAK_STEP)
    return one_row(scored, F.count(F.lit(1)).alias("test_rows"), wrong_predictions=wrong, wrong_step=steps)
