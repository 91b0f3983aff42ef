"""Independent rankings of fitted models: all of them scored again in one pass over the same rows."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.ml.tuning import TrainValidationSplitModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.ml import checks, replay
from tallyworks.ml.tuning import SEED, TRAIN_RATIO, describe_setting
from tallyworks.sources.workspace import placed

REPORT = "setting int, family string, params string, validation_metric double, recomputed double, metric_rank int, family_rank int"


def predicted_together(models: list[PipelineModel], rows: DataFrame, names: list[str]) -> DataFrame:
    """`rows` with one column of predictions a model. The models share their first stage, which makes the features
    once for all; only the last stages differ."""
    scored = models[0].stages[0].transform(rows)
    for model, name in zip(models, names, strict=True):
        scored = model.stages[-1].copy()._set(predictionCol=name).transform(scored)
    return scored


def errors_together(models: list[PipelineModel], rows: DataFrame, label: str) -> list[float]:
    """The root mean squared error of each model, all from one aggregate over one scan."""
    names = [f"_model{i}" for i in range(len(models))]
    scored = predicted_together(models, rows, names)
    error = lambda name: F.sqrt(F.avg(F.pow(F.col(name) - F.col(label), 2))).alias(name)
    found = scored.agg(*map(error, names)).first()
    return [found[name] for name in names]


def validation_rows(train: DataFrame, *keys: str) -> DataFrame:
    """The rows that a search over `train` kept for validation, drawn again as it draws them."""
    return placed(train, *(keys or train.columns)).withColumn("_draw", F.rand(SEED)).where(F.col("_draw") >= TRAIN_RATIO)


def search_report(search: TrainValidationSplitModel, train: DataFrame, label: str) -> DataFrame:
    """A row for every setting of a search with its sub-models: its place, family, parameters, the metric that the
    search reports, the same metric recomputed from the sub-model, and its rank by the reported one, over all and
    in its family (equal metrics share a rank)."""
    recomputed = errors_together(list(search.subModels), validation_rows(train), label)
    told = zip(search.getEstimatorParamMaps(), search.validationMetrics, recomputed, strict=True)
    rows = [(i, *describe_setting(params), float(metric), float(own)) for i, (params, metric, own) in enumerate(told)]
    report = train.sparkSession.createDataFrame(rows, ", ".join(REPORT.split(", ")[:5]))
    by_metric = Window.orderBy("validation_metric")  # as many rows as the search has settings
    in_family = Window.partitionBy("family").orderBy("validation_metric")
    return report.withColumns({"metric_rank": F.rank().over(by_metric), "family_rank": F.rank().over(in_family)})


def report_faults(report: DataFrame) -> DataFrame:
    """Each setting's family and parameters, whether its metric is not that of its sub-model, and whether a rank is
    not one more than the number of settings with a smaller recomputed metric."""
    rows = report.orderBy("setting").collect()  # one a setting
    faults = []
    for row in rows:
        below = lambda others: sum(o["recomputed"] < row["recomputed"] * (1 - 1e-9) for o in others)  # noqa: B023, E731
        within = lambda others: sum(o["recomputed"] <= row["recomputed"] * (1 + 1e-9) for o in others)  # noqa: B023, E731
        family = [o for o in rows if o["family"] == row["family"]]
        wrong_rank = not (
            below(rows) < row["metric_rank"] <= within(rows) and below(family) < row["family_rank"] <= within(family)
        )
        wrong_metric = not checks.close(row["validation_metric"], row["recomputed"], 1e-6)
        faults.append((row["family"], row["params"], wrong_metric, wrong_rank))
    return report.sparkSession.createDataFrame(faults, "family string, params string, wrong_metric boolean, wrong_rank boolean")


def fit_faults(model: Model, vectors: DataFrame, label: str) -> int:
    """What is wrong with a fitted regression of any family over its training rows (features and label)."""
    if isinstance(model, GBTRegressionModel):
        return replay.wrong_stages(model, vectors, label)
    if isinstance(model, RandomForestRegressionModel):
        return replay.forest_faults(model, vectors, label)
    if isinstance(model, DecisionTreeRegressionModel):
        return checks.wrong_leaf_means(model.transform(vectors), label)
    if isinstance(model, LinearRegressionModel):
        rows = vectors.withColumnRenamed(label, "label")
        penalty, mix = model.getOrDefault("regParam"), model.getOrDefault("elasticNetParam")
        return checks.wrong_elastic_net(rows, list(model.coefficients), model.intercept, penalty, mix)
    raise TypeError(f"no check for {type(model).__name__}")


def pipeline_faults(model: PipelineModel, train: DataFrame, label: str) -> int:
    """The same for a pipeline of features and a regression."""
    return fit_faults(model.stages[-1], model.stages[0].transform(train).select("features", label), label)


def wrong_winner(chosen: PipelineModel, others: list[PipelineModel], rows: DataFrame, label: str) -> bool:
    """The chosen model does not predict what the one with the least error over the rows does. All are scored in one
    pass; among equal errors any is right."""
    models = [chosen, *others]
    names = [f"_model{i}" for i in range(len(models))]
    scored = predicted_together(models, rows, names)
    differs = lambda name: F.count_if(checks.apart(F.col(name), F.col(names[0]))).alias(f"{name}_differs")
    error = lambda name: F.sqrt(F.avg(F.pow(F.col(name) - F.col(label), 2))).alias(name)
    found = scored.agg(*map(error, names), *map(differs, names[1:])).first()
    least = min(found[name] for name in names[1:])
    return not any(found[f"{name}_differs"] == 0 and checks.close(found[name], least) for name in names[1:])
