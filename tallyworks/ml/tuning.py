"""Parameter grids, tuning over one or several model families, and reports about it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.workspace import placed

SEED = 42
TRAIN_RATIO = 0.8
PARALLEL_FITS = 4
FITTED_ROWS = 40_000_000  # rows that the fits at one time hold together; more are fitted on in fewer fits at a time

# The settings tried by the fit job that tunes all families in one grid.
JOINT_GRID = {
    "lr": {"regParam": [0.4], "maxIter": [40], "elasticNetParam": [0.8]},
    "gbt": {"maxDepth": [5, 6, 7], "maxBins": [32, 33], "maxIter": [4, 5, 6, 7]},
    "rf": {
        "maxDepth": [2, 3, 4, 5],
        "numTrees": [19, 20, 21],
        "featureSubsetStrategy": ["onethird", "0.5", "sqrt"],
    },
    "dt": {"maxDepth": [4, 5, 6], "minInfoGain": [0.0, 0.1, 0.2], "maxBins": [28, 32, 33]},
}

# The settings tried by the fit job that tunes each family on its own.
FAMILY_GRID = {
    "dt": {"maxDepth": [2, 5, 10], "maxBins": [10, 20, 40], "minInfoGain": [0.1, 0.3, 0.7]},
    "rf": {"maxDepth": [2, 5, 10], "maxBins": [10, 20, 40], "minInfoGain": [0.1, 0.3, 0.7]},
    "gbt": {"maxDepth": [2, 5, 10], "maxBins": [10, 20, 40], "maxIter": [5, 15]},
}

# The settings tried for the three-class forest.
FOREST_GRID = {
    "impurity": ["entropy", "gini"],
    "maxDepth": [2, 3, 4, 5],
    "numTrees": [3, 6, 9, 12, 15, 18, 21],
}


def regressors(label: str = "ctr") -> dict[str, Estimator]:
    """The four model families with their starting parameters."""
    # The starting parameters.
    return {
        "lr": LinearRegression(labelCol=label, maxIter=40, regParam=0.4, elasticNetParam=0.8),
        "gbt": GBTRegressor(labelCol=label, seed=SEED),
        "rf": RandomForestRegressor(labelCol=label, seed=SEED),
        "dt": DecisionTreeRegressor(labelCol=label, maxDepth=5, seed=SEED),
    }


def grid_of(estimator: Estimator, settings: dict[str, list], base: dict | None = None) -> list[dict]:
    """All combinations of the settings as parameter maps of the estimator."""
    builder = ParamGridBuilder()
    if base:
        builder.baseOn(base)
    for name, values in settings.items():
        builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def joint_grid(pipeline: Pipeline, families: dict[str, Estimator], settings: dict[str, dict]) -> list[dict]:
    """One grid over several families: each map also swaps the last stage of the pipeline."""
    stages = pipeline.getStages()
    grids = [
        grid_of(families[name], chosen, {pipeline.stages: [*stages, families[name]]})
        for name, chosen in settings.items()
    ]
    return [params for grid in grids for params in grid]


def settings_count(estimator: Estimator, settings: dict[str, list]) -> int:
    return len(grid_of(estimator, settings))


FOREST_GRIDS = {"rf": FOREST_GRID}
GRIDS = {"joint": JOINT_GRID, "per family": FAMILY_GRID, "three-class forest": FOREST_GRIDS}


def grid_sizes(rows: DataFrame) -> DataFrame:
    """Settings per grid and family as the grid builder makes them, with the number of labelled rows that each
    of them is fitted on or scored with."""
    estimators, forest = regressors(), {"rf": RandomForestClassifier()}
    sizes = [
        F.struct(
            F.lit(grid).alias("grid"),
            F.lit(family).alias("family"),
            F.lit(settings_count((forest if families is FOREST_GRIDS else estimators)[family], chosen)).alias("settings"),
        )
        for grid, families in GRIDS.items()
        for family, chosen in families.items()
    ]
    counted = rows.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.inline(F.array(*sizes)), "rows")


def rmse(label: str = "ctr") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")


def tune(
    estimator: Estimator,
    grid: list[dict],
    evaluator: Evaluator,
    train: DataFrame,
    keep_models: bool = False,
    keys: list[str] | None = None,
    parallelism: int = PARALLEL_FITS,
) -> TrainValidationSplitModel:
    """Fit every setting on 80 % of the rows, score on the rest, refit the winner on all rows.

    The rows are placed by content first, because the split and the trees depend on where rows are. At most
    `parallelism` settings are fitted at a time, fewer on many rows: each fit keeps its own copy of them.
    """
    rows = placed(train, *(keys or train.columns)).persist()
    at_once = max(1, min(parallelism, FITTED_ROWS // max(1, rows.count())))
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=TRAIN_RATIO,
        parallelism=at_once,
        collectSubModels=keep_models,
        seed=SEED,
    )
    try:
        return search.fit(rows)
    finally:
        rows.unpersist()


def describe_setting(params: dict) -> tuple[str, str]:
    """Model family and its parameters, as text."""
    family, chosen = "", []
    for param, value in params.items():
        if param.name == "stages":
            family = type(value[-1]).__name__
        else:
            chosen.append(f"{param.name}={value}")
    return family, ", ".join(sorted(chosen))


def best_position(model: TrainValidationSplitModel, larger_is_better: bool = False) -> int:
    order = max if larger_is_better else min
    metrics = list(model.validationMetrics)
    return metrics.index(order(metrics))


def tuning_report(spark: SparkSession, model: TrainValidationSplitModel, family: str = "") -> DataFrame:
    """One row per tried setting with its validation metric."""
    rows = []
    for params, metric in zip(model.getEstimatorParamMaps(), model.validationMetrics, strict=True):
        named, chosen = describe_setting(params)
        rows.append((named or family, chosen, float(metric)))
    return spark.createDataFrame(rows, "family string, params string, validation_metric double")


@dataclass
class FamilyResult:
    family: str
    model: PipelineModel
    validation_rmse: float
    test_rmse: float
    params: str = field(default="")


def tune_families(
    train: DataFrame,
    test: DataFrame,
    features: Transformer,
    settings: dict[str, dict],
    label: str = "ctr",
    parallelism: int = PARALLEL_FITS,
) -> list[FamilyResult]:
    """Tune each family on its own; families come in the order of their validation errors."""
    families, evaluator, results = regressors(label), rmse(label), []
    for name, chosen in settings.items():
        estimator = families[name]
        model = tune(Pipeline(stages=[features, estimator]), grid_of(estimator, chosen), evaluator, train, parallelism=parallelism)
        position = best_position(model)
        params = describe_setting(model.getEstimatorParamMaps()[position])[1]
        test_error = evaluator.evaluate(model.bestModel.transform(test))
        results.append(
            FamilyResult(name, model.bestModel, model.validationMetrics[position], test_error, params)
        )
    return sorted(results, key=lambda result: result.validation_rmse)
