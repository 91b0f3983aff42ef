"""Training job, model storage and batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer
from pyspark.ml.tuning import TrainValidationSplitModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.ml.tuning import (
    FAMILY_GRID,
    JOINT_GRID,
    PARALLEL_FITS,
    SEED,
    FamilyResult,
    best_position,
    describe_setting,
    joint_grid,
    regressors,
    rmse,
    tune,
    tune_families,
)
from tallyworks.ml.vectors import assembler, labelled, middle_columns
from tallyworks.operators.splits import hash_split
from tallyworks.plans import passengers
from tallyworks.sources.files import write_csv
from tallyworks.sources.switching import switched
from tallyworks.sources.workspace import new_folder, placed, written

RESULT_SCHEMA = "family string, params string, validation_rmse double, test_rmse double"


def tune_jointly(
    train: DataFrame,
    settings: dict[str, dict] | None = None,
    parallelism: int = PARALLEL_FITS,
    keep_models: bool = False,
):
    """All families in one search; returns the fitted search."""
    pipeline = Pipeline(stages=[assembler(middle_columns(train))])
    grid = joint_grid(pipeline, regressors(), settings or JOINT_GRID)
    return tune(pipeline, grid, rmse(), train, keep_models, parallelism=parallelism)


def save(model: PipelineModel, path: str, replace: bool) -> None:
    """Store the model; an existing path is an error unless it is to be replaced, and holds the old model until the
    new one is complete."""
    with switched(SparkSession.active(), path, replace) as place:
        model.save(place)


def fit_ctr_model(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    model_path: str,
    settings: dict[str, dict] | None = None,
    parallelism: int = PARALLEL_FITS,
    replace: bool = False,
) -> DataFrame:
    """The training job: read, tune all families, store the winner, report both errors."""
    return searched_ctr_model(spark, train_path, test_path, model_path, settings, parallelism, replace)[1]


def searched_ctr_model(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    model_path: str,
    settings: dict[str, dict] | None = None,
    parallelism: int = PARALLEL_FITS,
    replace: bool = False,
    keep_models: bool = False,
) -> tuple[TrainValidationSplitModel, DataFrame]:
    """The training job's search, with the models of all settings if they are to be kept, and its report."""
    train = labelled(spark.read.parquet(train_path))
    test = labelled(spark.read.parquet(test_path))
    model = tune_jointly(train, settings, parallelism, keep_models)
    position = best_position(model)
    family, params = describe_setting(model.getEstimatorParamMaps()[position])
    save(model.bestModel, model_path, replace)
    test_error = rmse().evaluate(model.bestModel.transform(test))
    row = [(family, params, float(model.validationMetrics[position]), float(test_error))]
    return model, spark.createDataFrame(row, RESULT_SCHEMA)


def fit_best_family(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    model_path: str,
    settings: dict[str, dict] | None = None,
    parallelism: int = PARALLEL_FITS,
    replace: bool = False,
    families_path: str | None = None,
    by: str = "test",
) -> list[FamilyResult]:
    """The training job that tunes each family on its own by validation error. The family with the least test error is
    stored (`by` "validation": the least validation error), the best model of each below `families_path` too."""
    train = labelled(spark.read.parquet(train_path))
    test = labelled(spark.read.parquet(test_path))
    features = assembler(middle_columns(train))
    results = tune_families(train, test, features, settings or FAMILY_GRID, parallelism=parallelism)
    results.sort(key=lambda r: getattr(r, f"{by}_rmse"))
    for result in results if families_path else ():
        save(result.model, f"{families_path}/{result.family}", replace)
    save(results[0].model, model_path, replace)
    return results


def family_report(spark: SparkSession, results: list[FamilyResult]) -> DataFrame:
    rows = [(r.family, r.params, float(r.validation_rmse), float(r.test_rmse)) for r in results]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def score_ads(spark: SparkSession, model_path: str, input_path: str, output_path: str, replace: bool = False) -> None:
    """The scoring job: stored model, Parquet in, CSV of ad_id and prediction out, a row for each row."""
    model = PipelineModel.load(model_path)
    try:
        predicted = model.transform(spark.read.parquet(input_path))
    except Exception:
        drop_views_of(model, spark)
        raise
    write_csv(predicted.select("ad_id", "prediction"), output_path, replace=replace)


def drop_views_of(model: PipelineModel, spark: SparkSession) -> None:
    """Drop the temporary views that SQL stages of the model leave when they fail, on rows without one of their columns."""
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            drop_views_of(stage, spark)
        elif isinstance(stage, SQLTransformer):
            for view in spark.catalog.listTables():
                if view.isTemporary and view.name.startswith(f"{stage.uid.lower()}_"):
                    spark.catalog.dropTempView(view.name)


def quick_ctr_model(train: DataFrame, family: str = "dt") -> PipelineModel:
    return Pipeline(stages=[assembler(middle_columns(train)), regressors()[family]]).fit(placed(train))


def scored_ads(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train on the labelled ads, store model and rows, score all ads from the files: what the files hold, and
    what the model in memory says."""
    spark = features.sparkSession
    rows_path, model_path, out = (new_folder(spark, label) for label in ("ads", "model", "scores"))
    features.write.parquet(rows_path)
    model = quick_ctr_model(labelled(spark.read.parquet(rows_path)))
    save(model, model_path, False)
    score_ads(spark, model_path, rows_path, out)
    stored = spark.read.schema("ad_id long, prediction double").csv(out, header=True)
    return stored, model.transform(spark.read.parquet(rows_path)).select("ad_id", "prediction")


def forest_pipeline(passenger_rows: DataFrame) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The four-stage passenger pipeline, fitted on 80 % of the rows; all rows, and those kept for validation."""
    rows = written(passengers.prepared(passenger_rows, keep=("PassengerId",)), "passengers")
    # The inputs of the stored pipeline.
    inputs = ["Pclass", "Age", "SibSp", "Parch", "Fare", "Family_Size", "Embarked_index", "Sex_index"]
    pipeline = Pipeline(
        stages=[
            StringIndexer(inputCol="Sex", outputCol="Sex_index"),
            StringIndexer(inputCol="Embarked", outputCol="Embarked_index"),
            assembler(inputs),
            RandomForestClassifier(labelCol="Survived", seed=SEED),
        ]
    )
    parts = {name: hash_split(rows, "PassengerId", 80).where(F.col("part") == name) for name in ("train", "test")}
    return pipeline.fit(placed(parts["train"])), rows, parts["test"]


def reloaded(model: PipelineModel) -> PipelineModel:
    path = new_folder(SparkSession.active(), "forest")
    save(model, path, False)
    return PipelineModel.load(path)


def held_out_accuracy(passenger_rows: DataFrame) -> DataFrame:
    """The stored and reloaded forest pipeline on the rows it was not trained on: their number, accuracy and error."""
    model, _, validate = forest_pipeline(passenger_rows)
    scored = reloaded(model).transform(validate)
    hits = F.avg((F.col("prediction") == F.col("Survived")).cast("int"))
    return scored.agg(F.count(F.lit(1)).alias("rows"), hits.alias("accuracy"), (1 - hits).alias("error"))


def model_round_trip(passenger_rows: DataFrame) -> DataFrame:
    """Rows for which a stored and reloaded forest pipeline predicts differently than the original."""
    model, rows, _ = forest_pipeline(passenger_rows)
    before = model.transform(rows).select("PassengerId", F.col("prediction").alias("before"))
    after = reloaded(model).transform(rows).select("PassengerId", F.col("prediction").alias("after"))
    return before.join(after, "PassengerId").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differences"),
    )
