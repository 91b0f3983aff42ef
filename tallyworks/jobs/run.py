"""Jobs over the user's own files.

    python -m tallyworks.jobs.run features  ADS_PARQUET TARGET [--grain ad|event|event-two-tables] [--replace]
    python -m tallyworks.jobs.run fit       TRAIN_PARQUET TEST_PARQUET MODEL [--search joint|per-family]
                                            [--grid JSON] [--parallelism N] [--replace]
    python -m tallyworks.jobs.run score     MODEL ADS_PARQUET CSV_OUT [--replace]
    python -m tallyworks.jobs.run clean     PASSENGERS_CSV CSV_OUT [--replace]
    python -m tallyworks.jobs.run words     TEXT_DIR TEXT_OUT

`features` writes TARGET/part=train and TARGET/part=test. A target that exists is an error without --replace. A
grid is a JSON object of families, parameters and lists of values, as in {"dt": {"maxDepth": [2, 5]}}.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyworks.ml import scoring
from tallyworks.ml.tuning import PARALLEL_FITS
from tallyworks.operators.words import word_count
from tallyworks.plans import ad_features, passengers
from tallyworks.sources.files import read_csv_text, write_csv

GRAINS = {
    "ad": ad_features.ad_features,
    "event": ad_features.event_features,
    "event-two-tables": ad_features.event_features_two_tables,
}


def features(spark: SparkSession, source: str, target: str, grain: str = "ad", replace: bool = False) -> None:
    """Feature rows of ad events, split into `target/part=train` and `target/part=test`."""
    ad_features.build_training_files(GRAINS[grain](spark.read.parquet(source)), target, replace)


def fit(
    spark: SparkSession,
    train: str,
    test: str,
    model: str,
    search: str = "joint",
    grid: dict[str, dict] | None = None,
    parallelism: int = PARALLEL_FITS,
    replace: bool = False,
) -> None:
    given = (spark, train, test, model, grid, parallelism, replace)
    if search == "joint":
        report = scoring.fit_ctr_model(*given)
    else:
        report = scoring.family_report(spark, scoring.fit_best_family(*given))
    report.show(truncate=False)


def score(spark: SparkSession, model: str, source: str, target: str, replace: bool = False) -> None:
    scoring.score_ads(spark, model, source, target, replace)


def clean(spark: SparkSession, source: str, target: str, replace: bool = False) -> None:
    write_csv(passengers.clean(passengers.typed(read_csv_text(spark, source))), target, replace=replace)


def words(spark: SparkSession, source: str, target: str) -> None:
    """Tab-separated word and count, one text file per partition."""
    counted = word_count(spark.read.text(source), "value")
    counted.select(F.concat_ws("\t", "word", F.col("n").cast("string"))).write.text(target)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyworks")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, paths in {
        "features": ["source", "target"],
        "fit": ["train", "test", "model"],
        "score": ["model", "source", "target"],
        "clean": ["source", "target"],
        "words": ["source", "target"],
    }.items():
        job = jobs.add_parser(name)
        for path in paths:
            job.add_argument(path)
        if name == "features":
            job.add_argument("--grain", choices=list(GRAINS), default="ad")
        if name == "fit":
            job.add_argument("--search", choices=["joint", "per-family"], default="joint")
            job.add_argument("--grid", type=json.loads)
            job.add_argument("--parallelism", type=int, default=PARALLEL_FITS)
        if name != "words":
            job.add_argument("--replace", action="store_true")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = vars(parser().parse_args(argv))
    job = {"features": features, "fit": fit, "score": score, "clean": clean, "words": words}[options.pop("job")]
    spark = spark or SparkSession.builder.appName("tallyworks").getOrCreate()
    job(spark, **options)


if __name__ == "__main__":
    main()
