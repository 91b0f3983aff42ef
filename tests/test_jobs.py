"""The command-line jobs, from files to files."""

from __future__ import annotations

import glob
import json

import pytest
from pyspark.errors import AnalysisException

from tallyworks.jobs import run
from tallyworks.sources import tables

SMALL = {"dt": {"maxDepth": [2, 3]}, "lr": {"regParam": [0.4]}}


def test_features_fit_score(spark, sf_dir, tmp_path):
    events, target = str(tmp_path / "ads"), str(tmp_path / "features")
    tables.ads_data(spark, sf_dir).write.parquet(events)
    run.main(["features", events, target], spark)
    paths = [f"{target}/part={part}" for part in ("train", "test")]
    train, test = map(spark.read.parquet, paths)
    assert train.count() + test.count() == 142
    assert train.join(test, "ad_id").count() == 0

    model, scores = str(tmp_path / "model"), str(tmp_path / "scores")
    for search in ("joint", "per-family"):
        options = ["--search", search, "--grid", json.dumps(SMALL), "--parallelism", "2", "--replace"]
        run.main(["fit", *paths, model, *options], spark)
    run.main(["score", model, paths[1], scores], spark)
    scored = spark.read.csv(scores, header=True, inferSchema=True)
    assert scored.columns == ["ad_id", "prediction"]
    assert scored.count() == test.count() and scored.where("prediction is null").count() == 0


@pytest.mark.parametrize(("grain", "count"), [("ad", 142), ("event", 398), ("event-two-tables", 398)])
def test_every_grain_is_fitted_and_scored_whole(spark, sf_dir, tmp_path, grain, count):
    """Ads that were never viewed have missing values; they teach nothing, but each row is scored."""
    events, target = str(tmp_path / "ads"), str(tmp_path / "features")
    tables.ads_data(spark, sf_dir).drop("event_id").write.parquet(events)
    run.main(["features", events, target, "--grain", grain], spark)
    train, test = (spark.read.parquet(f"{target}/part={part}") for part in ("train", "test"))
    assert train.count() + test.count() == count
    assert train.join(test, "ad_id").count() == 0

    model = str(tmp_path / "model")
    run.main(["fit", f"{target}/part=train", f"{target}/part=test", model, "--grid", json.dumps(SMALL)], spark)
    for part, rows in (("train", train), ("test", test)):
        scores = str(tmp_path / f"scores-{part}")
        run.main(["score", model, f"{target}/part={part}", scores], spark)
        scored = spark.read.csv(scores, header=True, inferSchema=True)
        assert scored.count() == rows.count() and scored.where("prediction is null").count() == 0


def test_an_existing_target_survives(spark, sf_dir, tmp_path):
    events, target = str(tmp_path / "ads"), tmp_path / "features"
    tables.ads_data(spark, sf_dir).write.parquet(events)
    target.mkdir()
    (target / "mine.txt").write_text("precious")
    with pytest.raises(AnalysisException):
        run.main(["features", events, str(target)], spark)
    assert (target / "mine.txt").read_text() == "precious"
    run.main(["features", events, str(target), "--replace"], spark)
    assert (target / "part=train").exists() and not (target / "mine.txt").exists()


def test_clean_and_words(spark, sf_dir, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    tables.passengers(spark, sf_dir).write.csv(source, header=True)
    run.main(["clean", source, target], spark)
    cleaned = spark.read.csv(target, header=True, inferSchema=True)
    assert cleaned.count() == 1500 and cleaned.where("Age is null").count() == 0

    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_text("Big Data Big\nScience  Data Data\n")
    run.main(["words", str(tmp_path / "text"), str(tmp_path / "counts")], spark)
    lines = {line for path in glob.glob(str(tmp_path / "counts/part-*")) for line in open(path).read().splitlines()}
    assert lines == {"Big\t2", "Data\t3", "Science\t1"}
