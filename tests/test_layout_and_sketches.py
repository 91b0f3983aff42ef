from __future__ import annotations

import datetime
import re

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tallyworks import registry
from tallyworks.jobs import run as jobs
from tallyworks.ml import scoring, tuning, vectors
from tallyworks.operators.layout import write_layout
from tallyworks.operators.splits import write_split
from tallyworks.plans import ad_features, ads, sketches
from tallyworks.sources import files, tables
from tallyworks.sources.switching import switched
from tallyworks.sources.workspace import new_folder


# --- platform sets ------------------------------------------------------------------------------


def brute_sets(rows):
    seen = {}
    for _, ad, _, event, platform in rows:
        own = seen.setdefault(ad, set())
        if event == "view" and platform is not None:
            own.add(platform)
    found = {}
    for own in seen.values():
        if own:
            key = ",".join(sorted(own))
            found[key] = found.get(key, 0) + 1
    return sorted((k, n, len(seen), n / len(seen) * 100) for k, n in found.items())


def test_platform_sets_of_five_thousand_platforms(spark, make_ads):
    noon = datetime.datetime(2024, 1, 5, 12)
    rows = [(i, i % 40, noon, "view", f"p{i * 7 % 5000:04d}") for i in range(6000)]
    rows += [(7000, 100, noon, "click", "p0001"), (7001, 101, noon, "view", None), (7002, 102, noon, "view", "a,b")]
    found = [tuple(r) for r in ads.platform_sets(make_ads(rows)).collect()]
    assert [r[:3] for r in sorted(found)] == [r[:3] for r in brute_sets(rows)]
    assert [r[3] for r in sorted(found)] == pytest.approx([r[3] for r in brute_sets(rows)])


@pytest.mark.parametrize("platforms", [1, 62, 63, 125])
def test_platform_sets_at_the_edges_of_a_word(spark, make_ads, platforms):
    noon = datetime.datetime(2024, 1, 5, 12)
    rows = [(i, i % 7, noon, "view", f"p{i % platforms:03d}") for i in range(4 * platforms)]
    found = sorted(tuple(r[:3]) for r in ads.platform_sets(make_ads(rows)).collect())
    assert found == [r[:3] for r in brute_sets(rows)]


def test_platform_sets_of_an_empty_table_and_without_views(spark, make_ads):
    assert ads.platform_sets(make_ads([])).collect() == []
    noon = datetime.datetime(2024, 1, 5, 12)
    assert ads.platform_sets(make_ads([(1, 1, noon, "click", "web")])).collect() == []


# --- sketches -----------------------------------------------------------------------------------


def many_events(spark, n=60_000):
    return spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(9000))).alias("ad_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20)).cast("int")).alias("date"),
    )


def test_merged_days_equal_one_sketch_within_the_bound(spark):
    events = many_events(spark)
    row = sketches.merged_days(events).first()
    assert (row.ads, row.outside_bound, row.other_than_whole) == (events.select("ad_id").distinct().count(), False, False)
    assert not any(r.outside_bound for r in sketches.daily_ads(events).collect())
    assert not any(r.outside_bound for r in sketches.trailing_ads(events).collect())


def test_sketches_that_lack_a_day_are_seen(spark, monkeypatch):
    events, store = many_events(spark), sketches.store_days
    monkeypatch.setattr(sketches, "store_days", lambda ads, path: store(ads, path).where("day(date) > 3"))
    assert sketches.trailing_ads(events).where("outside_bound").count() > 0
    assert sketches.merged_days(events.where("day(date) < 6")).first().other_than_whole


def test_days_are_stored_once(spark):
    events, path = many_events(spark, 5000), new_folder(spark, "sketches")
    first = sketches.store_days(events.where("day(date) <= 10"), path).count()
    both = sketches.store_days(events, path)
    assert (first, both.count(), both.select("date").distinct().count()) == (10, 20, 20)
    fresh = sketches.store_days(events, new_folder(spark, "sketches"))
    told = lambda table: table.agg(sketches.estimated()).first()[0]
    assert told(both) == told(fresh)


def test_sketches_of_an_empty_table_and_missing_values(spark):
    none = spark.createDataFrame([], "ad_id long, date date")
    assert tuple(sketches.merged_days(none).first()) == (0, False, False)
    assert sketches.daily_ads(none).collect() == [] and sketches.trailing_ads(none).collect() == []
    day = datetime.date(2024, 1, 1)
    some = spark.createDataFrame([(1, day), (None, day), (2, None)], "ad_id long, date date")
    assert [tuple(r) for r in sketches.daily_ads(some).collect()] == [(day, 1, False)]


# --- bucketed layout ----------------------------------------------------------------------------


def exchanged(plan):
    """What the exchanges of a plan shuffle: the lines of their keys."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_neither_statistics_nor_join_shuffle_events(spark, sf_dir):
    events = tables.ads_data(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        features = ad_features.bucketed_event_features(events)
        plan = features._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount" in plan and "SortMergeJoin" in plan
    # The rows that are joined come from the scan through a sort; exchanges stand above slots' statistics only.
    join = plan[plan.index("SortMergeJoin") :]
    left = join[: join.index("Exchange")]
    assert "FileScan" in left and "Sort" in left and "HashAggregate" not in left
    assert sorted(map(str, features.collect())) == sorted(map(str, ad_features.event_features(events).collect()))


def test_a_hot_key_and_missing_keys_are_spread_over_buckets(spark):
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("key"), F.lit(1).alias("x")
    )
    layout = write_layout(rows, "key", lambda: F.col("id"), 16)
    by_file = layout.table.groupBy(F.input_file_name().alias("f")).count()
    assert by_file.agg(F.max("count")).first()[0] < 3 * 30_000 / 16 and layout.table.count() == 30_000
    per_key = layout.statistics([F.sum("x").alias("n"), F.max("id").alias("m")], [F.sum("n").alias("n"), F.max("m").alias("m")])
    joined = layout.join_back(per_key)
    assert joined.count() == 30_000 and joined.where("key = 7").select("n", "m").distinct().collect() == [(10_001, 29_997)]  # and the row 7
    assert joined.where("key is null and n is null").count() == 10_000 and joined.where("key % 3 = 1 and key != 7 and n = 1").count() == 9_999


def test_a_layout_of_an_empty_table(spark):
    layout = write_layout(spark.createDataFrame([], "key long, id long"), "key", lambda: F.col("id"), 4)
    assert layout.join_back(layout.statistics([F.count("id").alias("n")], [F.sum("n").alias("n")])).collect() == []


# --- sinks --------------------------------------------------------------------------------------


class Broken(Exception):
    pass


def failing(rows):
    """Rows of which some are written before the job fails."""
    return rows.withColumn("bad", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")))


def listing(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place.getParent())
    return sorted(f.getPath().getName() for f in found)


def test_a_failing_csv_job_leaves_the_old_target(spark, tmp_path):
    target = str(tmp_path / "out")
    files.write_csv(spark.range(3), target)
    with pytest.raises(Exception, match="broken"):
        files.write_csv(failing(spark.range(10)), target, replace=True)
    assert spark.read.csv(target, header=True).count() == 3 and listing(spark, target) == ["out"]
    files.write_csv(spark.range(5), target, replace=True)
    assert spark.read.csv(target, header=True).count() == 5 and listing(spark, target) == ["out"]
    with pytest.raises(Exception, match="exist"):
        files.write_csv(spark.range(1), target)


def test_a_failing_split_leaves_the_old_parts(spark, tmp_path):
    target, shares = str(tmp_path / "parts"), {"train": 0.75, "test": 0.25}
    write_split(spark.range(100), target, shares, 1, "id")
    with pytest.raises(Exception, match="broken"):
        write_split(failing(spark.range(10)), target, shares, 1, "id", replace=True)
    assert spark.read.parquet(target).count() == 100 and listing(spark, target) == ["parts"]
    # The new data may be made from the old ones.
    write_split(spark.read.parquet(target).drop("part").where("id < 40"), target, shares, 1, "id", replace=True)
    assert spark.read.parquet(target).count() == 40


def test_a_failing_save_leaves_the_old_model(spark, sf_dir, tmp_path, monkeypatch):
    train, test = registry.ctr_parts(spark, sf_dir)
    model = scoring.quick_ctr_model(train)
    target = str(tmp_path / "model")
    scoring.save(model, target, False)
    before = scoring.PipelineModel.load(target).transform(test).select("ad_id", "prediction").collect()

    class Half:
        def save(self, path):
            model.stages[0].save(path)
            raise Broken

    with pytest.raises(Broken):
        scoring.save(Half(), target, True)
    assert scoring.PipelineModel.load(target).transform(test).select("ad_id", "prediction").collect() == before
    assert listing(spark, target) == ["model"]
    other = Pipeline(stages=[vectors.assembler(vectors.middle_columns(train)), tuning.regressors()["lr"]]).fit(train)
    scoring.save(other, target, True)
    assert type(scoring.PipelineModel.load(target).stages[-1]).__name__ == "LinearRegressionModel"
    with pytest.raises(Exception, match="exist"):
        scoring.save(other, target, False)


def test_a_failing_scoring_job_leaves_the_old_scores(spark, sf_dir, tmp_path):
    features = registry.ctr_rows(spark, sf_dir)
    rows, model, out = (str(tmp_path / name) for name in ("rows", "model", "scores"))
    features.write.parquet(rows)
    scoring.save(scoring.quick_ctr_model(vectors.labelled(features)), model, False)
    jobs.main(["score", model, rows, out], spark)
    n = spark.read.csv(out, header=True).count()
    broken = str(tmp_path / "broken")
    features.drop("has_video").write.parquet(broken)
    with pytest.raises(Exception, match="has_video"):
        jobs.main(["score", model, broken, out, "--replace"], spark)
    assert spark.read.csv(out, header=True).count() == n > 0


def test_a_target_that_is_new_is_made(spark, tmp_path):
    target = str(tmp_path / "new")
    with switched(spark, target, True) as place:
        spark.range(4).write.parquet(place)
    assert spark.read.parquet(target).count() == 4 and listing(spark, target) == ["new"]
