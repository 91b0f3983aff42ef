from __future__ import annotations

import glob
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyworks.operators.splits import content_parts, hash_split, seeded_parts, split_report
from tallyworks.operators.words import word_count
from tallyworks.sources import files, integers, workspace


def test_range_pipeline_and_union(spark):
    numbers = integers.keys(spark.range(1000).withColumnRenamed("id", "key"), "key")
    assert integers.filter_map_sum(numbers).first()[0] == "595804"
    assert integers.union_count(numbers).first()[0] == 2000


def test_sum_beyond_bigint(spark):
    frame = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "id long")
    assert frame.agg(integers.exact_sum(F.col("id"))).first()[0] == str(3 * 2**62)


def test_repartition_is_even(spark):
    row = integers.repartition_summary(spark.range(1003), 4).first()
    assert (row.partitions, row.rows, row.even) == (4, 1003, True)


def test_words_split_on_every_separator(spark):
    text = " Big\tData\nBig \r\f Data Big  "
    lines = spark.createDataFrame([(text,), ("Big",), ("",), (None,)], "value string")
    assert dict(map(tuple, word_count(lines, "value").collect())) == {"Big": 3, "Data": 1, "Data Big": 1}


def test_header_only_csv_is_text(spark, tmp_path):
    path = str(tmp_path / "people.csv")
    with open(path, "w") as out:
        out.write("PassengerId,Age,SibSp,Parch\n1,,1,2\n2,30,0,0\n")
    raw = files.read_csv_text(spark, path)
    assert {kind for _, kind in raw.dtypes} == {"string"}
    typed = files.read_csv_typed(spark, path)
    assert dict(typed.dtypes)["Age"] == "int"


def test_csv_without_header_and_in_one_file(spark, tmp_path):
    frame = spark.range(10, numPartitions=4).select("id", F.lit("x").alias("tag"))
    path = str(tmp_path / "plain")
    files.write_csv(frame, path, header=False, one_file=True)
    parts = glob.glob(path + "/part-*")
    assert len(parts) == 1
    assert len(open(parts[0]).read().splitlines()) == 10


def test_text_has_one_file_per_partition(spark):
    before = workspace.new_folder(spark, "x")
    frame = spark.range(100, numPartitions=5)
    assert files.text_round_trip(frame, "id").agg(F.sum("id")).first()[0] == 4950
    folder = os.path.dirname(before).removeprefix("file:")
    newest = max(glob.glob(folder + "/text-*"), key=os.path.getmtime)
    assert len(glob.glob(newest + "/part-*")) == 5


def test_partitioned_table_prunes_folders(spark):
    frame = spark.range(1000).withColumn("kind", (F.col("id") % 3).cast("int"))
    table = files.partitioned_table(frame, "kind")
    plan = table.where("kind = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    assert files.partition_count(frame, "kind").first()[0] == 3


def test_column_profile_counts_gaps(spark):
    frame = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "id int, tag string")
    assert [tuple(r) for r in files.column_profile(frame).collect()] == [
        (1, "id", "int", 3, 3, 3), (2, "tag", "string", 3, 1, 1),
    ]


def test_seeded_parts_are_repeatable_and_whole(spark):
    stored = workspace.written(spark.range(5000), "split")
    shares = {"train": 0.75, "test": 0.25}
    first, second = (seeded_parts(stored, shares, 42) for _ in range(2))
    assert first["train"].exceptAll(second["train"]).count() == 0
    row = split_report(stored, first, shares, "id").first()
    assert tuple(row) == (5000, 0, 0, True)


def test_content_parts_do_not_depend_on_files(spark):
    shares = {"train": 0.75, "test": 0.25}
    one, other = spark.range(2000, numPartitions=1), spark.range(2000, numPartitions=7)
    first, second = (content_parts(df, shares, 42) for df in (one, other))
    assert first["train"].exceptAll(second["train"]).count() == 0
    assert tuple(split_report(one, first, shares, "id").first()) == (2000, 0, 0, True)
    assert content_parts(one, shares, 43)["train"].exceptAll(first["train"]).count() > 0


def test_split_report_sees_loss_and_overlap(spark):
    whole = spark.range(100)
    parts = {"train": whole.where("id < 80"), "test": whole.where("id >= 70 and id < 95")}
    row = split_report(whole, parts, {"train": 0.75, "test": 0.25}, "id").first()
    assert (row.keys, row.lost, row.repeated) == (100, 5, 10)
    lopsided = {"train": whole.where("id < 5"), "test": whole.where("id >= 5")}
    assert not split_report(whole, lopsided, {"train": 0.75, "test": 0.25}, "id").first().sizes_as_asked


def test_hash_split_takes_large_keys(spark):
    keys = spark.createDataFrame([(2**62 + 1,), (1,), (99,)], "ad_id long")
    parts = {r.ad_id: r.part for r in hash_split(keys, "ad_id").collect()}
    assert parts == {key: "train" if key * 7919 % 100 < 75 else "test" for key in (2**62 + 1, 1, 99)}


def fake_session(master, folder=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint, applicationId="app")
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: folder or default))


def test_user_views_survive(spark, sf_dir):
    names = ("employee", "people", "ads_data")
    for name in names:
        spark.range(1).createOrReplaceTempView(name)
    queries = contract.queries()
    for query in ("table_scan", "sql_view_filter", "ctr_by_ad"):
        assert queries[query](spark, sf_dir).count() > 0
    assert all(spark.table(name).columns == ["id"] for name in names)
    assert {t.name for t in spark.catalog.listTables() if t.isTemporary} == set(names)
    for name in names:
        spark.catalog.dropTempView(name)


def test_a_folder_of_every_machine_is_refused(spark, tmp_path, monkeypatch):
    workspace.check_shared(spark, str(tmp_path), "app-1")
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: 3)  # as if most files lay elsewhere
    with pytest.raises(RuntimeError, match="not shared"):
        workspace.check_shared(spark, str(tmp_path), "app-2")


def test_intermediate_tables_can_be_cleared(spark):
    table = workspace.written(spark.range(5), "cleared")
    folder = Path(table.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists()
    workspace.clear(spark)
    assert not folder.exists()
    assert workspace.written(spark.range(5), "later").count() == 5


def test_shared_folder_comes_from_the_session(monkeypatch):
    monkeypatch.setattr(workspace, "check_shared", lambda *_: None)
    assert workspace.shared_folder(fake_session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert workspace.shared_folder(fake_session("yarn", None, "hdfs:///other")) == "hdfs:///other"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        workspace.shared_folder(fake_session("spark://host:7077"))
