from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.operators.keyed_join import join_per_key


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one key, the rest over 3000 keys, some keys NULL."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 3000)
    return spark.range(30_000).select(F.col("id"), key.cast("long").alias("key")).persist()


@pytest.fixture(scope="module")
def per_key(rows):
    """Keys below 2000 only, so that some rows find no partner."""
    counted = rows.where("key < 2000").groupBy("key").agg(F.count(F.lit(1)).alias("weight"))
    return counted.withColumn("name", F.concat(F.lit("k"), "key"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_equals_the_plain_join(rows, per_key, how):
    salted = join_per_key(rows, per_key, "key", "weight", F.col("id"), how)
    plain = rows.join(per_key.drop("weight"), "key", how)
    assert sorted(salted.columns) == sorted(plain.columns)
    columns = plain.columns
    assert Counter(map(tuple, salted.select(columns).collect())) == Counter(map(tuple, plain.collect()))


def test_hot_rows_are_spread(spark, rows, per_key):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_per_key(rows, per_key, "key", "weight", F.col("id"))
        sizes = joined.groupBy(F.spark_partition_id()).count().select("count").collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # a plain join would leave the 10 000 rows of key 7 in one of the four partitions
    assert max(row[0] for row in sizes) < 9_500


@pytest.mark.parametrize("n", [4, 16])
def test_no_task_has_much_more_than_its_share(spark, rows, per_key, n):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(n),
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = join_per_key(rows.where("key is not null"), per_key, "key", "weight", F.col("id"))
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # the hot key alone would give one task a third of all rows; slots may meet in a task, but only few
    assert max(sizes) <= 2.5 * sum(sizes) / n
