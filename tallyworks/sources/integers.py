"""Stored integers, in-memory tuples and pandas batches as sources."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys(df: DataFrame, column: str) -> DataFrame:
    """The integers of a stored column, as `id`."""
    return df.select(F.col(column).cast("long").alias("id"))


def exact_sum(column):
    """Sum beyond the range of bigint, as text."""
    return F.sum(column.cast("decimal(20,0)")).cast("string")


def key_summary(numbers: DataFrame) -> DataFrame:
    return numbers.agg(
        F.count("id").alias("rows"),
        F.min("id").alias("lowest"),
        F.max("id").alias("highest"),
        exact_sum(F.col("id")).alias("total"),
    )


def filter_map_sum(numbers: DataFrame) -> DataFrame:
    """Sum of x + 100 over the x whose square exceeds 1000; squares are doubles, so they cannot overflow."""
    large = numbers.where(F.pow("id", F.lit(2)) > 1000)
    return large.agg(exact_sum(F.col("id") + 100).alias("total"))


def union_count(numbers: DataFrame) -> DataFrame:
    return numbers.unionAll(numbers).agg(F.count(F.lit(1)).alias("rows"))


def partition_report(df: DataFrame, n: int) -> DataFrame:
    """Rows per partition after an even redistribution over n partitions."""
    spread = df.repartition(n)
    return spread.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def repartition_summary(df: DataFrame, n: int = 4) -> DataFrame:
    return partition_report(df, n).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("rows").alias("rows"),
        (F.max("rows") - F.min("rows") <= n).alias("even"),
    )


def status_names(orders: DataFrame) -> DataFrame:
    """A handful of in-memory tuples as a lookup table for a stored one."""
    names = [("F", "finished"), ("O", "open"), ("P", "pending")]
    lookup = orders.sparkSession.createDataFrame(names, "o_orderstatus string, status string")
    per_status = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return per_status.join(F.broadcast(lookup), "o_orderstatus").select("status", "orders")


def with_age(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(age=batch["id"] * 10)


def through_pandas(people: DataFrame) -> DataFrame:
    """Arrow batches become pandas frames inside the tasks; nothing is collected."""
    return people.select("id", "name").mapInPandas(with_age, "id long, name string, age long")
