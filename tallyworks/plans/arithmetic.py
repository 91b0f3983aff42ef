"""Chained and fanned-out computations on a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.workspace import written


def times(df: DataFrame, factor: int) -> DataFrame:
    return df.withColumn("x", F.col("x") * factor)


def plus(df: DataFrame, addend: int, name: str = "x") -> DataFrame:
    return df.withColumn(name, F.col("x") + addend)


def loaded(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.col("value").alias("x"))


def chain(events: DataFrame) -> DataFrame:
    """Load, times 25, plus 5, store; the steps are columns of one plan, not tasks that pass a number."""
    return written(loaded(events).transform(times, 25).transform(plus, 5), "chain")


def fan_out(events: DataFrame) -> DataFrame:
    """The product feeds two branches, +5 and +10; both are columns of the same pass."""
    product = loaded(events).transform(times, 25)
    return product.transform(plus, 5, "plus_5").transform(plus, 10, "plus_10").drop("x")
