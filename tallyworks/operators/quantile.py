"""Exact quantiles of a whole column without gathering the column in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.sources.workspace import written

TASK_ROWS = 100_000  # distinct values that one task may sort
BUCKETS = 4096  # rows of one histogram


def rank_floor(p: float, total: int) -> int:
    """1-based rank of the element at 0-based position floor(p * n)."""
    return min(math.floor(p * total) + 1, total)


def rank_discrete(p: float, total: int) -> int:
    """1-based rank of the first element whose cumulative share reaches p (SQL percentile_disc)."""
    return max(math.ceil(p * total), 1)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Written table (value, n): equal values are combined before the shuffle, NULLs left out."""
    present = df.select(F.col(column).cast("double").alias("value")).where(F.col("value").isNotNull())
    return written(present.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "value-counts")


def mean_of(counted: DataFrame) -> Column:
    return F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n").cast("double"))


def _running(order: str) -> Column:
    frame = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum("n").over(frame)


def exact_quantile(
    counted: DataFrame, p: float, rank_rule=rank_floor, task_rows: int = TASK_ROWS
) -> Column:
    """The exact p-quantile of a `value_counts` table, as a scalar column.

    While more distinct values are left than one task should sort, an equal-width histogram over
    them finds the one bucket that holds the wanted rank, and the search goes on inside it. The
    driver sees one row per round. The lowest and the highest value never share a bucket, so each
    round makes the slice smaller, and what is ranked at the end is exact.
    """
    facts = counted.agg(
        F.sum("n").alias("total"),
        F.count("n").alias("size"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
    ).first()
    if facts.total is None:
        return F.lit(None).cast("double")
    rank, size, lo, hi = rank_rule(p, facts.total), facts.size, facts.lo, facts.hi

    while size > task_rows:
        place = F.floor((F.col("value") - lo) / (hi - lo) * BUCKETS)
        last = F.lit(BUCKETS - 1)
        bucket = F.when(F.col("value") == hi, last).otherwise(F.least(place, last)).cast("int")
        histogram = counted.groupBy(bucket.alias("bucket")).agg(
            F.sum("n").alias("n"),
            F.count("n").alias("size"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
        marked = histogram.withColumn("upto", _running("bucket"))
        hit = marked.where((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)).first()
        rank, size, lo, hi = rank - (hit.upto - hit.n), hit["size"], hit.lo, hit.hi
        counted = counted.where(F.col("value").between(lo, hi))

    ranked = counted.withColumn("upto", _running("value"))
    return ranked.agg(F.min(F.when(F.col("upto") >= rank, F.col("value")))).scalar()
