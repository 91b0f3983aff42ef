"""Distinct ads by mergeable HyperLogLog sketches: stored once a day, combined over any span of days.

A sketch has a fixed size, so counting distinct ads of a month reads thirty small rows, not the events again, and a
new day is one more row. Sketches are merged in place of the sets themselves; a union of sketches holds what one
sketch over all the rows holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.workspace import new_folder, written

SIZE = 12  # a sketch has 2^SIZE places
DEVIATION = 1.04 / 2 ** (SIZE / 2)  # of an estimate, relative, at most about so much
DEVIATIONS = 4
KEPT_DAYS = 7  # days of the trailing span


def daily_sketches(ads: DataFrame) -> DataFrame:
    """date and sketch of the ads with an event that day; events without a date belong to no day."""
    dated = ads.where(F.col("date").isNotNull() & F.col("ad_id").isNotNull())
    return dated.groupBy("date").agg(F.hll_sketch_agg("ad_id", F.lit(SIZE)).alias("sketch"))


def store_days(ads: DataFrame, path: str) -> DataFrame:
    """Append the days of `ads` that the table at `path` lacks; returns the whole table. Days are stored once: a run that
    comes again, or overlaps with the one before, adds nothing twice."""
    spark, schema = ads.sparkSession, "date date, sketch binary"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        known = spark.read.schema(schema).parquet(path).select("date")
        ads = ads.join(F.broadcast(known), "date", "left_anti")  # one short row a day
    daily_sketches(ads).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def estimated(sketches: str = "sketch") -> Column:
    """Aggregate: distinct ads of the union of the sketches.

    A sketch that only took in single values so far estimates from their order too. Merged with itself it holds the same,
    and what it tells depends on what it holds alone, however it came about.
    """
    union = F.hll_union_agg(sketches, F.lit(False))
    return F.hll_sketch_estimate(F.hll_union(union, union))


def outside(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) > F.greatest(F.lit(1.0), DEVIATIONS * DEVIATION * exact)


def daily_ads(ads: DataFrame) -> DataFrame:
    """Ads per day, exact, and whether the day's sketch tells a number outside its bound."""
    stored = store_days(ads, new_folder(ads.sparkSession, "sketches"))
    told = stored.groupBy("date").agg(estimated().alias("told"))
    exact = ads.where(F.col("date").isNotNull()).groupBy("date").agg(F.count_distinct("ad_id").alias("ads"))
    return exact.join(told, "date").select("date", "ads", outside(F.col("told"), F.col("ads")).alias("outside_bound"))


def merged_days(ads: DataFrame) -> DataFrame:
    """Distinct ads over all days: exact, whether the merged days tell a number outside the bound, and whether it is
    another one than that of one sketch over all rows."""
    dated = ads.where(F.col("date").isNotNull())
    stored = store_days(dated, new_folder(ads.sparkSession, "sketches"))
    whole = dated.agg(F.hll_sketch_agg("ad_id", F.lit(SIZE)).alias("sketch"))
    both = stored.agg(estimated().alias("merged")).select("merged", whole.agg(estimated().alias("n")).scalar().alias("whole"))
    exact = dated.agg(F.count_distinct("ad_id").alias("ads"))
    return both.select(exact.scalar().alias("ads"), "merged", "whole").select(
        "ads",
        outside(F.col("merged"), F.col("ads")).alias("outside_bound"),
        (F.col("merged") != F.col("whole")).alias("other_than_whole"),
    )


def trailing_ads(ads: DataFrame, days: int = KEPT_DAYS) -> DataFrame:
    """For each day with events, the distinct ads of it and the days before, `days` together: exact, and whether the
    merged sketches of these days tell a number outside the bound.

    Each day's sketch, and for the exact number each (day, ad), goes to the `days` spans that it is in.
    """
    dated = ads.where(F.col("date").isNotNull())
    spans = F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.date_add("date", k)))
    with_events = written(dated.select("date").distinct(), "days")
    stored = store_days(dated, new_folder(ads.sparkSession, "sketches"))
    told = stored.select(spans.alias("day"), "sketch").groupBy("day").agg(estimated().alias("told"))
    pairs = dated.select("date", "ad_id").distinct().select(spans.alias("day"), "ad_id")
    exact = pairs.groupBy("day").agg(F.count_distinct("ad_id").alias("ads"))
    days_shown = with_events.withColumnRenamed("date", "day")
    found = exact.join(told, "day").join(F.broadcast(days_shown), "day")
    return found.select("day", "ads", outside(F.col("told"), F.col("ads")).alias("outside_bound"))
