"""Training features of ads: the flagship six-key form and the two event-grain forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import flag
from tallyworks.operators.keyed_join import join_per_key
from tallyworks.operators.layout import write_layout
from tallyworks.operators.splits import write_split
from tallyworks.plans.ads import clicks, is_view, views
from tallyworks.sources.workspace import new_folder

# The feature columns in their order, and the shares of the two files.
AD_COLUMNS = ["ad_id", "target_audience_count", "has_video", "is_cpm", "is_cpc", "ad_cost"]
FEATURE_COLUMNS = [*AD_COLUMNS, "day_count", "ctr"]
SHARES = {"train": 0.75, "test": 0.25}
SEED = 42


def with_cost_flags(ads: DataFrame) -> DataFrame:
    kind = F.col("ad_cost_type")
    return ads.withColumns({"is_cpm": flag(kind == "CPM"), "is_cpc": flag(kind == "CPC")})


def cost_type_onehot(ads: DataFrame) -> DataFrame:
    return with_cost_flags(ads).select("event_id", "is_cpm", "is_cpc")


def view_days() -> Column:
    """Aggregate: distinct dates on which the ad was viewed."""
    return F.count_distinct(F.when(is_view(), F.col("date"))).alias("day_count")


def view_days_per_ad(ads: DataFrame) -> DataFrame:
    return ads.groupBy("ad_id").agg(view_days())


def renamed_view_days(ads: DataFrame) -> DataFrame:
    """Viewed ads only; the rename goes from an explicit alias, never from a generated name."""
    days = ads.where(is_view()).groupBy("ad_id").agg(F.count_distinct("date").alias("dates"))
    return days.withColumnRenamed("dates", "days_count")


def with_ctr(counted: DataFrame) -> DataFrame:
    rate = F.expr("try_divide(double(clicks), double(views))").alias("ctr")
    return counted.select("*", rate).drop("views", "clicks")


def ad_features(ads: DataFrame) -> DataFrame:
    """One row per ad. Grouping by all ad attributes replaces joins of statistics back onto events."""
    grouped = with_cost_flags(ads).groupBy(*AD_COLUMNS)
    return with_ctr(grouped.agg(views(), clicks(), view_days())).select(*FEATURE_COLUMNS)


def _row_id(ads: DataFrame) -> Column:
    # without an id column the rows come straight from a file scan, where this number is repeatable
    return F.col("event_id") if "event_id" in ads.columns else F.monotonically_increasing_id()


def _event_rows(ads: DataFrame) -> DataFrame:
    keep = [*AD_COLUMNS, "row_id"]
    return with_cost_flags(ads.withColumn("row_id", _row_id(ads))).select(*keep)


def _onto_events(ads: DataFrame, per_ad: DataFrame) -> DataFrame:
    joined = join_per_key(_event_rows(ads), per_ad, "ad_id", "events", F.col("row_id"), "left")
    return joined.drop("row_id")


def event_features(ads: DataFrame) -> DataFrame:
    """One row per event: one table of ad statistics joined back."""
    events = F.count(F.lit(1)).alias("events")
    per_ad = ads.groupBy("ad_id").agg(events, views(), clicks(), view_days())
    return _onto_events(ads, with_ctr(per_ad)).select(*FEATURE_COLUMNS)


def bucketed_event_features(ads: DataFrame, buckets: int | None = None) -> DataFrame:
    """The same rows over a layout of the events by ad: neither the statistics nor the join shuffle events."""
    keep = ads.select("*", _row_id(ads).alias("row_id")) if "event_id" not in ads.columns else ads
    columns = [c for c in keep.columns if c in {*AD_COLUMNS, "ad_cost_type", "event", "date", "row_id", "event_id"}]
    row = "event_id" if "event_id" in keep.columns else "row_id"
    layout = write_layout(keep.select(*columns), "ad_id", lambda: F.col(row), buckets)
    days = F.collect_set(F.when(is_view(), F.col("date"))).alias("days")
    per_ad = layout.statistics(
        [views(), clicks(), days],
        [F.sum("views").alias("views"), F.sum("clicks").alias("clicks"), F.size(F.array_distinct(F.flatten(F.collect_list("days")))).cast("long").alias("day_count")],
    )
    return with_cost_flags(layout.join_back(with_ctr(per_ad))).select(*FEATURE_COLUMNS)


def event_features_two_tables(ads: DataFrame) -> DataFrame:
    """One row per event: view days and click rates as from two tables, so that an ad that was never
    viewed has no day count at all instead of 0.

    Both statistics come out of the same pass over the events and are joined back together.
    """
    events = F.count(F.lit(1)).alias("events")
    per_ad = with_ctr(ads.groupBy("ad_id").agg(events, views(), clicks(), view_days()))
    per_ad = per_ad.withColumn("days_count", F.nullif("day_count", F.lit(0))).drop("day_count")
    return _onto_events(ads, per_ad).select(*AD_COLUMNS, "days_count", "ctr")


def build_training_files(features: DataFrame, target: str, replace: bool = False) -> dict[str, str]:
    """The feature job: train (75 %) and test (25 %) of the ads as Parquet below `target`, in one pass.

    An ad has all its rows in one part, so at event grain the test error is not that of rows seen in training.
    """
    return write_split(features, target, SHARES, SEED, "ad_id", replace)


def training_files(ads: DataFrame) -> dict[str, str]:
    return build_training_files(ad_features(ads), new_folder(ads.sparkSession, "ctr-files"))
