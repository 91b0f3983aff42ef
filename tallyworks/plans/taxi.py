"""Taxi trip questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import at_utc_offset, first_word

TRIP_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _counted(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


def miles_total_corr(trips: DataFrame) -> DataFrame:
    return trips.agg(F.round(F.corr("trip_miles", "trip_total"), 5).alias("corr"))


def miles_total_cov(trips: DataFrame) -> DataFrame:
    return trips.agg(F.round(F.covar_samp("trip_miles", "trip_total"), 5).alias("cov"))


def describe(trips: DataFrame, columns: tuple[str, ...] = ("trip_miles", "trip_total")) -> DataFrame:
    """Typed summary, one row per column; all columns are summarised in one pass."""
    summaries = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("count"),
            F.round(F.avg(name), 1).alias("mean"),
            F.round(F.stddev_samp(name), 1).alias("stddev"),
            F.min(name).alias("min"),
            F.max(name).alias("max"),
        )
        for name in columns
    ]
    return trips.agg(F.array(*summaries).alias("rows")).select(F.inline("rows"))


def describe_mixed(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Summary of text and numeric columns together, in one pass: mean and deviation are NULL for text, the least
    and largest value stand in columns of their own kind."""
    kinds, entries = dict(df.dtypes), []
    for name in columns:
        text = kinds[name] == "string"
        number = F.lit(None).cast("double") if text else F.col(name).cast("double")
        words = F.col(name) if text else F.lit(None).cast("string")
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(name).alias("count"),
                F.round(F.avg(number), 6).alias("mean"),
                F.round(F.stddev_samp(number), 6).alias("stddev"),
                F.min(number).alias("min_number"),
                F.max(number).alias("max_number"),
                F.min(words).alias("min_text"),
                F.max(words).alias("max_text"),
            )
        )
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def least_common_payment(trips: DataFrame) -> DataFrame:
    return _counted(trips, "payment_type").orderBy("trips", "payment_type").limit(1)


def busiest_taxi(trips: DataFrame) -> DataFrame:
    """Trips without a taxi id compete as one taxi of their own."""
    return _counted(trips, "taxi_id").orderBy(F.desc("trips"), F.asc_nulls_last("taxi_id")).limit(1)


def cash_average(trips: DataFrame) -> DataFrame:
    cash = trips.filter("payment_type = 'Cash'").agg(F.avg("trip_total").alias("avg"))
    return cash.select("*", F.round("avg", 5).alias("avg_rounded")).select("avg_rounded")


def taxis_over_miles(trips: DataFrame, miles: float = 15000) -> DataFrame:
    driven = trips.groupBy("taxi_id").agg(F.sum("trip_miles").alias("miles"))
    return driven.where(F.col("miles") > miles).agg(F.count(F.lit(1)).alias("taxis"))


def longest_trip_miles(trips: DataFrame, k: int = 3) -> DataFrame:
    longest = trips.orderBy(F.desc("trip_seconds"), *TRIP_KEY).limit(k)
    return longest.select("trip_seconds", F.round("trip_miles", 0).alias("trip_miles"))


def average_income(trips: DataFrame) -> DataFrame:
    known = trips.where(F.col("taxi_id").isNotNull())
    income = known.groupBy("taxi_id").agg(F.sum("trip_total").alias("income"))
    return income.agg(F.round(F.avg("income"), 5).alias("avg_income"))


def trips_by_hour(trips: DataFrame, started: Column | None = None) -> DataFrame:
    started = F.col("trip_start_timestamp") if started is None else started
    return _counted(trips, F.hour(started).alias("hour")).orderBy(F.desc("trips"), "hour")


def trips_by_local_hour(trips: DataFrame, utc_offset: int = 3) -> DataFrame:
    return trips_by_hour(trips, at_utc_offset(F.col("trip_start_timestamp"), utc_offset))


def second_quarter_trips(trips: DataFrame) -> DataFrame:
    hour = F.hour("trip_start_timestamp")
    return trips.where((hour >= 6) & (hour < 12)).agg(F.count(F.lit(1)).alias("trips"))


def top_tip_dates(trips: DataFrame, k: int = 5) -> DataFrame:
    per_date = trips.groupBy(F.to_date("trip_start_timestamp").alias("date"))
    tips = per_date.agg(F.round(F.sum("tips"), 4).alias("tips"))
    return tips.orderBy(F.desc("tips"), "date").limit(k)


def top_trip_dates(trips: DataFrame, k: int = 5) -> DataFrame:
    dates = _counted(trips, F.to_date("trip_start_timestamp").alias("date"))
    return dates.orderBy(F.desc("trips"), "date").limit(k)


def top_brands(cars: DataFrame, k: int = 5) -> DataFrame:
    brands = cars.groupBy(first_word(F.col("car_model")).alias("brand"))
    return brands.agg(F.count(F.lit(1)).alias("cars")).orderBy(F.desc("cars"), "brand").limit(k)


def top_models_by_trips(trips: DataFrame, cars: DataFrame, k: int = 5) -> DataFrame:
    """Trips are counted per taxi before they meet the cars: one row per taxi is joined, not per trip."""
    per_taxi = _counted(trips.where(F.col("taxi_id").isNotNull()), "taxi_id")
    models = per_taxi.join(cars, "taxi_id").groupBy("car_model").agg(F.sum("trips").alias("trips"))
    return models.orderBy(F.desc("trips"), "car_model").limit(k)


def active_span(trips: DataFrame) -> DataFrame:
    return trips.groupBy("taxi_id").agg(
        F.min("trip_start_timestamp").alias("first_trip"), F.max("trip_start_timestamp").alias("last_trip")
    )


def known_taxi_trips(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("taxi_id").isNotNull()).agg(F.count(F.lit(1)).alias("trips"))
