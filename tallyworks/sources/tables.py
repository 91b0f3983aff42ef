"""The stored tables and the business views over them.

Each view is a projection (plus at most one filter) over one stored table, so column pruning and
filter pushdown reach the Parquet scan of every plan built on top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def ads_data(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per ad event (view or click)."""
    events = stored(spark, data_dir, "events").where(F.col("event_type").isin("view", "click"))
    k = F.get_json_object("props", "$.k").cast("int")
    slot = F.col("event_id") % 10
    keyed = events.select(
        "event_id",
        (F.col("user_id") * 10 + k % 10).alias("ad_id"),
        "user_id",
        "ts",
        "event_type",
        ((F.col("user_id") + k % 10) % 3 == 0).alias("has_video"),
    )
    return keyed.select(
        "event_id",
        "ad_id",
        F.col("user_id").alias("client_union_id"),
        (F.col("user_id") % 20).alias("campaign_union_id"),
        F.col("ts").alias("time"),
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("event"),
        F.when(slot < 2, "web").when(slot < 5, "ios").otherwise("android").alias("platform"),
        F.when(F.col("ad_id") % 2 == 0, "CPM").otherwise("CPC").alias("ad_cost_type"),
        (100 + (F.col("user_id") % 8) * 25).cast("double").alias("ad_cost"),
        "has_video",
        (F.col("ad_id") * 37).alias("target_audience_count"),
    )


def ads_clients_data(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per client of the ad cabinet."""
    offset = (F.col("c_custkey") % 300).cast("int")
    return stored(spark, data_dir, "customer").select(
        F.col("c_custkey").alias("client_union_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), offset).alias("create_date"),
    )


def trips(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per taxi trip; the four key columns together are unique."""
    minute = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131 + F.col("l_partkey")) % 1440).cast("int")
    seconds = (F.col("l_quantity") * 60 + F.col("l_partkey") % 60).cast("int")
    started = F.timestamp_add("MINUTE", minute, F.col("l_shipdate"))
    return stored(spark, data_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.nullif(F.col("l_suppkey"), F.lit(0)).alias("taxi_id"),
        started.alias("trip_start_timestamp"),
        F.timestamp_add("SECOND", seconds, started).alias("trip_end_timestamp"),
        seconds.alias("trip_seconds"),
        F.col("l_quantity").alias("trip_miles"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("fare"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tips"),
        F.col("l_extendedprice").alias("trip_total"),
        F.when(F.col("l_returnflag") == "R", "Cash")
        .when(F.col("l_returnflag") == "A", "Credit Card")
        .otherwise("Unknown")
        .alias("payment_type"),
    )


def cars(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per taxi car; the model reads "brand model"."""
    supplier = stored(spark, data_dir, "supplier").select("s_suppkey")
    part = stored(spark, data_dir, "part").select("p_partkey", "p_name")
    return supplier.join(part, F.col("p_partkey") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("taxi_id"), F.col("p_name").alias("car_model")
    )


def employee(spark: SparkSession, data_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    return stored(spark, data_dir, "part").select(
        F.col("p_partkey").alias("id"),
        words[0].alias("name"),
        words[1].alias("surname"),
        F.col("p_retailprice").alias("salary"),
    )


def company(spark: SparkSession, data_dir: str) -> DataFrame:
    return stored(spark, data_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
    )


def office(spark: SparkSession, data_dir: str) -> DataFrame:
    return stored(spark, data_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("company_id"),
        F.col("c_mktsegment").alias("country"),
    )


def passengers(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per passenger; Age and Embarked have gaps."""
    key = F.col("o_orderkey")
    return stored(spark, data_dir, "orders").select(
        key.alias("PassengerId"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("Survived"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("Pclass"),
        F.lit("name").alias("Name"),
        F.when(F.col("o_custkey") % 2 == 0, "male").otherwise("female").alias("Sex"),
        F.when(key % 5 != 0, (F.col("o_custkey") % 80).cast("double")).alias("Age"),
        (key % 4).cast("int").alias("SibSp"),
        (F.col("o_custkey") % 3).cast("int").alias("Parch"),
        F.lit("ticket").alias("Ticket"),
        (F.col("o_totalprice") / 1000).alias("Fare"),
        F.lit("cabin").alias("Cabin"),
        F.when(key % 97 == 0, F.lit(None).cast("string"))
        .when(key % 7 < 4, "S")
        .when(key % 7 < 6, "C")
        .otherwise("Q")
        .alias("Embarked"),
    )
