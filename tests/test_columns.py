from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyworks.functions.columns import (
    at_utc_offset,
    count_where,
    day_key,
    days_between,
    first_word,
    flag,
    percent,
    ratio,
    sum_where,
)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_ratio_of_zero_is_null(spark):
    assert one(spark, ratio(F.lit(3), F.lit(0)), ratio(F.lit(0), F.lit(3)), ratio(F.lit(1), F.lit(4))) == (None, 0.0, 0.25)
    assert one(spark, percent(F.lit(1), F.lit(3)))[0] == 100 / 3


def test_days_count_midnights(spark):
    late, early = ntz("2020-01-01 23:00:00"), ntz("2020-01-02 01:00:00")
    assert one(spark, days_between(late, early), days_between(early, late), days_between(late, late)) == (1, -1, 0)


def test_day_key(spark):
    assert one(spark, day_key(F.lit("2019-04-05").cast("date")))[0] == 20190405
    assert dict(spark.range(1).select(day_key(F.lit("2019-04-05").cast("date")).alias("k")).dtypes)["k"] == "int"


def test_utc_offsets(spark):
    noon = ntz("2024-01-05 22:30:00")
    east, west, same = one(spark, at_utc_offset(noon, 3), at_utc_offset(noon, -2), at_utc_offset(noon, 0))
    assert east == dt.datetime(2024, 1, 6, 1, 30)
    assert west == dt.datetime(2024, 1, 5, 20, 30)
    assert same == dt.datetime(2024, 1, 5, 22, 30)


def test_flags_keep_null(spark):
    null = F.lit(None).cast("string")
    assert one(spark, flag(F.lit("a") == "a"), flag(F.lit("a") == "b"), flag(null == "a")) == (1, 0, None)


def test_conditional_aggregates_ignore_null_conditions(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 4.0)], "k string, v double")
    counted = rows.agg(count_where(F.col("k") == "a"), sum_where(F.col("k") == "b", F.col("v")), sum_where(F.col("k") == "z", F.col("v")))
    assert tuple(counted.first()) == (1, 2.0, 0.0)


def test_first_word(spark):
    assert one(spark, first_word(F.lit("blue anvil x")), first_word(F.lit("single"))) == ("blue", "single")
