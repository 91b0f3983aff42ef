from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyworks.plans import passengers, staff, taxi

SCHEMA = (
    "PassengerId long, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int, "
    "Ticket string, Fare double, Cabin string, Embarked string"
)
ROWS = [
    (1, 0, 3, "a", "male", 20.0, 1, 0, "t", 7.0, None, "S"),
    (2, 1, 1, "b", "female", None, 0, 0, "t", 8.0, "c", None),
    (3, 1, 2, "c", "female", 31.0, 1, 2, "t", 9.0, None, "C"),
    (4, 0, 2, "d", "male", 30.0, 0, 0, "t", 9.0, None, "C"),
]


def test_clean(spark):
    cleaned = passengers.clean(spark.createDataFrame(ROWS, SCHEMA))
    expected = ["PassengerId", "Survived", "Pclass", "Age", "SibSp", "Parch", "Embarked", "FamilySize", "M", "W"]
    assert cleaned.columns == expected
    row = cleaned.where("PassengerId = 2").first()
    assert (row.Age, row.FamilySize, row.M, row.W) == (27.0, 1, False, True)


def test_text_columns_are_cast_first(spark):
    raw = spark.createDataFrame([("1", None, "1", "2"), ("2", "30", "0", "0")], "PassengerId string, Age string, SibSp string, Parch string")
    typed = passengers.typed(raw)
    assert dict(typed.dtypes)["SibSp"] == "int"
    assert [r.Age for r in passengers.fill_mean_age(typed).orderBy("PassengerId").collect()] == [30.0, 30.0]


def test_index_ties_go_by_value(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    rows = passengers.with_category_index(passengers.fill_embarked(frame)).collect()
    assert {(r.Sex, r.Sex_index) for r in rows} == {("female", 0.0), ("male", 1.0)}
    assert {(r.Embarked, r.Embarked_index) for r in rows} == {("C", 0.0), ("S", 1.0)}


def test_alone(spark):
    flags = passengers.alone_flag(spark.createDataFrame(ROWS, SCHEMA)).orderBy("PassengerId").collect()
    assert [(r.Family_Size, r.Alone) for r in flags] == [(1, 0), (0, 1), (3, 0), (0, 1)]


def test_unknown_taxi_counts_as_one(spark):
    frame = spark.createDataFrame([(None,), (None,), (5,)], "taxi_id long")
    assert tuple(taxi.busiest_taxi(frame).first()) == (None, 2)
    assert taxi.known_taxi_trips(frame).first()[0] == 1


def test_local_hour_crosses_midnight(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1, 22, 10),)], "trip_start_timestamp timestamp_ntz")
    assert tuple(taxi.trips_by_local_hour(frame).first()) == (1, 1)


def test_sql_text_equals_frame(spark):
    people = spark.createDataFrame([(1, "Alex"), (2, "Anna"), (3, "Denis"), (4, "Alex")], "id int, name string")
    assert {r.name for r in staff.with_small_ids(people).collect()} == {"Alex", "Anna"}
    counts = people.groupBy("name").agg(F.count("name").alias("n")).collect()
    assert dict(map(tuple, counts))["Alex"] == 2
