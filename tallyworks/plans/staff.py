"""Employee, office and company reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.keyed_join import join_per_key


def columns(employee: DataFrame) -> DataFrame:
    return employee.select("id", "name", "surname")


def full_names(employee: DataFrame) -> DataFrame:
    return employee.select("id", F.concat("name", F.lit(" "), "surname").alias("fio"))


def first_by_id(employee: DataFrame, n: int = 10) -> DataFrame:
    return employee.select("id", "name", "surname").orderBy("id").limit(n)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def count_matching(employee: DataFrame, condition: Column) -> DataFrame:
    return count_rows(employee.where(condition))


def salary_summary(employee: DataFrame) -> DataFrame:
    return employee.agg(
        F.count(F.lit(1)).alias("employees"),
        F.max("salary").alias("max_salary"),
        F.min("salary").alias("min_salary"),
        F.round(F.avg("salary"), 6).alias("avg_salary"),
    )


def name_counts(employee: DataFrame, longer_than: int = 3) -> DataFrame:
    named = employee.where(F.length("name") > longer_than)
    return named.groupBy("name").agg(F.count("name").alias("employees"))


def frequent_names(employee: DataFrame, at_least: int = 150) -> DataFrame:
    counts = name_counts(employee)
    return counts.where(F.col("employees") >= at_least).orderBy(F.desc("employees"), "name")


def top_names(employee: DataFrame, k: int = 3) -> DataFrame:
    counts = employee.groupBy("name").agg(F.count("name").alias("employees"))
    return counts.orderBy(F.desc("employees"), "name").limit(k)


def first_characters(employee: DataFrame) -> DataFrame:
    return employee.select("id", "name", F.substring("name", 1, 1).alias("name_alias"))


def offices_with_company(office: DataFrame, company: DataFrame) -> DataFrame:
    """Company name and country per office.

    A company may own a large part of the offices: its offices are dealt to slots in proportion.
    """
    offices = office.where(F.col("company_id").isNotNull())
    owned = offices.groupBy("company_id").agg(F.count(F.lit(1)).alias("_offices"))
    per_company = company.select(F.col("id").alias("company_id"), "name").join(owned, "company_id")
    rows = offices.select("company_id", "country", "id")
    return join_per_key(rows, per_company, "company_id", "_offices", F.col("id"), "inner").select("name", "country")


def office_countries(office: DataFrame, company: DataFrame) -> DataFrame:
    """Distinct company name and country; duplicates are dropped before the join."""
    pairs = office.select("company_id", "country").distinct().alias("o")
    joined = pairs.join(company.alias("c"), F.col("o.company_id") == F.col("c.id"))
    return joined.select("c.name", "o.country").distinct().orderBy("name", "country")


def above_average(employee: DataFrame) -> DataFrame:
    average = employee.agg(F.avg("salary")).scalar()
    return employee.where(F.col("salary") > average).select("name", "surname")


def with_small_ids(employee: DataFrame, last_id: int = 2) -> DataFrame:
    """The same question as SQL text over a temporary view."""
    return employee.sparkSession.sql(
        "select name from {people} where id <= :last_id", args={"last_id": last_id}, people=employee
    )


def named_table(employee: DataFrame) -> DataFrame:
    """The frame as a table found by its name; the name is new and gone afterwards."""
    spark, name = employee.sparkSession, f"employee_{uuid.uuid4().hex}"
    employee.createTempView(name)
    try:
        return spark.table(name)
    finally:
        spark.catalog.dropTempView(name)
