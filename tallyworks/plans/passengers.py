"""Passenger clean-up and feature preparation."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDEXED = ["Sex", "Embarked"]


def typed(raw: DataFrame) -> DataFrame:
    """Header-only CSV holds text; give the numeric columns their types before any arithmetic."""
    types = {"PassengerId": "long", "Survived": "int", "Pclass": "int", "SibSp": "int", "Parch": "int"}
    types |= {"Age": "double", "Fare": "double"}
    present = {name: F.col(name).cast(kind) for name, kind in types.items() if name in raw.columns}
    return raw.withColumns(present)


def drop_text_columns(df: DataFrame) -> DataFrame:
    return df.drop("Ticket", "Name", "Fare", "Cabin")


def family_sizes(df: DataFrame) -> DataFrame:
    relatives = F.col("SibSp") + F.col("Parch")
    return df.select("PassengerId", (relatives + 1).alias("FamilySize"), relatives.alias("Family_Size"))


def with_alone(df: DataFrame) -> DataFrame:
    df = df.withColumn("Family_Size", F.col("SibSp") + F.col("Parch"))
    return df.withColumn("Alone", F.when(F.col("Family_Size") == 0, 1).otherwise(F.lit(0)))


def alone_flag(df: DataFrame) -> DataFrame:
    return with_alone(df).select("PassengerId", "Family_Size", "Alone")


def with_sex_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"M": F.col("Sex") == "male", "W": F.col("Sex") == "female"})


def sex_flags(df: DataFrame) -> DataFrame:
    return with_sex_flags(df).select("PassengerId", "M", "W")


def fill_mean_age(df: DataFrame, rounded: bool = False) -> DataFrame:
    """Missing ages become the mean age; the mean is a subquery of the same plan, not a driver value."""
    mean = F.avg("Age")
    known = df.agg(F.bround(mean, 0) if rounded else mean).scalar()
    return df.withColumn("Age", F.coalesce("Age", known))


def fill_embarked(df: DataFrame) -> DataFrame:
    return df.na.fill({"Embarked": "S"})


def filled_ages(df: DataFrame, rounded: bool = False) -> DataFrame:
    return fill_mean_age(df, rounded).select("PassengerId", "Age")


def filled_ports(df: DataFrame) -> DataFrame:
    return fill_embarked(df).select("PassengerId", "Embarked")


def missing_ages(df: DataFrame) -> DataFrame:
    return df.where(F.col("Age").isNull()).agg(F.count(F.lit(1)).alias("passengers"))


def distinct_sex(df: DataFrame) -> DataFrame:
    return df.select("Sex").distinct()


def survival_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("Survived").agg(F.count(F.lit(1)).alias("passengers"))


def clean(df: DataFrame) -> DataFrame:
    """The clean-up job: fewer columns, family size, mean age, sex as two flags."""
    cleaned = df.transform(drop_text_columns).withColumn("FamilySize", F.col("SibSp") + F.col("Parch") + 1)
    return cleaned.transform(fill_mean_age).transform(with_sex_flags).drop("Sex")


# The columns that say nothing about survival.
UNUSED = ("PassengerId", "Name", "Ticket", "Cabin")


def prepared(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Filled and derived columns, categories still as text; without UNUSED but for those to `keep`."""
    ready = df.transform(fill_mean_age, rounded=True).transform(fill_embarked)
    return ready.transform(with_alone).drop(*(c for c in UNUSED if c not in keep))


def with_category_index(df: DataFrame) -> DataFrame:
    """Category numbers by falling frequency, equal counts by value."""
    indexer = StringIndexer(inputCols=INDEXED, outputCols=[f"{name}_index" for name in INDEXED])
    return indexer.fit(df.select(*INDEXED)).transform(df)


def category_index(df: DataFrame) -> DataFrame:
    ports = df.transform(fill_embarked).transform(with_category_index)
    return ports.groupBy(*INDEXED, "Sex_index", "Embarked_index").agg(F.count(F.lit(1)).alias("passengers"))


def features(df: DataFrame) -> DataFrame:
    """All-numeric rows with the label Survived in front."""
    return df.transform(prepared).transform(with_category_index).drop(*INDEXED)
