"""File formats: CSV, JSON, Parquet and text written in parallel and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.switching import switched
from tallyworks.sources.workspace import new_folder


def write_csv(df: DataFrame, path: str, header: bool = True, one_file: bool = False, replace: bool = False) -> None:
    """One file per partition; `one_file` is for results known to be small, it runs in one task. An existing
    path is an error unless it is to be replaced, and stays as it is until the new files are complete."""
    rows = df.coalesce(1) if one_file else df
    with switched(df.sparkSession, path, replace) as place:
        rows.write.option("header", header).csv(place)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header only: every column is a string."""
    return spark.read.option("header", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Header plus types: a given schema saves the extra pass that inference takes over the files."""
    if schema is not None:
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.csv(path, header=True, inferSchema=True)


def csv_text_scan(df: DataFrame) -> DataFrame:
    path = new_folder(df.sparkSession, "csv")
    write_csv(df, path)
    return read_csv_text(df.sparkSession, path)


def csv_typed_scan(df: DataFrame) -> DataFrame:
    path = new_folder(df.sparkSession, "csv")
    write_csv(df, path)
    return read_csv_typed(df.sparkSession, path)


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, rows, non-NULL rows and distinct values per column.

    The counts are one aggregate; the distinct values are joined to them by position, so Spark leaves them out of a
    plan that does not read them.
    """
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.count(F.lit(1)).alias("rows"),
            F.count(F.col(f"`{name}`")).alias("non_null"),
        )
        for position, (name, kind) in enumerate(df.dtypes, start=1)
    ]
    counts = df.agg(F.array(*entries).alias("profile")).select(F.inline("profile"))
    values = F.coalesce("distinct_values", F.lit(0).cast("bigint")).alias("distinct_values")
    return counts.join(F.broadcast(distinct_values(df)), "position", "left").select(*counts.columns, values)


def distinct_values(df: DataFrame) -> DataFrame:
    """position and distinct_values of each column with values.

    Values of one type share a column, so a row of the shuffle holds a value for each type, not for each column. Equal
    values are dropped in the tasks, then spread by (column, value).
    """
    kinds = list(dict.fromkeys(kind for _, kind in df.dtypes))
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            *(F.col(f"`{name}`").alias(f"v{i}") if k == kind else F.lit(None).cast(k).alias(f"v{i}") for i, k in enumerate(kinds)),
        )
        for position, (name, kind) in enumerate(df.dtypes, start=1)
    ]
    held = df.select(F.inline(F.array(*entries)))
    present = reduce(Column.__or__, (F.col(f"v{i}").isNotNull() for i in range(len(kinds))))
    return held.where(present).distinct().groupBy("position").agg(F.count(F.lit(1)).alias("distinct_values"))


def csv_type_check(df: DataFrame) -> DataFrame:
    """Written and re-read types per column, with the non-NULL rows found in the files."""
    read = csv_typed_scan(df)
    written_types = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    profile = column_profile(read)
    return profile.select(
        "column_name",
        F.try_element_at(written_types, F.col("column_name")).alias("written_type"),
        F.col("data_type").alias("read_type"),
        "non_null",
    )


def one_file_csv(small: DataFrame) -> DataFrame:
    """A small report as a single CSV file, read back with the report's own schema."""
    path = new_folder(small.sparkSession, "report")
    write_csv(small, path, one_file=True)
    return read_csv_typed(small.sparkSession, path, small.schema)


def parquet_round_trip(df: DataFrame) -> DataFrame:
    path = new_folder(df.sparkSession, "parquet")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def json_round_trip(df: DataFrame) -> DataFrame:
    path = new_folder(df.sparkSession, "json")
    df.write.json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def text_round_trip(df: DataFrame, column: str) -> DataFrame:
    """One line per row, one file per partition."""
    path = new_folder(df.sparkSession, "text")
    df.select(F.col(column).cast("string").alias("value")).write.text(path)
    lines = df.sparkSession.read.text(path)
    return lines.select(F.col("value").cast(df.schema[column].dataType).alias(column))


def partitioned_table(df: DataFrame, column: str) -> DataFrame:
    """Parquet with one folder per value. The rebalance hint keeps the file count low and splits a
    value that holds most of the rows over several writers."""
    path = new_folder(df.sparkSession, "parts")
    df.hint("rebalance", column).write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partition_count(df: DataFrame, column: str) -> DataFrame:
    table = partitioned_table(df, column)
    return table.agg(F.count_distinct(column).alias("partitions"), F.count(F.lit(1)).alias("rows"))
