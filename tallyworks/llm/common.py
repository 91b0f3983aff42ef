"""Small helpers that several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyworks.sources.workspace import written

BROADCAST_ROWS = 1_000_000  # rows of a few numbers each; larger tables are joined by a shuffle


def whole_text(docs: DataFrame) -> Column:
    """The text of a document, a missing one read as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id's decimal digits modulo `parts`; a missing id belongs to no fold (NULL)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % parts


def bounded(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table marked for broadcast if it has at most `limit` rows, else left to a shuffle join."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def join_hot(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """`rows` joined with a table of at most one row per key, safe when few keys hold most rows.

    A key is hot when it has more than 1/n of all rows, n the number of shuffle partitions, so there are
    fewer than n hot keys whatever the data; their rows of `table` are broadcast and their part of `rows`
    is not shuffled. `rows` and `table` must be stored, since both are read twice.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = [r[0] for r in counts.where((F.col("_rows") * n > total) & F.col(key).isNotNull()).select(key).collect()]
    if not hot:
        return rows.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold = rows.where(~is_hot).join(table.where(~is_hot), key, how)
    return cold.unionByName(rows.where(is_hot).join(F.broadcast(table.where(is_hot)), key, how))


def with_fields(df: DataFrame, **types: str) -> StructType:
    """The schema of `df` with more columns, each given by the name of its type."""
    return StructType([*df.schema.fields, *(StructField(c, StructType.fromDDL(f"x {t}")["x"].dataType) for c, t in types.items())])


def free_name(df: DataFrame, name: str) -> str:
    """The name, made longer until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """The two agree in the columns, of which `b` has copies that end in _; missing values agree too."""
    equal = [a[c].eqNullSafe(b[f"{c}_"]) for c in columns]
    return reduce(Column.__and__, equal)


def marked(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_" for c in columns})


def placed_in_order(rows: DataFrame, order: list[str], group: list[str], name: str) -> DataFrame:
    """The rows with `name`: how many rows of their group come before them in the given order, which begins with the
    group's columns, and `of_group`, the number of rows in it.

    All rows are dealt to ranges of that order and sorted there. Ranges of a group only exchange their sizes, so a
    large one is spread over tasks.
    """
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "ordered")  # range, then place in it
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    sizes = rows.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    running, whole = Window.partitionBy(*group).orderBy("_range"), Window.partitionBy(*group)
    sizes = sizes.select(
        *group,
        "_range",
        (F.sum("_n").over(running) - F.col("_n") - F.col("_first")).alias("_before"),
        F.sum("_n").over(whole).alias("of_group"),
    )
    sizes = marked(sizes, *group, "_range")
    found = rows.join(sizes, same(rows, sizes, *group, "_range"))
    return found.select(*(rows[c] for c in rows.columns if c not in ("_at", "_range")), (F.col("_before") + F.col("_at")).alias(name), "of_group")
