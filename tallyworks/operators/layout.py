"""A bucketed layout of many rows by key: statistics per key and their join back need no exchange of the rows.

The rows are shuffled once, when the layout is written. A key that holds more than its share is stored under several
slots, so that no bucket holds more than a few shares; per-key statistics are combined from the slots' partial ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.keyed_join import FINENESS
from tallyworks.sources.workspace import new_folder, written

SLOT = "_slot"


@dataclass
class Layout:
    """A stored table bucketed and sorted by (key, slot), and the slots of the keys that have several."""

    table: DataFrame
    key: str
    slots: DataFrame  # key and _slots, fewer than FINENESS times the number of buckets

    def statistics(self, partial: list[Column], whole: list[Column]) -> DataFrame:
        """One row per key: `partial` aggregates of its slots, combined by `whole`. Only the slots' rows are shuffled."""
        return self.table.groupBy(self.key, SLOT).agg(*partial).groupBy(self.key).agg(*whole)

    def join_back(self, per_key: DataFrame, how: str = "left") -> DataFrame:
        """The rows with the columns of `per_key`, which has at most one row a key. It is repeated once per slot and
        shuffled to the buckets; the rows stay where they are."""
        slots = F.coalesce("_slots", F.lit(1))
        repeated = per_key.join(F.broadcast(self.slots), self.key, "left")
        repeated = repeated.withColumn(SLOT, F.explode(F.sequence(F.lit(0), slots - 1))).drop("_slots")
        return self.table.join(repeated.hint("merge"), [self.key, SLOT], how).drop(SLOT)


def write_layout(rows: DataFrame, key: str, row_id: Callable[[], Column], buckets: int | None = None) -> Layout:
    """Store the rows bucketed by `key`, one file a bucket, sorted by it.

    A key with more than 1/n of the rows, n being FINENESS times the buckets, gets as many slots as it holds n-ths, and
    its rows are dealt to them by a hash of `row_id`. Rows without a key, which meet nothing in a join, have all n.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = FINENESS * buckets
    weights = written(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), "weights")
    shares = F.col("_rows") * n / weights.agg(F.sum("_rows")).scalar()
    slots = written(weights.where(shares > 1).select(key, F.ceil(shares).cast("int").alias("_slots")), "slots")
    spread = rows.withColumn("_row", row_id()).join(F.broadcast(slots), key, "left")  # fewer than n keys, by counting
    several = F.when(F.col(key).isNull(), F.lit(n)).otherwise(F.coalesce("_slots", F.lit(1)))
    slot = F.pmod(F.xxhash64("_row"), several).cast("int")
    spread = spread.withColumn(SLOT, slot).drop("_row", "_slots").repartition(buckets, key, SLOT)
    name = f"layout_{uuid.uuid4().hex}"
    writer = spread.write.bucketBy(buckets, key, SLOT).sortBy(key, SLOT).option("path", new_folder(spark, "layout"))
    writer.format("parquet").saveAsTable(name)
    return Layout(spark.table(name), key, slots)
