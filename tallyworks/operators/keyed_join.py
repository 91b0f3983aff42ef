"""Join of many rows with a table that has one row per key, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.workspace import written

FINENESS = 8  # slots of an n-th of the rows come in this many parts

SMALL_ROWS = 1_000_000  # rows of a few short values that may be broadcast


def small_table(stored: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """A stored table marked for broadcast if it has at most `limit` rows, else left to a shuffled join."""
    return F.broadcast(stored) if stored.limit(limit + 1).count() <= limit else stored


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    row_id: Column,
    how: str = "left",
) -> DataFrame:
    """`rows` joined (`left`, `inner` or `left_semi`) with `per_key` on `key`.

    `per_key[weight]` is the number of rows each key has in `rows`; it is not part of the result.
    With n = FINENESS times the shuffle partitions, a key is hot when it holds more than 1/n of all rows.
    Hot keys are fewer than n by counting alone, because their weights add up to at most the total, so
    broadcasting them is bounded at any data size. The rows of a hot key are spread over as many slots as
    it holds n-ths of all rows, by a hash of `row_id`, and the key's single row is repeated once per slot:
    no slot has more than about 1/n of the rows, so slots that meet in a task even out, and all slots
    together are fewer than 2 n. Each row still meets its key exactly once, so the result is the plain join.

    `per_key` is written once, because it is read four times and usually aggregates all the rows.
    """
    per_key = written(per_key, "per-key")
    n = FINENESS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = per_key.agg(F.sum(weight)).scalar()
    shares = F.col(weight) * n / total
    hot = F.broadcast(per_key.where(shares > 1).select(key, F.ceil(shares).cast("int").alias("_slots")))
    slots = F.coalesce("_slots", F.lit(1))

    spread = rows.withColumn("_row", row_id).join(hot, key, "left")
    spread = spread.withColumn("_slot", F.pmod(F.xxhash64("_row"), slots).cast("int")).drop("_row", "_slots")
    repeated = per_key.drop(weight).join(hot, key, "left")
    repeated = repeated.withColumn("_slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("_slots")
    return spread.join(repeated, [key, "_slot"], how).drop("_slot")
