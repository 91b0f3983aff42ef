"""Shards by extendible hashing: a bucket that is too large is split on the next bit of the hash.

DataFrame functions only. The directory is never collected; only two sums reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import bounded, placed_in_order, whole_text
from tallyworks.sources.workspace import written

HASH_BITS = 60
SLACK_BITS = 4  # the first directory is that much finer than shards of just the limit would need
STEP_BITS = 8


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the md5 of a key's text; a missing key has the text ''."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def prefix(depth: int) -> Column:
    """The first `depth` bits of the column _hash."""
    return F.shiftright("_hash", HASH_BITS - depth)


def local_depths(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """_cell (the first `depth` bits) and depth: that of the largest bucket around the cell that needs no split.

    A bucket needs none if its bytes fit, or if all its rows have one hash, which no bit can tell apart. Cells
    without such a bucket are left out. Rows are combined into cells first; a cell then counts for each depth.
    """
    cells = rows.groupBy(prefix(depth).alias("_cell")).agg(
        F.sum("n_bytes").alias("_bytes"), F.min("_hash").alias("_low"), F.max("_hash").alias("_high")
    )
    at = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("_depth")
    above = cells.select("*", at).withColumn("_bucket", F.expr(f"shiftright(_cell, {depth} - _depth)"))
    buckets = above.groupBy("_depth", "_bucket").agg(
        F.sum("_bytes").alias("shard_bytes"), F.min("_low").alias("_low"), F.max("_high").alias("_high")
    )
    fits = buckets.where((F.col("shard_bytes") <= limit) | (F.col("_low") == F.col("_high")))
    inner = above.select("_cell", "_depth", "_bucket").join(fits, ["_depth", "_bucket"])
    least = F.min(F.struct(F.col("_depth").alias("depth"), "shard_bytes"))
    return inner.groupBy("_cell").agg(least.alias("_bucket")).select("_cell", "_bucket.*")


def shards(docs: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, shard, page, depth and shard_bytes of every row of `docs` (doc_id, text).

    `shard` is the bit string of the row's bucket, `depth` bits of the hash of `key` and '' for the whole
    table; buckets of more than `limit` bytes of text have been split on one more bit, and only those. Rows
    with one and the same hash that do not fit go to overflow pages, numbered from 0, of as many rows as surely
    fit; a row larger than the limit has a page of its own. shard_bytes is that of all pages. Missing texts are
    empty.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(whole_text(docs)).cast("long").alias("n_bytes"),
        hash_bits(docs[key]).alias("_hash"),
    )
    rows = written(rows, "hashed")
    total = rows.agg(F.sum("n_bytes").alias("n")).collect()[0]["n"] or 0
    depth = min(HASH_BITS, SLACK_BITS + max(0, math.ceil(math.log2(max(1, total / limit)))))
    done = []
    while True:
        found = written(local_depths(rows, depth, limit), "directory")
        placed = rows.withColumn("_cell", prefix(depth)).join(found, "_cell", "left").drop("_cell")
        done.append(placed.where(F.col("depth").isNotNull()))
        if depth == HASH_BITS:
            break
        rest = placed.where(F.col("depth").isNull()).drop("depth", "shard_bytes")
        rows = written(rest, "unplaced")
        if rows.isEmpty():
            break
        depth = min(HASH_BITS, depth + STEP_BITS)
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr(f"lpad(bin(shiftright(_hash, {HASH_BITS} - depth)), depth, '0')"))
    placed = placed.withColumn("shard", bits)
    fits = F.col("shard_bytes") <= limit
    over = written(placed.where(~fits).withColumn("_row", F.monotonically_increasing_id()), "overflow")
    # A hash with very many rows, which is one id or none, is numbered range by range, not in one window.
    numbered = placed_in_order(over, ["_hash", "doc_id", "n_bytes", "_row"], ["_hash"], "_number")
    largest = bounded(written(over.groupBy("_hash").agg(F.max("n_bytes").alias("_largest")), "largest"))
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("_largest"))))
    paged = numbered.join(largest, "_hash").withColumn("page", F.floor(F.col("_number") / each).cast("int"))
    whole = placed.where(fits).withColumn("page", F.lit(0))
    columns = ["doc_id", "n_bytes", "shard", "page", "depth", "shard_bytes"]
    return whole.select(*columns).unionByName(paged.select(*columns))
