"""Splits of a frame into named parts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.switching import switched


def seeded_parts(stored: DataFrame, shares: dict[str, float], seed: int) -> dict[str, DataFrame]:
    """Random parts of a frame read from files.

    A split is repeatable only if its input is: the parts are drawn in separate passes over the
    input, and over a recomputed shuffle rows could move between them or be lost.
    """
    parts = stored.randomSplit(list(shares.values()), seed=seed)
    return dict(zip(shares, parts, strict=True))


def part_of(keys: list[str], shares: dict[str, float], seed: int) -> Column:
    """The part that rows with these key values fall into, whatever the machine, the files or the rest."""
    place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000))
    names, bound, part = list(shares), 0.0, None
    for name in names[:-1]:
        bound += shares[name]
        inside = place < round(bound * 1_000_000)
        part = F.when(inside, name) if part is None else part.when(inside, name)
    return F.lit(names[0]) if part is None else part.otherwise(names[-1])


def content_parts(df: DataFrame, shares: dict[str, float], seed: int, keys: list[str] | None = None) -> dict[str, DataFrame]:
    """Parts drawn by a seeded hash of the keys (all columns without any); equal rows stay together."""
    part = part_of(keys or df.columns, shares, seed)
    return {name: df.where(part == name) for name in shares}


def write_split(df: DataFrame, target: str, shares: dict[str, float], seed: int, key: str, replace: bool = False) -> dict[str, str]:
    """Write the parts as Parquet to `target/part=<name>` in one pass over the frame, without a copy of it.

    Rows with the same key are in the same part. An existing target is an error unless it is to be
    replaced, and stays as it is until the new files are complete.
    """
    parted = df.withColumn("part", part_of([key], shares, seed))
    with switched(df.sparkSession, target, replace) as place:
        parted.write.partitionBy("part").parquet(place)
    return {name: f"{target.rstrip('/')}/part={name}" for name in shares}


def hash_split(df: DataFrame, key: str, train_percent: int = 75) -> DataFrame:
    """Every row with the part its key always falls into, whatever the run or the engine."""
    slot = (F.col(key) % 100 * 7919) % 100  # reduced first, large keys cannot overflow
    return df.withColumn("part", F.when(slot < train_percent, "train").otherwise("test"))


def split_report(whole: DataFrame, parts: dict[str, DataFrame], shares: dict[str, float], key: str) -> DataFrame:
    """One row: how many keys the split lost or put into more than one part, and whether the sizes
    are within five standard deviations of the shares."""
    names = list(parts)
    tagged = [part.select(key, F.lit(name).alias("part")) for name, part in parts.items()]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    counts = union.groupBy(key).pivot("part", names).count().na.fill(0, names)
    drawn = sum((F.col(name) for name in names[1:]), F.col(names[0]))
    per_key = whole.select(key).join(counts, key, "left")
    total = F.count(F.lit(1))

    def near(name: str):
        share = shares[name]
        slack = 5 * math.sqrt(share * (1 - share))
        return F.abs(F.sum(F.coalesce(name, F.lit(0))) - share * total) <= slack * F.sqrt(total)

    sized = near(names[0])
    for name in names[1:]:
        sized = sized & near(name)
    return per_key.agg(
        total.alias("keys"),
        F.count_if(F.coalesce(drawn, F.lit(0)) == 0).alias("lost"),
        F.count_if(drawn > 1).alias("repeated"),
        sized.alias("sizes_as_asked"),
    )
