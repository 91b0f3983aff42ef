"""Connected components: of the links of one task by union-find, of a stored graph by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.workspace import released, written


class UnionFind:
    """Components of nodes named by whole numbers; joins that connected nothing new are not links."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        top = x
        while (above := self.up.get(top, top)) != top:
            top = above
        while (above := self.up.get(x, x)) != top:
            self.up[x], x = top, above
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def spanning(pairs: np.ndarray) -> np.ndarray:
    """The pairs (rows of two nodes) without those that connect nothing new."""
    if not len(pairs):
        return pairs
    found, pairs = UnionFind(), np.unique(pairs, axis=0)
    return pairs[[found.join(a, b) for a, b in pairs.tolist()]]


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) of every node of `edges` (a, b: long).

    Each round hangs a node's larger neighbours, then its smaller ones, on the smallest node it knows; the
    number of rounds follows the logarithm of the longest path. Rounds are cut by written tables, which also
    makes them repeatable after a loss. Nothing but one number a round reaches the driver.
    """
    a, b = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    links = written(edges.where("a != b").select(b, a).distinct(), "links")  # from the larger to the smaller node
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(least, "a")
        hung = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = down.select(F.explode(hung).alias("e"))
        small = written(small.select("e.*").where("a != b").distinct(), "small-star")
        both_ways = small.withColumn("_in", F.lit(1)).unionByName(links.select("a", "b").withColumn("_in", F.lit(-1)))
        changed = both_ways.groupBy("a", "b").agg(F.sum("_in").alias("_d")).where("_d != 0").limit(1).count()
        links = small
        released(edges.sparkSession)
        if not changed:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
