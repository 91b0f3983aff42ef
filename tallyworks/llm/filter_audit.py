"""How filters interact: what each removes, repeats or alone catches, in every order of applying them.

1. One pass over the texts gives each row a mask, a bit for each filter that it fails. Copies are known by a
   SHA-256 digest of the text, so no text is shuffled.
2. Masks are counted for each part: the cells. From here on the work does not depend on the number of documents.
3. A recursive common table expression extends prefixes of filter orders by unused letters, carries the bits
   applied so far, and emits at each level what the step does with each mask.
4. The cells' counts, joined with that by mask, are the metrics of every prefix, and orders look theirs up.
"""

from __future__ import annotations

from collections.abc import Callable
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyworks.llm.common import join_hot, whole_text
from tallyworks.sources.workspace import written

COPY = "E"  # the letter of the filter on copies, which looks at the whole table
MOST_FILTERS = 6  # n filters have n! orders, e n! prefixes and 2^n masks


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Letter and failure condition of the filters that see one text and its words."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": n < 200,
        "B": 100 * distinct < 50 * n,
        "C": 100 * capitals > 2 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masked(docs: DataFrame, filters: Callable[[Column, Column], dict[str, Column]]) -> tuple[DataFrame, list[str]]:
    """doc_id, part (source, a missing one as the empty string), digest and mask of every row, and the letters."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        whole_text(docs).alias("text"),
    )
    texts = texts.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    fails = filters(F.col("text"), F.col("words"))
    bits = [F.when(failed, F.lit(1 << i)).otherwise(0) for i, failed in enumerate(fails.values())]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    return texts.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask")), list(fails)


def flags(labels: DataFrame) -> DataFrame:
    """doc_id with good and toxic, 0 or 1, of the documents that any label calls so."""
    said = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"_{c}")
    by_doc = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    found = by_doc.agg(said("quality"), said("toxic")).where("_quality + _toxic > 0")
    return found.withColumnsRenamed({"_quality": "good", "_toxic": "toxic"})


def mask_cells(docs: DataFrame, labels: DataFrame, filters=text_filters) -> tuple[DataFrame, list[str]]:
    """part, mask, n, good and toxic: how many rows of a part fail which filters, that on copies included; and the
    letters. A row is a copy if the table has its text under a smaller doc_id.

    Equal rows are combined before any join, copies of a text in one part right after it, so neither a hot id nor
    a text with very many copies meets in one task.
    """
    facts, letters = masked(docs, filters)
    rows = facts.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = written(rows, "masked")
    known = join_hot(rows.where("doc_id is not null"), written(flags(labels), "flags"), "doc_id")
    nothing = rows.where("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    counts = ["n", "good", "toxic"]
    weighed = [F.col("n"), *(F.col("n") * F.coalesce(c, F.lit(0)) for c in counts[1:])]
    counted = known.unionByName(nothing).select("doc_id", "part", "digest", "mask", *(w.alias(c) for w, c in zip(weighed, counts, strict=True)))
    texts = counted.groupBy("digest", "part", "mask").agg(
        *(F.sum(c).alias(c) for c in counts),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *counts))).alias("first"),  # rows of the smallest id
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
    )
    texts = written(texts.withColumn("own", F.col("first.doc_id")), "texts")
    spread = texts.groupBy("digest").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("parts"))
    least = written(spread.where("parts > 1").select("digest", "least"), "least")
    placed = join_hot(texts, least, "digest").withColumn("is_first", F.col("own") == F.coalesce("least", "own"))
    passing = {c: F.when(F.col("is_first"), F.col(f"first.{c}")).otherwise(0) for c in counts}
    passing["n"] = passing["n"] + F.col("unnamed")
    copy = 1 << len(letters)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), *(passing[c].alias(c) for c in counts)),
        F.struct((F.col("mask") + copy).alias("mask"), *((F.col(c) - passing[c]).alias(c) for c in counts)),
    )
    cells = placed.select("part", F.explode(both).alias("cell")).select("part", "cell.*").where("n > 0")
    return cells.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in counts)), [*letters, COPY]


def prefix_steps(masks: DataFrame, letters: list[str]) -> DataFrame:
    """Every prefix of every order of the letters with every mask: prefix, step, letter, mask, and what that step does
    with a row of that mask, as 0 or 1: kept, removed, redundant (failing, removed before), unique_fails.

    The recursion's size depends on the number of letters alone: at most 2^n masks for each prefix. So it stays in
    one partition, and the letters and masks that each level joins are sent to it whole.
    """
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"{len(letters)} filters; at most {MOST_FILTERS} can be audited in all orders")
    spark = masks.sparkSession
    bits = spark.createDataFrame([(c, 1 << i) for i, c in enumerate(letters)], "letter string, bit int")
    return spark.sql(
        """
        with recursive walk (prefix, step, letter, applied, mask, kept, removed, redundant, unique_fails) as (
            select '', 0, '', 0, cast(mask as int), 1, 0, 0, 0 from {masks}
            union all
            select /*+ broadcast(bits, cells) */ concat(walk.prefix, bits.letter), walk.step + 1, bits.letter, walk.applied | bits.bit, cells.mask,
                if(cells.mask & (walk.applied | bits.bit) = 0, 1, 0),
                if(cells.mask & walk.applied = 0 and cells.mask & bits.bit != 0, 1, 0),
                if(cells.mask & walk.applied != 0 and cells.mask & bits.bit != 0, 1, 0),
                if(cells.mask = bits.bit, 1, 0)
            from walk
            join {bits} bits on walk.applied & bits.bit = 0
            join {masks} cells on cells.mask = walk.mask
        )
        select prefix, step, letter, mask, kept, removed, redundant, unique_fails from walk where step > 0
        """,
        masks=masks,
        bits=bits,
    )


def audit(docs: DataFrame, labels: DataFrame, filters=text_filters) -> DataFrame:
    """A row for each part, filter_order (all orders of the letters) and step, with the documents of the part that are
    kept after the step, removed by it, redundant (failing its filter, removed before), unique_fails (failing its
    filter only), good_lost and toxic_lost (removed by it, with that label), and shapley: what its filter removes,
    summed over all orders.

    `docs` has doc_id, text and source, `labels` doc_id, quality and toxic; other columns are ignored. A missing
    text is empty, a missing source the part ''. A missing doc_id is a document like others, without labels; it is
    not a copy and has none, since it is not smaller or larger than any. Repeated rows count each, and are no copies
    of each other. Of several labels of an id any that says so counts. An empty table gives no rows.
    """
    counted, letters = mask_cells(docs, labels, filters)
    cells = written(counted, "cells")
    masks = written(cells.select("mask").distinct().coalesce(1), "masks")  # at most 2^n
    steps = written(prefix_steps(masks, letters), "prefix-steps")
    told = ["kept", "removed", "redundant", "unique_fails"]
    sums = [F.sum(F.col("n") * F.col(c)).alias(c) for c in told]
    sums += [F.sum(F.col(c) * F.col("removed")).alias(f"{c}_lost") for c in ("good", "toxic")]
    joined = cells.join(F.broadcast(steps), "mask")  # at most 2^n masks for each of e n! prefixes
    prefixes = joined.groupBy("part", "prefix", "step", "letter").agg(*sums)
    orders_below = F.element_at(F.array(*(F.lit(factorial(len(letters) - k)).cast("long") for k in range(1, len(letters) + 1))), F.col("step"))
    of_letter = Window.partitionBy("part", "letter")
    prefixes = prefixes.withColumn("shapley", F.sum(F.col("removed") * orders_below).over(of_letter))
    orders = steps.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    begun = F.explode(F.transform(F.sequence(F.lit(1), F.lit(len(letters))), lambda k: F.col("filter_order").substr(F.lit(1), k)))
    looked_up = orders.select("filter_order", begun.alias("prefix"))
    return prefixes.join(F.broadcast(looked_up), "prefix").select(
        "part", "filter_order", "step", *told, "good_lost", "toxic_lost", "shapley"
    )
