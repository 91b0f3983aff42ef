"""I-Match fingerprints: hashes of the informative terms of a text, one for each of several lexicons.

DataFrame functions only. The base lexicon holds the terms whose document frequency lies in a band; each
randomised lexicon is a random part of it. A fingerprint has a digest for each lexicon, so a small edit
changes only the digests of lexicons that hold an edited term.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text
from tallyworks.sources.workspace import written

LEAST_SHARE, MOST_SHARE = 0.0001, 0.3  # of all documents, two at least: also the words of a small language are in
RATES = (4, 4, 4, 4, 16, 16, 16, 16, 64, 64, 64, 64, 256, 256, 256, 256)  # lexicon i has one term in RATES[i]
BITS, MOST_BITS = 18, 23  # the bit set that holds the lexicon has 2^18 bits, more for more terms, 2^23 at most
BITS_A_TERM = 16
RANGES_A_SHARE = 2  # ranges that rows with one id get for each of the n-ths of all rows that they are


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased words of a text; words are runs of letters, marks and digits."""
    words = F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def places(term: Column, bits: Column) -> tuple[Column, Column]:
    """The two bits of so many, a power of two, that stand for a term."""
    mask = bits.cast("long") - 1
    return term.bitwiseAND(mask), F.shiftrightunsigned(term, 32).bitwiseAND(mask)


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> Column:
    """The terms in the band of inverse document frequency, as a constant array of 64-bit words.

    Frequencies are exact and over all documents. The band has ln(1 / most) <= idf <= ln(1 / least) and at
    least two documents. Only the bit set reaches the driver, 1 MiB at most; a term outside the band passes for a
    member if both its bits are set by others, alike for all texts.
    """
    texts = docs.select(whole_text(docs).alias("text"))
    total = texts.count()
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    band = counts.where((F.col("count") >= max(2, least * total)) & (F.col("count") <= most * total))
    band = written(band.select("term"), "band")
    wanted = (band.count() * BITS_A_TERM - 1).bit_length() if band.count() else 0
    size = 1 << min(MOST_BITS, max(BITS, wanted))
    bit = band.select(F.explode(F.array(*places(F.col("term"), F.lit(size)))).alias("bit"))
    bits = bit.select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits"))
    words = [0] * (size >> 6)
    for row in bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def digests(text: Column, bits: Column) -> tuple[Column, Column]:
    """The text's sorted distinct terms in the base lexicon, to be named _band, and from that column, for each
    randomised lexicon, the hash of those in it, '' if there are none."""

    def is_set(place: Column) -> Column:
        return F.getbit(F.get(bits, F.shiftright(place, 6).cast("int")), place.bitwiseAND(63).cast("int")) == 1

    def member(term: Column) -> Column:
        one, two = places(term, F.size(bits) * 64)
        return is_set(one) & is_set(two)

    def digest(i: int, rate: int) -> Column:
        own = F.filter("_band", lambda t: F.xxhash64(t, F.lit(i)).bitwiseAND(rate - 1) == 0)
        return F.when(F.size(own) == 0, "").otherwise(F.lpad(F.hex(F.xxhash64(own)), 16, "0"))

    band = F.array_sort(F.filter(terms(text), member))
    return band, F.array(*(digest(i, rate) for i, rate in enumerate(RATES)))


def with_fingerprint(df: DataFrame, text: str, bits: Column, name: str) -> DataFrame:
    """`df` with the column `name`: the digests of its column `text`, joined by '-'.

    The last part is empty, or a hash of the whole text if no randomised lexicon has a term of it: such texts are
    like their copies only.
    """
    band, parts = digests(F.col(text), bits)
    said = df.withColumn("_band", band).withColumn("_said", F.array_join(parts, "-"))
    nothing = F.col("_said") == "-" * (len(RATES) - 1)
    exact = F.when(nothing, F.lpad(F.hex(F.xxhash64(text)), 16, "0")).otherwise("")
    return said.withColumn(name, F.concat("_said", F.lit("-"), exact)).drop("_band", "_said")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal digests among the lexicons that have a term of either text; 1 for equal fingerprints."""
    pairs = F.zip_with(F.split(a, "-"), F.split(b, "-"), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    said = F.filter(pairs, lambda p: (p["x"] != "") | (p["y"] != ""))
    equal = F.size(F.filter(said, lambda p: p["x"] == p["y"]))
    return F.when(a == b, 1.0).when(F.size(said) == 0, 0.0).otherwise(equal / F.size(said))


def beginning(text: Column) -> Column:
    """The first six bytes of a text as a number, which a double holds; of two texts, the smaller has no larger one."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(text, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("long")


Bounds = list[tuple[int | None, int | None]]  # doc_id and beginning of the text; missing values come first


def rough_bounds(docs: DataFrame, n: int) -> Bounds:
    """Ids at about each n-th of the rows (doc_id, _begins), and for an id, or none, with more than an n-th of them also
    beginnings of texts: fewer than 4 n, not always of the table."""
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 100 * n).alias("b"), F.count(F.lit(1)).alias("n")).first()
    bounds = {(b, None) for b in found["b"] or []}
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") * n > found["n"])
    hot = [r["doc_id"] for r in counts.select("doc_id").collect()]  # fewer than n
    if hot:
        own = docs.where(F.col("doc_id").isin([h for h in hot if h is not None]) | (F.col("doc_id").isNull() & F.lit(None in hot)))
        parts = [i / (RANGES_A_SHARE * n) for i in range(1, RANGES_A_SHARE * n)]
        inner = own.groupBy("doc_id").agg(F.percentile_approx("_begins", parts, 100 * n).alias("b"), F.count(F.lit(1)).alias("rows"))
        for row in inner.collect():
            step = max(1, found["n"] // row["rows"])  # so that a range has about 1 / (2 n) of all rows
            bounds |= {(row["doc_id"], b) for b in [None, *row["b"][step - 1 :: step]]}
    return sorted(bounds, key=lambda b: tuple((x is not None, x) for x in b))


def block_of(bounds: Bounds) -> tuple[Column, Column]:
    """How many of the bounds are not above a row (doc_id, _begins), and the bounds as a constant array."""
    step = max(1, int(len(bounds) ** 0.5))

    def listed(some: Bounds) -> Column:
        return F.from_json(F.lit(json.dumps([{"id": i, "p": p} for i, p in some])), "array<struct<id:bigint,p:bigint>>")

    place = F.struct(F.col("doc_id").alias("id"), F.col("_begins").alias("p"))
    below = lambda places: F.size(F.filter(places, lambda b: b <= place))
    coarse = below(listed(bounds[step - 1 :: step])) * step  # bounds[: coarse] are not above the row
    return coarse + below(F.slice(listed(bounds), coarse + 1, step)), listed(bounds)


def range_bounds(docs: DataFrame, n: int) -> Bounds:
    """The first place of every range of rows but the first range, in the order of doc_id and text: fewer than 4 n."""
    places = docs.select("doc_id", beginning(F.col("text")).alias("_begins"))
    block, _ = block_of(rough_bounds(places, n))
    first = places.groupBy(block.alias("block")).agg(F.min(F.struct("doc_id", "_begins")).alias("b"))
    found = sorted((r["block"], r["b"]["doc_id"], r["b"]["_begins"]) for r in first.select("block", "b").collect())
    return [(i, p) for _, i, p in found[1:]]


def with_next(docs: DataFrame, columns: list[str], first_row: DataFrame) -> DataFrame:
    """`docs` (doc_id, text and others) with next_<c> for each of `columns`: that of the next row by doc_id and
    text; the last row is followed by the first, which `first_row` holds.

    Rows are dealt to ranges. The first rows of each range also go to the range before, where they only serve as the
    next row, so a text is shuffled once. An id with many rows, or none, has several ranges, cut by the text.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block, bounds = block_of(range_bounds(docs, n))
    bound = F.get(bounds, F.col("_block") - 1)
    first = (F.col("_block") > 0) & F.col("doc_id").eqNullSafe(bound["id"]) & (F.col("_begins") == bound["p"])
    ranges = F.when(first, F.array(F.col("_block"), F.col("_block") - 1)).otherwise(F.array("_block"))
    dealt = docs.withColumn("_begins", beginning(F.col("text"))).withColumn("_block", block)
    dealt = dealt.withColumn("_range", F.explode(ranges)).drop("_begins")
    order = Window.partitionBy("_range").orderBy("doc_id", "text")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    start = written(first_row.select(*columns), "first")
    rows = dealt.select("*", *following).where(F.col("_range") == F.col("_block")).drop("_range", "_block")
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.coalesce(f"next_{c}", start.select(c).scalar()))
    return rows


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """The fingerprint of every row of `docs` (doc_id, text), and how it takes an edit.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or all, of the
    next row's text. Missing texts are empty; an empty text is like empty ones only. Missing ids
    come first; rows with the same id follow each other by text.
    """
    bits = lexicon(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    least = written(texts.agg(F.min(F.struct("doc_id", "text")).alias("_row")).select("_row.*"), "first-row")
    first = with_fingerprint(least, "text", bits, "fingerprint")
    rows = with_next(with_fingerprint(texts, "text", bits, "fingerprint"), ["text", "fingerprint"], first)
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = with_fingerprint(rows.withColumn("edited", edited), "edited", bits, "edited_fingerprint")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
