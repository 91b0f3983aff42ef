"""Word counts over lines or whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.workspace import spread

SEPARATORS = "[ \t\n\r\f]+"  # fixed value: the separators of the classic word count


def word_count(lines: DataFrame, text: str) -> DataFrame:
    """(word, n) over whole texts; equal words are combined in each task before the shuffle.

    Splitting is the costly part, so texts in a few unsplittable files are spread over the cores first.
    """
    texts = spread(lines.select(text))
    words = texts.select(F.explode(F.split(text, SEPARATORS)).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
