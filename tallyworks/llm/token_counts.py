"""Token counts through a cache of digests: only texts nobody has counted yet are encoded."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import join_hot, whole_text
from tallyworks.llm.encoding import by_word, encoder, runs
from tallyworks.llm.workers import lean
from tallyworks.sources.workspace import written

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of a tokenizer's file and of the library version that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    return hashlib.sha256(Path(path).read_bytes() + f"{library} {version(library)}".encode()).hexdigest()


def normalised(text: Column, tokenizer: str) -> Column:
    """The text without differences that cannot change its number of tokens: runs of white space, if the
    tokenizer drops it anyway. For other tokenizers the text itself."""
    if tokenizer.endswith(".json") and by_word(json.loads(Path(tokenizer).read_text())):
        return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    return text


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Counts of one tokenizer: content, n_tokens; one row per content, also after parallel appends."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(path)
    rows = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == tokenizer_digest(tokenizer))
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def extend_cache(docs: DataFrame, tokenizer: str, cache: str) -> None:
    """Encode each distinct normalised text of `docs` that the cache lacks, once, and append its count.

    Copies are combined before the shuffle, so a text that a third of all rows share is sent once per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for batch in batches:
            for first, n in runs(batch["text"]):
                _, counts = code.encode(batch["text"].slice(first, n), ids=False)
                yield pa.RecordBatch.from_arrays(
                    [batch["content"].slice(first, n), pa.array([version] * n), pa.array(counts)],
                    ["content", "tokenizer", "n_tokens"],
                )

    version = tokenizer_digest(tokenizer)
    text = normalised(whole_text(docs), tokenizer)
    texts = docs.select(F.unhex(F.sha2(text, 256)).alias("content"), text.alias("text"))
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    known = read_cache(docs.sparkSession, cache, tokenizer).select("content")
    misses = distinct.join(known, "content", "left_anti")
    misses.mapInArrow(lean(count, encodes=True), CACHE_SCHEMA).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of `docs` (doc_id, text).

    `tokenizer` is a file of the tokenizers (.json) or sentencepiece (.model) library; no special tokens are
    added. `cache` is a folder that lives on between runs; it is extended by what `docs` lacks. Missing texts
    are empty; repeated rows and missing ids give a row each.
    """
    extend_cache(docs, tokenizer, cache)
    text = whole_text(docs)
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(normalised(text, tokenizer), 256)).alias("content"),
    )
    counted = join_hot(written(keyed, "digests"), read_cache(docs.sparkSession, cache, tokenizer), "content")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
