"""The numbered queries over the stored tables, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    chat,
    decontaminate,
    filter_audit,
    fingerprints,
    hard_negatives,
    jaccard,
    language,
    packing,
    quality,
    sharding,
    superminhash,
    token_counts,
    wavelet,
)
from tallyworks.llm.common import fold
from tallyworks.sources.tables import stored
from tallyworks.sources.workspace import new_folder, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CONTEXT = 2048  # tokens of a training sequence
SHARD_BYTES = 1 << 20  # of text in a shard


def op1_wavelet_shards(spark: SparkSession, data_dir: str) -> DataFrame:
    """Shards of wavelet matrices, written and read back: where each document's ids start and their crc32."""
    path = new_folder(spark, "shards")
    wavelet.write_shards(stored(spark, data_dir, "documents"), TOKENIZER, 2, path)
    digests = wavelet.read_documents(spark, path).select(
        "part",
        "seq",
        "doc_id",
        "within",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    placed = digests.join(wavelet.shard_starts(spark, path), ["part", "seq"])
    return placed.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def op2_chat(spark: SparkSession, data_dir: str) -> DataFrame:
    """Maximal conversations in the chat format."""
    return chat.chats(stored(spark, data_dir, "conversations"))


def op3_token_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Token counts of all documents through a cache that is new for this run."""
    docs = stored(spark, data_dir, "documents")
    return token_counts.token_counts(docs, TOKENIZER, new_folder(spark, "token-cache"), CONTEXT)


def op4_compression_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from labels outside the held-out third."""
    docs, labels = stored(spark, data_dir, "documents"), stored(spark, data_dir, "labels")
    model = quality.train(docs.select("doc_id", "text"), labels.where(fold("doc_id", 3) != 1))
    result = quality.scored(docs.select("doc_id", "text"), model)
    return result.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op5_ngram_jaccard(spark: SparkSession, data_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a similarity of 0.75 or more."""
    return jaccard.similar_groups(stored(spark, data_dir, "documents"), 75)


def op6_language(spark: SparkSession, data_dir: str) -> DataFrame:
    """Languages of all documents, learned from `lang` outside the held-out quarter."""
    docs = stored(spark, data_dir, "documents")
    model = language.train(docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    result = language.predicted(docs.select("doc_id", "text"), model)
    return result.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_benchmark_leaks(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents with benchmark items, and where."""
    return decontaminate.leaked(stored(spark, data_dir, "documents"), stored(spark, data_dir, "benchmark"))


def op8_imatch(spark: SparkSession, data_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprint_report(stored(spark, data_dir, "documents"))


def op9_extendible_shards(spark: SparkSession, data_dir: str) -> DataFrame:
    """The shard of every document, by extendible hashing of its id."""
    return sharding.shards(stored(spark, data_dir, "documents"), SHARD_BYTES)


def op10_best_fit_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    """All documents in as few sequences as dominance reduction and best fit find."""
    cut = packing.pieces(stored(spark, data_dir, "documents"), TOKENIZER, 0, CONTEXT)
    digests = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.pack(written(digests, "pieces"), CONTEXT)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_superminhash(spark: SparkSession, data_dir: str) -> DataFrame:
    """Components of documents whose 2-word shingle sets have a similarity of 0.80 or more."""
    return superminhash.near_duplicates(stored(spark, data_dir, "documents"), 80)


def op12_filter_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """What five filters remove, repeat and alone catch, by source, in every order and step."""
    return filter_audit.audit(stored(spark, data_dir, "documents"), stored(spark, data_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, data_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding; every seventh has its label moved on by one first."""
    rows = stored(spark, data_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_wavelet_shards,
        op2_chat,
        op3_token_counts,
        op4_compression_quality,
        op5_ngram_jaccard,
        op6_language,
        op7_benchmark_leaks,
        op8_imatch,
        op9_extendible_shards,
        op10_best_fit_packing,
        op11_superminhash,
        op12_filter_audit,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op2_chat": """
        with turns as (
            select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        ), placed as (
            select *, row_number() over w as position, count(*) over (partition by conv_id) as n_turns,
                string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '') over w as so_far
            from turns
            window w as (partition by conv_id order by turn nulls first, role, text rows unbounded preceding)
        ), whole as (
            select min(conv_id) as conv_id, n_turns, so_far from placed where position = n_turns group by all
        )
        select conv_id, 0::integer as part, n_turns, so_far as text
        from whole
        where not exists (
            select 1 from placed p
            where p.position < p.n_turns and p.position = whole.n_turns and p.so_far = whole.so_far
        )
    """,
    "op9_extendible_shards": f"""
        with hashed as (
            select doc_id, octet_length(encode(coalesce(text, '')))::bigint as n_bytes,
                ('0x' || left(md5(doc_id::varchar), 15))::bigint as hash
            from documents
        ), buckets as (
            select depth, hash >> (60 - depth) as prefix, sum(n_bytes)::bigint as shard_bytes
            from hashed, range(0, 61) t(depth)
            group by all
            having sum(n_bytes) <= {SHARD_BYTES} or min(hash) = max(hash)
        ), placed as (
            select doc_id, n_bytes, hash, min_by(depth, depth)::integer as depth, min_by(shard_bytes, depth) as shard_bytes
            from hashed, range(0, 61) t(depth) join buckets using (depth)
            where prefix = hash >> (60 - depth)
            group by doc_id, n_bytes, hash
        )
        select doc_id, n_bytes, case when depth = 0 then '' else lpad(bin(hash >> (60 - depth)), depth, '0') end as shard,
            0::integer as page, depth, shard_bytes
        from placed
    """,
    "op12_filter_audit": r"""
        with docs as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
                list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
            from documents
        ), firsts as (
            select text, min(doc_id) as least from docs group by text
        ), good as (
            select distinct doc_id from labels where quality = 1
        ), toxic as (
            select distinct doc_id from labels where toxic = 1
        ), facts as (
            select row_number() over () as row_id, part,
                list_filter(['A', 'B', 'C', 'D', 'E'], lambda c: case c
                    when 'A' then len(words) < 200
                    when 'B' then 100 * len(list_distinct(words)) < 50 * len(words)
                    when 'C' then 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)
                    when 'D' then regexp_matches(text, '[#$%&*|]')
                    else coalesce(doc_id > least, false) end) as failed,
                (good.doc_id is not null)::bigint as good, (toxic.doc_id is not null)::bigint as toxic
            from docs join firsts using (text) left join good using (doc_id) left join toxic using (doc_id)
        ), letters as (
            select unnest(['A', 'B', 'C', 'D', 'E']) as c
        ), orders as (
            select a.c || b.c || c.c || d.c || e.c as filter_order
            from letters a, letters b, letters c, letters d, letters e
            where len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
        ), placed as (
            select part, filter_order, failed, good, toxic, len(failed) as n_failed,
                coalesce(list_min(list_transform(failed, lambda c: instr(filter_order, c))), 6) as first_failed
            from facts, orders
        ), steps as (
            select part, filter_order, step::integer as step, substr(filter_order, step, 1) as letter,
                count(*) filter (first_failed > step) as kept,
                count(*) filter (first_failed = step) as removed,
                count(*) filter (list_contains(failed, substr(filter_order, step, 1)) and first_failed < step) as redundant,
                count(*) filter (list_contains(failed, substr(filter_order, step, 1)) and n_failed = 1) as unique_fails,
                coalesce(sum(good) filter (first_failed = step), 0)::bigint as good_lost,
                coalesce(sum(toxic) filter (first_failed = step), 0)::bigint as toxic_lost
            from placed, range(1, 6) t(step)
            group by part, filter_order, step
        )
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            sum(removed) over (partition by part, letter)::bigint as shapley
        from steps
    """,
    "op13_hard_negatives": """
        with valid as (
            select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
        ), scores as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
            from valid a join valid b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
        ), positives as (
            select anchor_id, vec_id as positive_id, score as positive_score
            from scores
            where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ), negatives as (
            select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank
            from positives join scores using (anchor_id)
            where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        )
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        from negatives
        where rank <= 3
    """,
}
