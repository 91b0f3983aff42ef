from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyworks.llm import packing, token_counts, wavelet
from tallyworks.llm.encoding import WordEncoder, encoder
from tallyworks.llm.queries import CONTEXT, QUERIES, TOKENIZER
from tallyworks.sources.workspace import new_folder, written

LIBRARY = Tokenizer.from_file(TOKENIZER)
ODD = [
    None,
    "",
    " \n\t ",
    "It's ÉTÉ, naïve; İstanbul ΣΑΣ 12345 ١٢ don't!!",
    "é x́y <|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "\x0b\x0c\x1c\x85 　x y",
    "word " * 30_000,
    "a b",
    "a  b ",
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def table(spark, texts):
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, None), (3, "again", 2, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, part string")


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_words_give_the_ids_of_whole_texts(texts):
    code = encoder(TOKENIZER)
    assert isinstance(code, WordEncoder)
    ids, counts = code.encode(pa.array(texts, pa.string()))
    expected = [ids_of(t) for t in texts]
    assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])


def test_odd_texts():
    texts = [t or "" for t in ODD]
    ids, counts = encoder(TOKENIZER).encode(pa.array(texts))
    assert ids.tolist() == sum((ids_of(t) for t in texts), []) and counts.sum() == len(ids)


class Asked:
    """A model that notes which words it is asked for."""

    def __init__(self, model):
        self.model, self.words = model, []

    def tokenize(self, word):
        self.words.append(word)
        return self.model.tokenize(word)


def test_frequent_words_are_encoded_once():
    code = WordEncoder(LIBRARY, 100)
    code.model = Asked(LIBRARY.model)
    for i in range(40):
        rare = " ".join("".join(chr(97 + int(d)) for d in f"{n:04}") for n in range(10 * i, 10 * i + 10))
        texts = ["" if i % 3 == 2 else "Alpha alpha, ALPHA; Beta beta. gamma", rare]
        ids, counts = code.encode(pa.array(texts), end=0)
        expected = [[*ids_of(t), 0] for t in texts]
        assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])
    assert all(sum(w.startswith(known) for w in code.model.words) == 1 for known in ("alpha", "beta", "gamma"))


def test_every_plain_letter_and_mark():
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [*letters, *(f"{a}{b}x" for a in letters for b in "aZéÖ"), *(f"Word{a}{b}" for a in marks for b in marks)]
    code = WordEncoder(LIBRARY, 1000)
    for _ in range(2):  # the second time from the memo, as far as it goes
        ids, counts = code.encode(pa.array(texts))
        expected = [ids_of(t) for t in texts]
        assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_count_text_by_text(spark, name):
    path = public_tokenizers.path(name)
    docs = table(spark, ["", "a  b", "Größe 12"])
    rows = token_counts.token_counts(docs, path, new_folder(spark, "cache"), 2).collect()
    _, counts = encoder(path).encode(pa.array([r["text"] or "" for r in docs.collect()]))
    assert sorted(r["n_tokens"] for r in rows) == sorted(counts.tolist())


def test_token_counts_and_cache(spark):
    docs, cache = table(spark, ODD), new_folder(spark, "cache")
    expected = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(ids_of(r["text"]))) for r in docs.collect())
    for _ in range(2):
        rows = token_counts.token_counts(docs, TOKENIZER, cache, 10).collect()
        assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in rows) == expected
        assert all(r["over_limit"] == (r["n_tokens"] > 10) for r in rows)
        stored = spark.read.parquet(cache)
        # None, "" and blanks share a digest, so do "a b" and "a  b ": the second run adds nothing
        assert stored.count() == len(ODD) - 3 + 2
    assert token_counts.token_counts(docs.limit(0), TOKENIZER, cache, 10).count() == 0


def test_hot_text_is_joined_once_per_row(spark):
    docs = spark.range(1000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same', cast(id as string)) as text")
    rows = token_counts.token_counts(docs, TOKENIZER, new_folder(spark, "cache"), 1).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) == 1000
    assert all(r["n_tokens"] == len(ids_of(str(r["doc_id"]) if r["doc_id"] % 3 else "the same")) for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=400), st.integers(0, 70))
def test_wavelet_matrix(values, token):
    ids = np.array(values, np.uint32) * 700
    matrix = wavelet.WaveletMatrix(wavelet.WaveletMatrix.build(ids))
    assert matrix.decode().tolist() == ids.tolist()
    where = np.flatnonzero(ids == token * 700).tolist()
    assert matrix.count(token * 700) == len(where)
    assert [matrix.find(token * 700, k) for k in range(len(where) + 1)] == [*where, -1]
    for position in range(0, len(ids), 7):
        assert matrix.access(position) == ids[position]
        assert matrix.count(token * 700, position // 2, position) == sum(position // 2 <= w < position for w in where)


def test_wavelet_matrix_over_several_blocks():
    ids = np.random.default_rng(1).integers(0, 5000, 200_000).astype(np.uint32) ** 2 // 5000
    matrix = wavelet.WaveletMatrix(wavelet.WaveletMatrix.build(ids))
    assert (matrix.decode() == ids).all()
    where = np.flatnonzero(ids == 4)
    assert matrix.count(4) == len(where) and matrix.find(4, len(where) - 1) == where[-1]
    assert [matrix.access(p) for p in (0, 65_535, 65_536, 199_999)] == ids[[0, 65_535, 65_536, 199_999]].tolist()


def holds(ids):
    """Whether decoding, access, counting and lookup agree with the plain sequence."""
    matrix = wavelet.WaveletMatrix(wavelet.WaveletMatrix.build(ids))
    assert matrix.decode().tolist() == ids.tolist()
    for position in range(0, len(ids), 1 + len(ids) // 40):
        assert matrix.access(position) == ids[position]
    for token in np.unique(ids)[:: 1 + len(np.unique(ids)) // 10].tolist():
        where = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(where)
        assert matrix.count(token, len(ids) // 3, len(ids)) == int((where >= len(ids) // 3).sum())
        assert [matrix.find(token, k) for k in (0, len(where) - 1, len(where))] == [where[0], where[-1], -1]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 1 << 32), st.integers(500, 5000), st.sampled_from([0.3, 0.1, 0.02, 0.004]))
def test_wavelet_matrix_of_skewed_sequences(seed, n, p):
    holds(np.random.default_rng(seed).geometric(p, n).astype(np.uint32))


def test_block_that_is_as_long_compressed_as_raw():
    ids, ties = np.random.default_rng(7), 0
    ids = ids.geometric(0.02, int(ids.integers(600, 1500))).astype(np.uint32)
    current = np.searchsorted(np.unique(ids), ids)
    for level in reversed(range(int(current.max()).bit_length())):
        bits = (current >> level & 1).astype(bool)
        block = np.packbits(bits).tobytes()
        ties += len(zstandard.ZstdCompressor(level=1).compress(block)) == len(block)
        current = np.concatenate([current[~bits], current[bits]])
    assert ties  # else the sequence does not try what it should
    holds(ids)


def test_shards_of_an_empty_table_and_of_one_hot_id(spark):
    path = new_folder(spark, "shards")
    wavelet.write_shards(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER, 2, path)
    assert wavelet.read_documents(spark, path).count() == 0 and wavelet.shard_starts(spark, path).count() == 0
    path = new_folder(spark, "shards")
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 5, id)) as doc_id", "repeat('word ', 30) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wavelet.write_shards(docs, TOKENIZER, 2, path, 2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = wavelet.read_documents(spark, path)
    most = max(r["count"] for r in found.groupBy("part").count().collect())
    assert most < 1500  # 4 parts; two thirds of the rows have one id or none
    assert found.count() == 3000 and found.where("doc_id is null").count() == 1000


@pytest.mark.parametrize("shard_tokens", [5, 100_000])
def test_shards_round_trip(spark, shard_tokens):
    docs, path = table(spark, ODD), new_folder(spark, "shards")
    wavelet.write_shards(docs, TOKENIZER, 2, path, shard_tokens)
    rows = wavelet.read_documents(spark, path).join(wavelet.shard_starts(spark, path), ["part", "seq"]).collect()
    rows.sort(key=lambda r: r["base"] + r["within"])
    ordered = sorted(docs.collect(), key=lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["text"] or ""))
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in ordered]
    start = 0
    for found, row in zip(rows, ordered, strict=True):
        ids = [*ids_of(row["text"]), 2]
        assert np.frombuffer(found["ids"], "<u4").tolist() == ids and found["base"] + found["within"] == start
        start += len(ids)


def test_op1_over_the_stored_documents(spark, sf_dir):
    start = 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in sorted(QUERIES["op1_wavelet_shards"](spark, sf_dir).collect()):
        ids = [*ids_of(texts[row["doc_id"]]), 2]
        assert row[1:] == (start, len(ids), crc(ids))
        start += len(ids)


def check_packing(pieces, capacity):
    by_sequence = {}
    for row in pieces:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_op10_over_the_stored_documents(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_best_fit_packing"](spark, sf_dir).collect()
    total = 0
    expected = []
    for doc_id, text in texts.items():
        ids = [*ids_of(text), 0]
        total += len(ids)
        expected += [(doc_id, i // CONTEXT, i, len(c), crc(c)) for i in range(0, len(ids), CONTEXT) for c in [ids[i : i + CONTEXT]]]
    assert sorted(tuple(r[:5]) for r in rows) == sorted(expected)
    assert check_packing(rows, CONTEXT) <= 1.02 * -(-total // CONTEXT) + 1


def test_packing_of_odd_tables(spark):
    cut = packing.pieces(table(spark, ODD), TOKENIZER, 0, 16)
    rows = packing.pack(written(cut.drop("ids"), "pieces"), 16).collect()
    assert len(rows) == cut.count()
    check_packing(rows, 16)
    empty = packing.pieces(table(spark, []).limit(0), TOKENIZER, 0, 16)
    assert packing.pack(written(empty, "pieces"), 16).count() == 0


def fewest(lengths, capacity):
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            put(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_dominance_keeps_a_best_packing(lengths):
    lengths = sorted(lengths, reverse=True)
    counts = {k: lengths.count(k) for k in lengths}
    fixed, left = packing.reduce_by_dominance(dict(counts), 20)
    rest = sorted((k for k, n in left.items() for _ in range(n)), reverse=True)
    assert sum(t for _, t in fixed) + fewest(rest, 20) == fewest(lengths, 20)
    whole = packing.plan(counts, 20)
    packed = sorted((k for pattern, times in whole for k in pattern * times), reverse=True)
    assert packed == lengths and all(sum(p) <= 20 for p, _ in whole)
