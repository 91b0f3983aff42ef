"""Benchmark leaks against brute force, and the stages of the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tallyworks.llm import decontaminate, jaccard
from tallyworks.sources.workspace import written

ENGLISH = [f"{a}{b}" for a in "bcdfghjklm" for b in ("an", "en", "in", "on", "un", "as", "es", "is", "os", "us")]
COMMON = ["the", "of", "and", "to", "in", "a", "is", "that"]


def sentence(rng, n):
    return [rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(ENGLISH) + rng.choice(ENGLISH) for _ in range(n)]


def corpus(seed):
    """Items, documents, and which (doc_id, item_id) are planted."""
    rng = random.Random(seed)
    items = [(i, " ".join(sentence(rng, rng.randrange(15, 60))) + ". " + " ".join(sentence(rng, 6)) + "?") for i in range(30)]
    docs, planted = [], set()
    for doc_id in range(300):
        words = sentence(rng, rng.randrange(5, 400))
        at = rng.randrange(len(words) + 1)
        item_id, text = rng.choice(items)
        part = text.split()
        kind = doc_id % 10
        if kind == 0:  # verbatim, in another case
            words[at:at] = [w.upper() for w in part]
            planted.add((doc_id, item_id))
        elif kind == 1:  # one word in ten replaced
            words[at:at] = [rng.choice(ENGLISH) if i % 10 == 5 else w for i, w in enumerate(part)]
            planted.add((doc_id, item_id))
        elif kind == 2:  # a few words only
            words[at:at] = part[3:8]
        elif kind == 3:  # a third of the words replaced, the answer kept
            words[at:at] = [rng.choice(ENGLISH) if i % 3 == 1 and i < len(part) - 6 else w for i, w in enumerate(part)]
            planted.add((doc_id, item_id))
        docs.append((doc_id, " ".join(words)))
    return items, docs, planted


@pytest.mark.parametrize("block", [500, 7])
def test_planted_leaks_are_found_and_nothing_else(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "ITEMS", block)
    items, docs, planted = corpus(1)
    odd = [(None, items[0][1]), (1000, None), (1001, ""), (1002, "x " * 50_000 + items[1][1]), (0, docs[0][1])]
    table = spark.createDataFrame([(*d, 1) for d in docs + odd], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*items, items[2], (77, None), (None, "a b c"), (78, "?!")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked(table, bench).collect()}
    assert found == planted | {(None, 0), (1002, 1)}
    kept = decontaminate.without_leaks(table, bench)
    assert kept.columns == table.columns
    leaking = {d for d, _ in planted} | {None, 1002}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs + odd if d not in leaking)


def test_copies_with_other_white_space_are_found(spark):
    gaps = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts, _, listed = decontaminate.word_lists(pa.array([f"a{g}b" for g in gaps] + ["one two"], pa.large_string()))
    assert texts.to_pylist() == [["a", "b"]] * len(gaps) + [["one", "two"]] and set(listed) == {"a", "b", "one", "two"}
    items, docs, _ = corpus(1)
    copies = [(1000 + i, f"before {items[i][1]} after".replace(" ", gap)) for i, gap in enumerate("\xa0\u3000\u2009")]
    table = spark.createDataFrame(docs + copies, "doc_id long, text string")
    found = decontaminate.leaked(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} >= {(1000 + i, i) for i in range(3)}


def test_no_documents_or_no_benchmark(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some text of the benchmark")], "item_id long, text string")
    assert decontaminate.leaked(docs.limit(0), bench).count() == 0
    assert decontaminate.leaked(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == 1


def test_leaks_of_the_stored_documents(spark):
    """All items whose words stand in a document one after another are found."""
    path = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked(docs, bench).collect()}
    items = {r["item_id"]: " " + " ".join(decontaminate.words_of(r["text"])) + " " for r in bench.collect()}
    texts = {r["doc_id"]: " " + " ".join(decontaminate.words_of(r["text"])) + " " for r in docs.collect()}
    verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert verbatim and verbatim <= found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=12), st.lists(st.integers(0, 6), max_size=15))
def test_common_subsequence(item, words):
    passage = decontaminate.Passage(1, tuple(item), 0)
    table = np.zeros((len(item) + 1, len(words) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(words):
            table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
    assert decontaminate.common(passage.masks(), len(item), words) == table[-1, -1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=6), st.integers(1, 9), st.integers(1, 4))
def test_windows_cover_every_word(sizes, size, step):
    step = min(step, size)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    doc, start, end = decontaminate.windows(bounds, size, step)
    seen = {w for a, b in zip(start, end, strict=True) for w in range(a, b)}
    assert seen == set(range(sum(sizes))) and ((start >= bounds[doc]) & (end <= bounds[doc + 1]) & (end - start <= size)).all()
    first, last = decontaminate.chunks(bounds, size)
    assert [w for a, b in zip(first, last, strict=True) for w in range(a, b)] == list(range(sum(sizes)))


def test_one_document_of_each_group_stays(spark):
    from test_jaccard import brute, corpus as near_copies

    rows = near_copies(9)
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, _node int")
    kept = jaccard.one_of_each_group(docs, 75)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    labels = [c for c, (_, n, c) in zip(range(len(rows)), brute(rows), strict=True) if n]
    groups = {}
    for i, (_, n, component) in enumerate(brute(rows)):
        if n:
            groups.setdefault(component, []).append(i)
    # a group is named by its smallest id; the id of row 21 stands for two texts, each in a group of its own
    assert labels and set(found) <= set(rows)
    again = brute(found)
    with_words = [(d, c) for d, n, c in again if n]
    assert len({c for _, c in with_words if c is not None}) >= len([c for c in groups if c is not None])
    assert sum(n == 0 for _, n, _ in again) == sum(n == 0 for _, n, _ in brute(rows))
    sets = jaccard.Threshold(75)
    from test_jaccard import shingles

    texts = [shingles(t) for _, t in found if shingles(t)]
    assert not any(sets.similar(len(a & b), len(a), len(b)) for i, a in enumerate(texts) for b in texts[:i])


def test_documents_are_read_once_more_only_for_rows_that_come_again(spark):
    from test_jaccard import corpus as near_copies

    rows = [(i, t) for i, (_, t) in enumerate(near_copies(12))]
    kept = {}
    for name, given in (("once", rows), ("again", [*rows, *rows])):
        found = jaccard.one_of_each_group(spark.createDataFrame(given, "doc_id long, text string"), 75)
        steps = found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
        assert steps == {"once": 1, "again": 2}[name]
        kept[name] = sorted(map(tuple, found.collect()))
    words = lambda found: [r for r in found if (r[1] or "").split()]
    assert words(kept["once"]) == words(kept["again"]) and len(words(kept["once"])) < len(words(rows))


def test_pipeline_keeps_columns_and_clean_documents(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("score", docs_score())
    labels = spark.read.parquet(f"{path}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, path), name)
        if name != "packing":
            assert out.columns == docs.columns
            kept[name] = {r["doc_id"] for r in out.select("doc_id").collect()}
            docs = out
        else:
            assert {r["doc_id"] for r in out.collect()} == kept["benchmark-leaks"]
    good = {d for d, q in labels.items() if q == 1}
    assert len(kept["quality"] & good) > 0.98 * len(good)
    assert len(kept["quality"] & {d for d, q in labels.items() if q == 0}) <= 2
    assert kept["quality"] >= kept["language"] >= kept["near-duplicates"] >= kept["benchmark-leaks"]
    assert len(kept["language"]) > 0.97 * len(kept["quality"])
    left = docs.select("doc_id", "text").collect()
    from test_jaccard import brute

    assert len({c for _, _, c in brute([(r["doc_id"], r["text"]) for r in left])}) == len(left)


def docs_score():
    from pyspark.sql import functions as F

    return F.lit(0.25)


def test_pipeline_run_over_the_small_tables(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns[0] == "doc_id" and result.count() > 0


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
