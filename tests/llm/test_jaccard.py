from __future__ import annotations

import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyworks.llm import jaccard
from tallyworks.llm.graph import components
from tallyworks.llm.queries import QUERIES
from tallyworks.sources import workspace


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.root(a)] = self.root(b)


def brute(rows):
    """(doc_id, n_shingles, component_id) of each row, by comparing all pairs that share a shingle."""
    sets, where, union = [shingles(t) for _, t in rows], defaultdict(list), Union(len(rows))
    for i, s in enumerate(sets):
        overlap = Counter(j for x in s for j in where[x])
        for j, o in overlap.items():
            if 100 * o >= 75 * (len(s) + len(sets[j]) - o):
                union.join(i, j)
        for x in s:
            where[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[union.root(i)] = min(least.get(union.root(i), doc_id), doc_id)
    return [(d, len(sets[i]), least.get(union.root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def corpus(seed, groups=12, alone=40):
    """Groups of near copies around a text, texts with a shared passage, odd rows."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    passage = [word() for _ in range(30)]
    texts = [None, "", " \t\n", "one", "One", "one two three four", "one two three four five", "É é É é É", "é é é é é"]
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.2:
                copy = copy[: rng.randrange(1, len(copy) + 1)]
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in copy))
    for _ in range(alone):
        texts.append(" ".join([word() for _ in range(rng.randrange(1, 40))] + passage * rng.randrange(0, 2)))
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return [*rows, (rows[20][0], rows[20][1]), (rows[21][0], "another text with the same id"), (None, rows[22][1]), (None, "x")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, (1 << 64) - 1)), max_size=60))
def test_gaps_come_back(values):
    numbers = np.sort(np.array(values, np.uint64))
    assert jaccard.gaps_unpacked(jaccard.gaps_packed(numbers)).tolist() == numbers.tolist()


@pytest.mark.parametrize(
    ("seed", "frequent", "block_bytes"), [(1, 1 << 21, 32 << 20), (2, 4, 32 << 20), (3, 1 << 21, 1500), (4, 0, 4000)]
)
def test_same_components_as_brute_force(spark, seed, frequent, block_bytes):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, root int")
    found = jaccard.similar_groups(docs, 75, frequent, block_bytes).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_order_is_small_on_its_way_through_the_driver(spark):
    """Its bits, 2^21 for each shuffle partition, are few among many unless the data has many shared shingles."""
    texts = [" ".join(f"w{i * 20 + k}" for k in range(20)) for i in range(300)]
    docs = spark.createDataFrame([(i, t + more) for i, t in enumerate(texts) for more in ("", " and more")], "doc_id long, text string")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        order = jaccard.shingle_order(docs, 64)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    handed_on = pickle.dumps(order)
    assert len(handed_on) < 200_000
    first = jaccard.shingle_sets(pa.array(texts[:2]))[0]
    for _ in range(2):  # the second time the bits are there
        assert order.level(first).min() >= 1
        lone = jaccard.shingle_sets(pa.array([" ".join(f"lone{k}" for k in range(400))]))[0]
        assert np.count_nonzero(order.level(lone)) <= 1
    later = pickle.loads(handed_on)
    assert np.array_equal(later.level(first), order.level(first))
    assert len(order.flags()) == 256 * (1 << 21) // 8 == len(later.flags())


def test_members_meet_only_their_own_text(spark):
    texts = [" ".join(f"w{i * 7 + k}" for k in range(12)) for i in range(30)]
    rows = [(None, t) for t in texts] + [(5, t + " more") for t in texts] + [(9, texts[0] + " again")] * 4 + [(9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members = jaccard.set_table(docs).where("node is not null").select("doc_id", "node").distinct().localCheckpoint()
    assert members.count() == 61
    assert jaccard.member_texts(docs.coalesce(1), members).count() == 61
    found = jaccard.packed_sets(docs.repartition(4), members).collect()
    assert sorted(r["node"] for r in found) == sorted(r["node"] for r in members.collect())
    assert all(jaccard.node_of(np.frombuffer(r["hashes"], "<u8")) == r["node"] for r in found)


def test_tasks_of_a_large_group_are_bounded(spark):
    rng = random.Random(7)
    rows = [(i % 2, i, rng.randbytes(8 * rng.randrange(20, 200))) for i in range(800)]
    stored = spark.createDataFrame(rows, "root long, node long, hashes binary").localCheckpoint()
    sets, limit = jaccard.blocked(stored, "block", 20_000).localCheckpoint(), 20_000
    pairs = jaccard.block_pairs(sets, stored, jaccard.Threshold(75), limit).collect()
    load, met = Counter(), defaultdict(lambda: ([], []))
    for r in pairs:
        load[r["root"], r["block"], r["slice"]] += len(r["hashes"])
        met[r["root"], r["block"], r["slice"]][r["asks"]].append(r["node"])
    assert max(load.values()) <= 2 * 1.5 * limit
    asked = {(q, m) for members, queries in met.values() for q in queries for m in members}
    size = {node: (root, len(h)) for root, node, h in rows}
    for q, (a, n) in size.items():
        for m, (b, k) in size.items():
            assert (q, m) in asked or a != b or 4 * min(n, k) < 3 * max(n, k)
    assert len(asked) < 2 * 400 * 400  # and not everything everywhere


@pytest.mark.parametrize("block_bytes", [32 << 20, 6000])
def test_texts_of_groups_are_moved_once(spark, monkeypatch, block_bytes):
    """Near copies of all documents: texts go to the tasks that compare them as they are, and only groups that no task
    can hold are stored, once. With what was stored and shuffled besides, disk was six times the input."""
    plans = {}

    def written(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return workspace.written(df, label)

    monkeypatch.setattr(jaccard, "written", written)
    rows = corpus(11, groups=30, alone=0)
    rows = [r for i, r in enumerate(rows) if r not in rows[:i]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.similar_groups(docs, 75, block_bytes=block_bytes).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)
    large = {"member-texts", "large-groups"}
    assert plans.keys() & {*large, "blocks", "queries"} == (large if block_bytes == 6000 else set())
    assert plans["small-links"].count("Exchange hashpartitioning") == 1
    assert "hashes" not in plans["small-links"]
    assert "Exchange" not in plans.get("large-groups", "")


def test_buckets_follow_the_number_of_shingles(spark):
    """However few shuffle partitions there are; numbers of many shingles in few buckets would not tell them apart."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i * 20 + k}" for k in range(20))) for i in range(50)], "doc_id long, text string")
    assert [jaccard.bucket_bits(docs, n) for n in (0, 1, 4 << 21, (4 << 21) + 1, 1 << 31, 1 << 60)] == [2, 2, 2, 3, 10, 16]
    assert jaccard.shingles_of(jaccard.set_table(docs)) == 50 * 16
    assert jaccard.shingles_of(jaccard.set_table(docs.limit(0))) == 0
    order = jaccard.shingle_order(docs, 64, 1 << 30)
    assert order.bits == 9 and order.shared_bits == 30
    assert jaccard.candidate_links(docs.unionAll(docs), jaccard.Threshold(75), 64, 1 << 30).count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_groups(docs).count() == 0


def test_op5_over_the_stored_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op5_ngram_jaccard"](spark, sf_dir).collect())) == sorted(brute(rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB é\t\x0b\x1c .", max_size=25), max_size=4))
def test_shingle_sets(texts):
    sets = jaccard.shingle_sets(pa.array(["One É of more", *texts], pa.string()).slice(1))
    expected = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in expected]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert len(np.intersect1d(a, b)) == len(expected[i] & expected[j])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=12), st.integers(1, 100))
def test_trie_finds_all_similar_sets(sets, percent):
    threshold = jaccard.Threshold(percent)
    arrays = [np.array(sorted(s), np.uint32) for s in sets]
    trie = jaccard.Trie(arrays, 13, threshold)
    for query, numbers in zip(sets, arrays, strict=True):
        expected = [i for i, s in enumerate(sets) if 100 * len(s & query) >= percent * len(s | query)]
        assert sorted(trie.similar_to(numbers)) == expected


def test_trie_of_a_text_that_grew_a_thousand_times():
    sets = [np.arange(n, dtype=np.uint32) for n in range(2980, 4100)]
    trie = jaccard.Trie(sets, 4100, jaccard.Threshold(75))
    expected = [i for i, s in enumerate(sets) if 100 * min(len(s), 3500) >= 75 * max(len(s), 3500)]
    assert sorted(trie.similar_to(np.arange(3500, dtype=np.uint32))) == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 9), min_size=1), min_size=2, max_size=12, unique_by=frozenset))
def test_group_links_connect_what_all_pairs_connect(sets):
    threshold = jaccard.Threshold(75)
    pairs, links = Union(len(sets)), Union(len(sets))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if threshold.similar(len(a & b), len(a), len(b)):
                pairs.join(i, j)
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    for i, j in jaccard.group_links(list(range(len(sets))), arrays, threshold):
        assert threshold.similar(len(sets[i] & sets[j]), len(sets[i]), len(sets[j]))
        links.join(i, j)
    for i in range(len(sets)):
        for j in range(i):
            assert (pairs.root(i) == pairs.root(j)) == (links.root(i) == links.root(j))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400) - 200, rng.randrange(400) - 200) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 90)] + [(7, 7)]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    union = Union(len(nodes))
    for a, b in edges:
        if a != b:
            union.join(nodes.index(a), nodes.index(b))
    least = {}
    for i, node in enumerate(nodes):
        least.setdefault(union.root(i), node)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == [(node, least[union.root(i)]) for i, node in enumerate(nodes)]
