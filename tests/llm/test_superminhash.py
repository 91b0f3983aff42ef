from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyworks.llm import superminhash
from tallyworks.llm.jaccard import Threshold
from tallyworks.llm.queries import QUERIES


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(words, words[1:], strict=False)) or frozenset([tuple(words)] if words else [])


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of each row, by comparing all pairs that share a shingle."""
    sets, where, up = [shingles(t) for _, t in rows], defaultdict(list), list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for j, o in Counter(j for x in s for j in where[x]).items():
            if 100 * o >= 80 * (len(s) + len(sets[j]) - o):
                up[root(i)] = root(j)
        for x in s:
            where[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    named = [least.get(root(i)) if sets[i] else d for i, (d, _) in enumerate(rows)]
    return [(d, len(sets[i]), named[i], d == named[i]) for i, (d, _) in enumerate(rows)]


def key(row):
    return tuple((v is None, v) for v in row)


def corpus(seed, groups=12, alone=40):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    passage = [word() for _ in range(30)]
    texts = [None, "", " \t\n", "one", "One", "one two", "ONE two", "é\x85É", "É é É é É", "é é é é é"]
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.2:
                copy = copy[: rng.randrange(1, len(copy) + 1)]
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in copy))
    for _ in range(alone):
        texts.append(" ".join([word() for _ in range(rng.randrange(1, 40))] + passage * rng.randrange(0, 2)))
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return [*rows, (rows[20][0], rows[20][1]), (rows[21][0], "another text with the same id"), (None, rows[22][1]), (None, "x")]


@pytest.mark.parametrize(("seed", "block_bytes"), [(1, 2 << 20), (2, 1500), (3, 300)])
def test_same_components_as_brute_force(spark, seed, block_bytes):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, node int, h string")
    found = superminhash.near_duplicates(docs, block_bytes=block_bytes)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows), key=key)


def test_op11_over_the_stored_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_superminhash"](spark, sf_dir).collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_empty_table_and_rows_without_words(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert superminhash.near_duplicates(none).collect() == []
    rows = [(2, None), (1, ""), (None, " \n")]
    found = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=key) == sorted([(2, 0, 2, True), (1, 0, 1, True), (None, 0, None, True)], key=key)


def drawn(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))


def by_the_definition(hashes, slots):
    """Each slot's least (rank + fraction) over whole permutations, one shingle at a time, no early stop."""
    signature = [1 << 64] * slots
    for h in hashes:
        places = list(range(slots))
        for rank in range(slots):
            at, value = (int(x[0]) for x in superminhash.draws(np.array([h]), rank, slots))
            places[rank], places[at] = places[at], places[rank]
            signature[places[rank]] = min(signature[places[rank]], value)
    return signature


def test_early_stop_changes_nothing():
    rng = np.random.default_rng(5)
    sets = [drawn(rng, n) for n in (1, 2, 3, 17, 60, 400)]
    found = superminhash.signatures([*sets, np.zeros(0, np.uint64)], 24)
    for s, signature in zip(sets, found, strict=False):
        assert signature.tolist() == by_the_definition(s, 24)
    assert (found[-1] == np.iinfo(np.uint64).max).all()


def test_estimates_vary_less_than_those_of_independent_hashes():
    rng, errors = np.random.default_rng(6), []
    for _ in range(150):
        h = drawn(rng, 150)
        a, b = superminhash.signatures([h[:125], np.sort(np.concatenate([h[:100], h[125:]]))])
        errors.append(superminhash.estimate(a, b) - 100 / 150)
    independent = (2 / 9 / superminhash.SLOTS) ** 0.5
    assert abs(np.mean(errors)) < independent / 4 and np.std(errors) < 0.85 * independent


def test_similar_sets_share_a_band():
    rng, lost = np.random.default_rng(7), 0
    for n in (5, 9, 40, 90, 360):
        for _ in range(60):
            h = drawn(rng, n)
            part = n // 10  # 0.8 or a little more
            a, b = h[: n - part], np.sort(np.concatenate([h[: n - 2 * part], h[n - part :]]))
            codes = superminhash.bands(superminhash.signatures([a, b]))
            lost += not (codes[0] == codes[1]).any()
    assert lost == 0


def test_a_task_sends_one_row_a_band_for_many_near_copies(spark):
    rng = random.Random(8)
    base = [str(rng.randrange(10**6)) for _ in range(400)]
    rows = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    links = superminhash.band_links(docs, Threshold(80)).collect()
    assert len(links) == 299  # spanning links only
    links = superminhash.band_links(docs.repartition(20), Threshold(80)).distinct().count()
    assert links <= 299 * 4  # the tasks' chains, and those of all bands, have few smallest nodes
    found = superminhash.near_duplicates(docs, block_bytes=60_000).collect()
    assert {r["component_id"] for r in found} == {0} and sum(r["kept"] for r in found) == 1


def test_chains_break_only_where_sizes_are_too_far_apart():
    h = np.array([7, 7, 7, 7, 8], np.uint64)
    node, low, high = np.array([1, 2, 3, 4, 5]), np.array([0, 5, 60, 100, 100]), np.array([50, 6, 61, 100, 100])
    chains, links = superminhash.chained(h, node, low, high, 10)
    assert links.tolist() == [[1, 2], [1, 3]]  # 60 is within 10 of the first row's 50, though not of 6
    assert [c.tolist() for c in chains] == [[7, 7, 8], [1, 4, 5], [0, 100, 100], [61, 100, 100]]


def test_confirmed_links_connect_what_all_pairs_do():
    rng = random.Random(9)
    for _ in range(30):
        base = [frozenset(rng.randrange(60) for _ in range(20)) for _ in range(3)]
        sets = list({frozenset(x for x in rng.choice(base) if rng.random() < 0.95) for _ in range(12)})
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        links = superminhash.confirmed(list(range(len(sets))), arrays, Threshold(80))
        found, expected = superminhash.UnionFind(), superminhash.UnionFind()
        for a, b in links:
            assert 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            found.join(a, b)
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    expected.join(a, b)
        assert [found.root(i) for i in range(len(sets))] == [expected.root(i) for i in range(len(sets))]


def test_sets_of_two_words():
    sets = superminhash.shingle_sets(pa.array(["a b a b a", "A B", "a", ""]), 2)
    assert [len(s) for s in sets] == [2, 1, 1, 0] and sets[1][0] in sets[0] and sets[2][0] != sets[1][0]
