"""Chat formatting, fingerprints and sharding, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tallyworks.llm import chat, fingerprints, sharding
from tallyworks.llm.queries import QUERIES
from tallyworks.sources.workspace import written


def conversations(seed):
    rng = random.Random(seed)
    rows, logs = [], [[(rng.choice("ua"), rng.choice(["hi", "", "x y", "é"])) for _ in range(rng.randrange(1, 7))] for _ in range(25)]
    for conv_id in range(120):
        log = rng.choice(logs)
        cut = log[: rng.randrange(1, len(log) + 1)]
        first = rng.randrange(0, 2)
        rows += [(conv_id, first + i, role, text) for i, (role, text) in enumerate(cut)]
    rows += rng.choices(rows, k=10)  # logged twice
    rows += [(500, None, None, None), (500, 3, "u", None), (500, 3, "u", "tie"), (None, 1, "u", "hi"), (None, 2, "a", "new")]
    rng.shuffle(rows)
    return rows


def brute_chats(rows):
    """The maximal conversations: {conv_id: (turns, text)}."""
    low = lambda x: (x is not None, x)
    turns = {}
    for conv, turn, role, text in {(c, t, r or "", x or "") for c, t, r, x in rows}:
        turns.setdefault(conv, []).append((low(turn), role, text))
    talks = {conv: tuple((r, x) for _, r, x in sorted(found)) for conv, found in turns.items()}
    out = {}
    for conv, talk in talks.items():
        others = [(o, t) for o, t in talks.items() if o != conv]
        if any(len(t) > len(talk) and t[: len(talk)] == talk for _, t in others):
            continue
        if any(t == talk and (conv is None or (o is not None and o < conv)) for o, t in others):
            continue
        out[conv] = (len(talk), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in talk))
    return out


@pytest.mark.parametrize(("seed", "block"), [(1, 1024), (2, 2), (3, 3)])
def test_chats_are_the_maximal_conversations(spark, monkeypatch, seed, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rows = conversations(seed)
    turns = spark.createDataFrame([(*r, "p", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, position int")
    found = chat.chats(turns).collect()
    joined = {}
    for row in sorted(found, key=lambda r: (str(r["conv_id"]), r["part"])):
        n, text = joined.get(row["conv_id"], (row["n_turns"], ""))
        joined[row["conv_id"]] = (n, text + row["text"])
    assert joined == brute_chats(rows)
    if block == 1024:
        assert {r["part"] for r in found if r["conv_id"] != 500} == {0}


def test_chats_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chats(empty).count() == 0


def test_parts_are_bounded_whatever_the_turn_numbers(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 10)
    rows = [(None, i % 3, "u", f"null {i}") for i in range(60)] + [(1, None, "u", f"none {i}") for i in range(75)]
    rows += [(2, 7, "u", f"same {i}") for i in range(55)] + [(3, 1000 * i, "u", f"far {i}") for i in range(5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.chats(turns).collect()
    joined = {}
    for row in sorted(found, key=lambda r: (str(r["conv_id"]), r["part"])):
        assert 1 <= row["text"].count("<|im_start|>") <= 10
        n, text = joined.get(row["conv_id"], (row["n_turns"], ""))
        joined[row["conv_id"]] = (n, text + row["text"])
    assert joined == brute_chats(rows)
    assert len(found) == 6 + 8 + 6 + 1


def texts_table(spark, texts, ids=None):
    rows = [(i if ids is None else ids[k], t, 1, "f") for k, (i, t) in enumerate(enumerate(texts))]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars int, fingerprint string")


WORDS = [f"w{i}" for i in range(60)]


def some_texts(seed, n):
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 80))) for _ in range(n)]
    return [*texts, None, "", texts[3], texts[3], "Größe 𝒳𝒴 été " * 20_000]


def test_edited_texts_and_fingerprints(spark):
    texts, rng = some_texts(1, 60), random.Random(2)
    ids = rng.sample(range(-1000, 100_000), len(texts) - 2) + [77, 77]
    rows = [(r["doc_id"], r["text"] or "") for r in texts_table(spark, texts, ids).collect()]
    found = fingerprints.fingerprint_report(texts_table(spark, texts, ids)).collect()
    ordered = sorted(rows)
    expected = []
    for k, (doc_id, text) in enumerate(ordered):
        half, after = len(text) // 2, ordered[(k + 1) % len(ordered)][1]
        edited = text[: len(text) - half] + after[:half]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(tuple(r[:3]) for r in found) == sorted(expected)
    by_text = {}
    text_of = {(d, len(t)): t for d, t in rows}
    for row in found:
        text = text_of[row["doc_id"], row["n_chars"]]
        assert by_text.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        if row["fingerprint"] == row["edited_fingerprint"]:
            assert row["near_edited"] == 1
    assert len(set(by_text.values())) > 0.9 * len(by_text)


def test_one_and_no_document(spark):
    assert fingerprints.fingerprint_report(texts_table(spark, [])).count() == 0
    row = fingerprints.fingerprint_report(texts_table(spark, ["abcde"])).collect()[0]
    assert row["edited_sha256"] == hashlib.sha256(b"abcab").hexdigest()


def test_next_row_for_any_number_of_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(0, 200) if rng.random() < 0.9 else None, str(i)) for i in range(150)] + [(7, "a")] * 40
    rows += [(2**62 + rng.randrange(99), f"far {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]))
    expected = sorted(((*r, ordered[(k + 1) % len(ordered)][1]) for k, r in enumerate(ordered)), key=str)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 2, 7, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found = fingerprints.with_next(docs, ["text"], docs.orderBy("doc_id", "text").limit(1)).collect()
            assert sorted(map(tuple, found), key=str) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_a_hot_id_has_several_ranges(spark):
    """A third of the rows have one id, a third none; no range gets more than a few shares, and the order holds."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdé中😀", k=rng.randrange(0, 12))) for _ in range(3000)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bounds = fingerprints.range_bounds(docs, 20)
    assert len(bounds) < 80 and min(sum(i == h for i, _ in bounds) for h in (None, 7)) > 6
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected = sorted(((*r, ordered[(k + 1) % len(ordered)][1]) for k, r in enumerate(ordered)), key=str)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 20)
        found = fingerprints.with_next(docs, ["text"], docs.orderBy("doc_id", "text").limit(1)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(map(tuple, found), key=str) == expected
    place = lambda r: (r[0] is not None, r[0] or 0, int.from_bytes(r[1].encode()[:6].ljust(6, b"\0")))
    begins = [(i is not None, i or 0, p) for i, p in bounds]
    sizes = [0] * (len(begins) + 1)
    for row in rows:
        sizes[sum(b <= place(row) for b in begins)] += 1
    assert max(sizes) < 3 * 3000 / 20


def test_near_copies_of_a_small_language_are_found(spark):
    """Two documents in a thousand are in another language; its words are in the lexicon."""
    rng = random.Random(6)
    small = [f"ž{i}" for i in range(300)]
    texts = [" ".join(rng.choices(WORDS, k=30)) for _ in range(1996)] + [" ".join(rng.choices(small, k=80)) for _ in range(2)]
    texts += [texts[-1] + " ž999", texts[-2].replace(" ", " ž998 ", 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bits = fingerprints.lexicon(docs)
    pairs = spark.createDataFrame([(texts[-3], texts[-2]), (texts[-4], texts[-1]), (texts[-3], texts[-4])], "a string, b string")
    for c in "ab":
        pairs = fingerprints.with_fingerprint(pairs, c, bits, f"f{c}")
    near = [r[0] for r in pairs.select(fingerprints.likeness(pairs["fa"], pairs["fb"])).collect()]
    assert near[0] > 0.6 and near[1] > 0.6 and near[2] < 0.3


def test_digests_and_likeness_by_brute_force(spark):
    """The lexicon, the digests of its parts and the likeness, from sets of words in plain Python."""
    rng = random.Random(7)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.randrange(1, 25))) for _ in range(80)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    bits = fingerprints.lexicon(docs, 0.05, 0.3)
    count = Counter(w for t in texts for w in set(t.split()))
    band = {w for w, n in count.items() if max(2, 0.05 * 80) <= n <= 0.3 * 80}
    names = sorted(count)
    hashes = spark.createDataFrame([(w,) for w in names], "w string").select(
        "w", *(fingerprints.F.pmod(fingerprints.F.xxhash64(fingerprints.F.xxhash64("w"), fingerprints.F.lit(i)), fingerprints.F.lit(rate)).alias(f"l{i}") for i, rate in enumerate(fingerprints.RATES))
    )
    lexicons = [{r["w"] for r in hashes.where(f"l{i} = 0").collect()} & band for i in range(len(fingerprints.RATES))]
    own = [[frozenset(set(t.split()) & lexicon) for lexicon in lexicons] for t in texts]
    found = fingerprints.with_fingerprint(docs, "text", bits, "f").collect()
    parts = {r["text"]: r["f"].split("-") for r in found}
    by_digest = {}
    for text, sets in zip(texts, own, strict=True):
        for i, words in enumerate(sets):
            assert (parts[text][i] == "") == (not words)
            assert by_digest.setdefault((i, parts[text][i]), words) == words  # one digest, one set of words
        assert (parts[text][-1] == "") == any(sets)
    pairs = [(texts[i], texts[j]) for i in range(40) for j in range(i, 40, 7)]
    said = spark.createDataFrame([(a, b, "-".join(parts[a]), "-".join(parts[b])) for a, b in pairs], "a string, b string, fa string, fb string")
    at = {t: k for k, t in enumerate(texts)}
    for row in said.select("a", "b", fingerprints.likeness(said["fa"], said["fb"]).alias("x")).collect():
        both = [(x, y) for x, y in zip(own[at[row["a"]]], own[at[row["b"]]], strict=True) if x or y]
        same = parts[row["a"]] == parts[row["b"]]
        assert row["x"] == pytest.approx(1.0 if same else sum(x == y for x, y in both) / len(both) if both else 0.0)


def test_lexicon_has_the_terms_of_the_band(spark):
    docs = spark.createDataFrame([(f"all w{i % 5} Half" if i % 2 else f"ALL only{i} w{i % 5}",) for i in range(20)], "text string")
    bits = fingerprints.lexicon(docs, 0.1, 0.5)
    words = spark.createDataFrame([(w,) for w in ("all", "half", "w0", "w4", "only2", "none")], "text string")
    band, _ = fingerprints.digests(words["text"], bits)
    assert {r[0]: r[1] for r in words.select("text", (band != fingerprints.F.array().cast("array<bigint>")).alias("in")).collect()} == {
        "all": False, "half": True, "w0": True, "w4": True, "only2": False, "none": False,
    }


def test_texts_whose_band_terms_are_in_no_lexicon(spark):
    texts = spark.createDataFrame([(f"w{i}",) for i in range(200)], "text string")
    everything = fingerprints.F.array_repeat(fingerprints.F.lit(-1).cast("long"), 1 << (fingerprints.BITS - 6))
    band, parts = fingerprints.digests(texts["text"], everything)
    left_out = texts.withColumn("_band", band).where(fingerprints.F.array_join(parts, "") == "").select("text")
    found = fingerprints.with_fingerprint(left_out, "text", everything, "f").collect()
    assert len(found) > 20
    assert len({r["f"] for r in found}) == len(found)


def test_small_edits_leave_likeness(spark):
    texts = [" ".join(random.Random(i).choices(WORDS, k=40)) for i in range(200)]
    bits = fingerprints.lexicon(texts_table(spark, texts), 0.01, 0.9)
    pairs = [(t, t.rsplit(" ", 1)[0] + " other", texts[i - 1]) for i, t in enumerate(texts)]
    rows = spark.createDataFrame(pairs, "a string, b string, c string")
    for c in "abc":
        rows = fingerprints.with_fingerprint(rows, c, bits, f"f{c}")
    near = rows.select(fingerprints.likeness(rows["fa"], rows["fb"]).alias("edit"), fingerprints.likeness(rows["fa"], rows["fc"]).alias("other"))
    edit, other = near.selectExpr("avg(edit)", "avg(other)").collect()[0]
    assert edit > 0.5 > other + 0.2


def brute_shards(rows, limit):
    """{(doc_id, n_bytes): (shard, depth, shard_bytes)} by splitting buckets one bit at a time."""
    hashed = [(d, n, int(hashlib.md5(str("" if d is None else d).encode()).hexdigest()[:15], 16)) for d, n in rows]
    out, todo = {}, [("", hashed)]
    while todo:
        bits, bucket = todo.pop()
        size = sum(n for _, n, _ in bucket)
        if size <= limit or len({h for _, _, h in bucket}) == 1:
            out |= {(d, n): (bits, len(bits), size) for d, n, _ in bucket}
            continue
        for bit in "01":
            part = [x for x in bucket if f"{x[2]:060b}"[len(bits)] == bit]
            if part:
                todo.append((bits + bit, part))
    return out


@pytest.mark.parametrize("limit", [50, 400, 1_000_000])
def test_shards_are_split_only_where_needed(spark, limit):
    rng = random.Random(limit)
    texts = ["x" * rng.choice([0, 1, 5, 30, 300]) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (4, None)] + [(9999, "y" * 20)] * 30
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, depth int")
    found = sharding.shards(docs, limit).collect()
    assert len(found) == len(rows)
    expected = brute_shards([(d, len(t or "")) for d, t in rows], limit)
    pages = {}
    for row in found:
        assert (row["shard"], row["depth"], row["shard_bytes"]) == expected[row["doc_id"], row["n_bytes"]]
        pages.setdefault((row["shard"], row["page"]), []).append(row["n_bytes"])
    assert all(sum(sizes) <= limit or len(sizes) == 1 for sizes in pages.values())
    assert sharding.shards(docs.limit(0), limit).count() == 0


def test_overflow_pages_of_a_hot_id(spark):
    rows = [(5 if i % 3 else i, "x" * (10 + i % 7)) for i in range(900)] + [(5, "y" * 10)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shards(docs, 200).collect()
    pages = {}
    for r in found:
        pages.setdefault((r["shard"], r["page"]), []).append(r["n_bytes"])
    assert len(found) == len(rows) and all(sum(p) <= 200 for p in pages.values())
    hot = sorted(r["page"] for r in found if r["doc_id"] == 5)
    assert set(hot) == set(range(max(hot) + 1)) and len(set(hot)) == -(-650 // (200 // 16))


def test_native_plans_run_no_python(spark, sf_dir):
    for name in ("op2_chat", "op8_imatch", "op9_extendible_shards"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_op8_over_the_stored_documents(spark, sf_dir):
    found = written(QUERIES["op8_imatch"](spark, sf_dir), "op8").toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id)
    merged = found.merge(docs[["doc_id", "text"]], on="doc_id")
    assert (merged.groupby("text").fingerprint.nunique() == 1).all()
    assert found.near_edited.mean() > found.near_next.mean()
