from __future__ import annotations

import random
import re
from itertools import permutations

import pytest

from tallyworks.llm import filter_audit
from tallyworks.llm.queries import ORACLES, QUERIES

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def failures(rows):
    """The letters that each of the rows (doc_id, text, source) fails."""
    texts = [t or "" for _, t, _ in rows]
    found = []
    for (doc_id, _, _), text in zip(rows, texts, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(set(text) & set("#$%&*|")),
            "E": doc_id is not None and any(t == text and d is not None and d < doc_id for (d, _, _), t in zip(rows, texts, strict=True)),
        }
        found.append({c for c in failed if failed[c]})
    return found


def brute(rows, labels, letters="ABCDE", failed=None):
    """Applies the filters one after the other, for each order and part."""
    failed = failed or failures(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    result = {}
    for part in {s or "" for _, _, s in rows}:
        own = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        shapley = dict.fromkeys(letters, 0)
        for order in permutations(letters):
            left = own
            for step, c in enumerate(order, 1):
                gone = [i for i in left if c in failed[i]]
                before, left = left, [i for i in left if c not in failed[i]]
                result[part, "".join(order), step] = (
                    len(left),
                    len(gone),
                    sum(c in failed[i] for i in own) - len(gone),
                    sum(failed[i] == {c} for i in own),
                    sum(rows[i][0] in good for i in gone),
                    sum(rows[i][0] in toxic for i in gone),
                )
                shapley[c] += len(before) - len(left)
        for key in [k for k in result if k[0] == part]:
            result[key] += (shapley[key[1][key[2] - 1]],)
    return sorted((*k, *v) for k, v in result.items())


def odd_rows(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "É", "Ab", "XYZ", "x|y", "50%", "中文", "é\x85z"])
    texts = [None, "", " \t\x0b\x0c\r\n", "word " * 250, "AB" * 3, "#", " ".join(map(str, range(230)))]
    texts += [" ".join(word() for _ in range(rng.choice([3, 199, 200, 201]))) for _ in range(20)]
    texts += [" ".join(f"w{rng.randrange(1000)}" for _ in range(300)) for _ in range(6)]
    rows = [(rng.choice([i, i, i, 7, None]), rng.choice(texts), rng.choice(["s", "t", "t", "", None])) for i in range(70)]
    labels = [(rng.choice([i, None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(70)] * 2
    return [*rows, *rows[:5]], labels


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rows, labels = odd_rows(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, part string")
    known = spark.createDataFrame([(*r, 3) for r in labels], "doc_id long, quality int, toxic int, n int")
    found = filter_audit.audit(docs, known)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == brute(rows, labels)


def test_any_filters_and_the_rules_of_the_sums(spark):
    rows = [(i, f"{'x' * (i % 2)}{'y' * (i % 3)}{i % 5}", "s") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    own = lambda text, words: {"X": text.contains("x"), "Y": text.contains("y")}
    found = [tuple(r) for r in filter_audit.audit(docs, labels, own).collect()]
    seen = set()
    failed = [{c for c in "XY" if c.lower() in t} | ({"E"} if t in seen or seen.add(t) else set()) for _, t, _ in rows]
    assert sorted(found) == brute(rows, [], "XYE", failed)
    shapley = {order[step - 1]: s for _, order, step, *_, s in found}
    assert sum(shapley.values()) == 6 * sum(map(bool, failed))  # each removed row counts once an order


def test_empty_tables_and_too_many_filters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs, labels)
    assert found.collect() == [] and found.columns == COLUMNS
    with pytest.raises(ValueError, match="at most 6"):
        filter_audit.prefix_steps(spark.createDataFrame([(0,)], "mask int"), list("ABCDEFG"))


def test_each_level_of_the_recursion_has_its_prefixes(spark):
    masks = spark.createDataFrame([(0,), (3,), (16,)], "mask int")
    steps = filter_audit.prefix_steps(masks, list("ABCDE")).collect()
    by_level = {k: {r["prefix"] for r in steps if r["step"] == k} for k in range(1, 6)}
    assert {k: len(v) for k, v in by_level.items()} == {1: 5, 2: 20, 3: 60, 4: 120, 5: 120}
    assert len(steps) == 325 * 3 and all(r["letter"] == r["prefix"][-1] for r in steps)


def test_copies_and_hot_ids_do_not_meet_in_one_row(spark):
    """A third of the rows are copies, a third has one id: what is joined has far fewer rows."""
    rows = spark.range(6000).selectExpr(
        "if(id % 3 = 1, 5, id) as doc_id", "if(id % 3 = 0, 'same', concat('t', id % 100)) as text", "'s' as source"
    )
    labels = spark.createDataFrame([(5, 1, 0), (0, 0, 1)], "doc_id long, quality int, toxic int")
    cells, letters = filter_audit.mask_cells(rows, labels)
    got = {(r["part"], r["mask"]): (r["n"], r["good"], r["toxic"]) for r in cells.collect()}
    facts = [(r["doc_id"], r["text"], r["source"]) for r in rows.collect()]
    first = {}
    for d, t, _ in facts:
        first[t] = min(first.get(t, d), d)
    expected = {}
    for d, t, s in facts:
        key = (s, 1 + (16 if d > first[t] else 0))
        n, good, toxic = expected.get(key, (0, 0, 0))
        expected[key] = (n + 1, good + (d == 5), toxic + (d == 0))
    assert got == expected and letters == list("ABCDE")


def test_op12_equals_its_sql(spark, sf_dir, duck):
    found = QUERIES["op12_filter_audit"](spark, sf_dir)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == sorted(duck.execute(ORACLES["op12_filter_audit"]).fetchall())
