"""Recall of the leak search, by kind of leak and size of item, against the rule itself at every place."""

from __future__ import annotations

import random

import pytest

from tallyworks.llm import decontaminate as dc

SIZES = (3, 5, 8, 12, 16, 24, 40, 64)
EACH = 40


def vocabulary(rng, n):
    """Words with frequencies as in texts."""
    words = ["".join(rng.choices("abcdefghijklmnoprstu", k=rng.randrange(2, 9))) for _ in range(n)]
    return words, [1 / (i + 3) for i in range(n)]


def planted(spark):
    """Documents of drawn words with one leak each, and the items: {(kind, size): {doc_id: item_id}}."""
    rng = random.Random(11)
    words, weights = vocabulary(rng, 3000)
    draw = lambda k: rng.choices(words, weights, k=k)
    items, docs, where = [], [], {}
    for size in SIZES:
        for _ in range(EACH):
            question = draw(max(1, size - max(1, size // 4)))
            items.append((len(items), " ".join(question) + ". " + " ".join(draw(size - len(question))) + "."))
    benchmark = [w for _, text in items for w in dc.words_of(text)]
    number = {w: i + 1 for i, w in enumerate(sorted(set(benchmark)))}
    for item_id, text in items:
        (passage,) = dc.passages_of([(item_id, text)], number)
        own = dc.words_of(text)
        size, keep = len(own), passage.answer
        some = lambda share, source: [  # noqa: E731, B023
            rng.choice(source) if i < size - keep and rng.random() < share else w for i, w in enumerate(own)  # noqa: B023
        ]
        kinds = {
            "verbatim": own,
            "in a list": [*draw(3), *own, *rng.choice(items)[1].split()[:12], *draw(3)],
            "a tenth dropped": [w for i, w in enumerate(own) if i % 10 != 4],
            "answer kept, 0.45 of the rest benchmark words": some(0.45, benchmark),
            "answer kept, 0.45 of the rest other words": some(0.45, words),
        }
        for kind, said in kinds.items():
            doc_id = len(docs)
            docs.append((doc_id, " ".join([*draw(rng.randrange(0, 150)), *said, *draw(rng.randrange(0, 150))])))
            where.setdefault((kind, SIZES[item_id // EACH]), {})[doc_id] = item_id
    docs += [(len(docs) + i, " ".join(draw(200))) for i in range(400)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
        dict(docs),
        dict(items),
        number,
        where,
    )


def is_leak(text, item_id, item, number):
    """The rule, tried on every stretch of the document that is as long as the item and half as much again."""
    (passage,) = dc.passages_of([(item_id, item)], number)
    words = [number.get(w, 0) for w in dc.words_of(text)]
    wide = len(passage.words) * 3 // 2
    masks = passage.masks()
    return any(dc.leaks(passage, masks, words[a : a + wide]) for a in range(max(1, len(words) - wide + 1)))


def test_recall_by_kind_and_size(spark):
    docs, benchmark, texts, items, number, where = planted(spark)
    found = {(r["doc_id"], r["item_id"]) for r in dc.leaked(docs, benchmark).collect()}
    low = {}
    for (kind, size), plants in where.items():
        true = [(d, i) for d, i in plants.items() if is_leak(texts[d], i, items[i], number)]
        recall = sum(p in found for p in true) / max(1, len(true))
        print(f"{kind}, {size} words: {recall:.2f} of {len(true)}")
        if true and recall < 0.9:
            low[kind, size] = recall
    assert low == {}


@pytest.mark.parametrize("items", [30])
def test_clean_documents_are_left_alone(spark, items):
    rng = random.Random(12)
    words, weights = vocabulary(rng, 4000)
    docs = [(i, " ".join(rng.choices(words, weights, k=200))) for i in range(300)]
    asked = [(i, " ".join(rng.choices(words, weights, k=20)) + ".") for i in range(items)]
    found = dc.leaked(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")
    )
    assert found.count() == 0
