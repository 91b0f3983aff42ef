from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tallyworks.llm import language, quality
from tallyworks.llm.common import fold
from tallyworks.llm.queries import QUERIES

ODD = [None, "", " ", "123 !?", "x" * 300_000]


@pytest.fixture(scope="module")
def tables(spark):
    path = "/root/testdata/sf0.01"
    read = lambda name: spark.read.parquet(f"{path}/{name}.parquet").toPandas()
    return path, read("documents"), read("labels")


def remainder(ids, parts):
    return np.array([zlib.crc32(str(i).encode()) % parts for i in ids])


def test_op4_on_held_out_labels(spark, tables):
    path, docs, labels = tables
    found = QUERIES["op4_compression_quality"](spark, path).toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id) and found.score.between(0, 1).all()
    assert (found.held_out == (remainder(found.doc_id, 3) == 1)).all()
    assert (found.predicted == (found.score >= 0.5)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.97
    assert ((held.score - held.quality) ** 2).mean() < 0.03


def test_op6_on_held_out_documents(spark, tables):
    path, docs, _ = tables
    found = QUERIES["op6_language"](spark, path).toPandas()
    assert sorted(found.doc_id) == sorted(docs.doc_id) and found.score.between(0, 1).all()
    assert (found.held_out == (remainder(found.doc_id, 4) == 2)).all()
    held = found[found.held_out].merge(docs, on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_scores_do_not_see_labels_and_take_odd_rows(spark, tables):
    path, docs, _ = tables
    stored, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame(
        [(None if i == 1 else 3, t, 9.0, "zz") for i, t in enumerate(ODD * 2)], "doc_id long, text string, score double, lang string"
    )
    model = quality.train(stored, labels)
    rows = quality.scored(odd, model).collect()
    assert len(rows) == len(ODD) * 2 and rows[0].asDict().keys() == {"doc_id", "text", "lang", "score"}
    assert all(0 <= r["score"] <= 1 for r in rows) and len({r["score"] for r in rows if not r["text"]}) == 1
    assert quality.scored(odd.limit(0), model).count() == 0
    learned = language.train(stored)
    rows = language.predicted(odd, learned).collect()
    assert len(rows) == len(ODD) * 2
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or ""))) for r in rows)
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert language.predicted(odd.limit(0), learned).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(1, None), (None, 0), (9, 5)]):
        model = quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert all(0 < r["score"] < 1 for r in quality.scored(docs, model).collect())
    for rows in ([], [(1, "a", None), (2, None, "en")], [(1, "a text", "en")]):
        model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
        found = language.predicted(docs, model).collect()
        assert found[0]["lang_pred"] == ("en" if rows and rows[0][2] else "und") and found[1]["lang_pred"] == "und"


def test_fold_of_a_missing_id(spark):
    rows = spark.createDataFrame([(12,), (None,)], "doc_id long").select(fold("doc_id", 3).alias("f")).collect()
    assert rows[0]["f"] == zlib.crc32(b"12") % 3 and rows[1]["f"] is None


def test_grams_of_a_text_do_not_depend_on_its_neighbours():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é1.") for _ in range(rng.randrange(0, 40))) for _ in range(50)]
    together = [sorted(x) for x in language.of_each(*language.grams(texts))]
    assert together == [sorted(next(language.of_each(*language.grams([t])))) for t in texts]


def test_leader_prefers_few_weights():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 300)
    rows = [(np.array([k, 10 + i % 50]), np.array([2.0, 1.0])) for i, k in enumerate(labels)]
    weights, bias = language.follow_the_leader(rows, labels, 3)
    logits = np.array([x @ weights[at] + bias for at, x in rows])
    assert (logits.argmax(1) == labels).all()
    assert np.count_nonzero(weights[100:]) == 0 and np.abs(weights[:3]).max() > np.abs(weights[10:60]).max()


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 4, 500)
    logits = rng.normal(0, 6, (500, 4))
    logits[np.arange(500), labels] += 5
    loss = lambda t: -np.log(language.softmax(logits / t)[np.arange(500), labels]).mean()
    assert loss(language.calibrate(logits, labels)) <= min(map(loss, np.linspace(0.1, 15, 300))) + 1e-6
