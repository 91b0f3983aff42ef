"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import with_fields
from tallyworks.llm.encoding import runs
from tallyworks.llm.workers import lean, release
from tallyworks.sources.workspace import released_everywhere

BITS = 15
DIMENSIONS = 1 << BITS  # hashed n-grams of one to three characters
SCALE = 30.0  # sum of a text's TF-IDF weights
RUN_BYTES = 1 << 18  # texts are taken in runs of about this size: an n-gram needs some 70 bytes for each character
NO_LETTERS = re.compile(r"[\W\d_]+")
SAMPLE_DOCS = 1500  # documents of each language to learn from, at most
SAMPLE_TOTAL = 8000
LANGUAGES = 1000  # languages to learn, the most frequent ones, at most
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02  # follow the regularised leader: step size and elastic net
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray  # of each dimension
    weights: np.ndarray  # dimension x language
    bias: np.ndarray
    temperature: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed n-grams of whole texts, an array for each n, and the first character of each text in them.

    Position i of an array belongs to the text that position i of all characters belongs to; n-grams that
    would cross into the next text have the value DIMENSIONS. Runs of anything but letters count as one
    blank, so marks and digits carry no language.
    """
    clean = [f" {NO_LETTERS.sub(' ', t.lower()).strip()} " for t in texts]
    code = np.frombuffer("".join(clean).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, clean), np.int64, len(clean))
    starts = np.cumsum(sizes) - sizes
    found, h = [], np.zeros(len(code), np.uint64)
    for n in range(1, 4):
        h = (h[: len(code) - n + 1] + code[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        each = np.full(len(code), DIMENSIONS, np.int32)
        each[: len(h)] = h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)
        for back in range(1, n):
            each[starts[1:] - back] = DIMENSIONS
        found.append(each)
    return found, starts


def of_each(found: list[np.ndarray], starts: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of each text."""
    ends = np.append(starts[1:], len(found[0]))
    for first, end in zip(starts, ends, strict=True):
        flat = np.concatenate([each[first:end] for each in found])
        yield flat[flat < DIMENSIONS]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts each dimension occurs, over all of them, and their number.

    A task counts its own texts; DIMENSIONS numbers a task are summed by Spark.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, flags = np.zeros(DIMENSIONS + 1, np.int64), np.zeros(DIMENSIONS, bool)
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                for flat in of_each(*grams(batch["text"].slice(first, n).to_pylist())):
                    flags[:] = False
                    flags[flat] = True
                    total[:-1] += flags
                total[-1] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["dimension", "texts"])

    counted = texts.select("text").mapInArrow(lean(count), "dimension long, texts long")
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for row in counted.groupBy("dimension").agg(F.sum("texts").alias("n")).collect():
        out[row["dimension"]] = row["n"]
    return out[:-1], int(out[-1])


def vector(flat: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of a text's n-grams: dimensions and weights, which add up to SCALE."""
    at, count = np.unique(flat, return_counts=True)
    weight = count * idf[at]
    return at, weight * (SCALE / max(weight.sum(), 1e-9))


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after EPOCHS passes of FTRL-proximal with elastic net, one document at a time."""
    z, n = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))

    def weights(at):
        solved = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, solved)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at = np.append(rows[i][0].astype(np.int64), DIMENSIONS)  # the last one is the bias
            x = np.append(rows[i][1].astype(float), 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[labels[i]] -= 1
            g = x[:, None] * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    solved = weights(np.arange(DIMENSIONS + 1))
    return solved[:-1], solved[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(labelled: DataFrame) -> LanguageModel:
    """Learn from `labelled` (doc_id, text, lang). Rows without text, letters or language teach nothing.

    Document frequencies come from all rows. The weights come from a sample drawn by hash of the id, about
    SAMPLE_DOCS of each language and at most SAMPLE_TOTAL together; one in five calibrates the temperature.
    The driver gets the sample as sparse vectors of at most DIMENSIONS numbers, never as texts.
    """
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return LanguageModel((), np.ones(DIMENSIONS), np.zeros((DIMENSIONS, 0)), np.zeros(0), 1.0)
    frequencies, total = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + frequencies)) + 1

    each = min(SAMPLE_DOCS, SAMPLE_TOTAL // len(languages))
    shares = [(r["lang"], min(1.0, each / r["count"])) for r in counts]
    spark = rows.sparkSession
    wanted = F.broadcast(spark.createDataFrame(shares, "lang string, _share double"))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "lang"), F.lit(1_000_000)) < F.col("_share") * 1_000_000
    sample = rows.join(wanted, "lang").where(drawn)
    checks = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                part = batch.slice(first, n)
                sparse = [vector(flat, idf) for flat in of_each(*grams(part["text"].to_pylist()))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["lang"],
                        part["checks"],
                        pa.array([at.astype("<u2").tobytes() for at, _ in sparse], pa.binary()),
                        pa.array([x.astype("<f4").tobytes() for _, x in sparse], pa.binary()),
                    ],
                    ["doc_id", "lang", "checks", "at", "x"],
                )

    chosen = sample.select("doc_id", "lang", checks.alias("checks"), "text")
    sparse = chosen.mapInArrow(lean(vectors), "doc_id long, lang string, checks boolean, at binary, x binary")
    found = sorted(sparse.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["lang"], r["at"], r["x"]))
    data = [(np.frombuffer(r["at"], "<u2"), np.frombuffer(r["x"], "<f4")) for r in found]  # widened one at a time
    labels = np.array([languages.index(r["lang"]) for r in found], np.int64)
    held = np.array([bool(r["checks"]) for r in found], bool)
    pick = lambda mask: [d for d, m in zip(data, mask, strict=True) if m]
    weights, bias = follow_the_leader(pick(~held), labels[~held], len(languages))
    logits = np.array([x.astype(float) @ weights[at] + bias for at, x in pick(held)]).reshape(-1, len(languages))
    del found, data
    release()
    released_everywhere(spark)
    return LanguageModel(tuple(languages), idf, weights, bias, calibrate(logits, labels[held]))


def predicted(docs: DataFrame, model: LanguageModel, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns of `docs` with the predicted language and its calibrated probability, called `names`.

    Only `text` is looked at, whole. Missing texts and those without a letter are `und` with score 0, and so
    is everything when no language was learned. Columns with these two names are replaced.
    """
    kept = [c for c in docs.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers for each language

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        table = np.zeros((DIMENSIONS + 1, len(learned.languages) + 1), np.float32)
        table[:-1, :-1] = learned.weights * learned.idf[:, None] * SCALE
        table[:-1, -1] = learned.idf
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):  # only a run's texts are strings, and only its rows go on
                part = batch.slice(first, n)
                texts = part["text"].to_pylist()
                predictions, values = [UNKNOWN] * n, np.zeros(n)
                rows = [i for i, t in enumerate(texts) if t and learned.languages and has_letter(t)]
                if rows:
                    found, starts = grams([texts[i] for i in rows])
                    sums = sum(np.add.reduceat(table[each], starts, axis=0, dtype=np.float64) for each in found)
                    p = learned.probabilities(sums[:, :-1] / sums[:, -1:] + learned.bias)
                    for i, k, value in zip(rows, p.argmax(1), p.max(1), strict=True):
                        predictions[i], values[i] = learned.languages[k], value
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), pa.array(predictions, pa.string()), pa.array(values)], [*kept, *names]
                )

    rest = docs.select(*kept)
    return rest.mapInArrow(lean(predict), with_fields(rest, **dict(zip(names, ("string", "double"), strict=True))))
