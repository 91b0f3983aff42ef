"""Quality scores from compression: a text is like the labelled texts whose dictionary shortens it most."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text, with_fields
from tallyworks.llm.encoding import runs
from tallyworks.llm.workers import lean, release
from tallyworks.sources.workspace import released_everywhere

SAMPLE_DOCS = 4000  # labelled documents of each class to learn from, at most; half train, half calibrate
PIECES = 8000  # pieces of each class that make its dictionary, at most
PIECE_CHARS = 512
DICTIONARY_BYTES = 112_640
CHUNK_BYTES = 2048  # a text is compressed in chunks, so that its own beginning cannot replace the dictionary
LEVEL = 3
RUN_BYTES = 1 << 20  # texts are taken in runs of about this size


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # intercept first

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for data in (self.good, self.bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, level=LEVEL, write_content_size=False, write_dict_id=False))
        return made

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - np.array(self.mean)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(z @ np.array(self.weights[1:]) + self.weights[0], -700, 700)))


def features(texts: list[str], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Two numbers a text, whole: the difference of its compressed sizes (bad less good) for each byte, and the
    logarithm of its size with the good dictionary for each byte. An empty text has no difference."""
    out = np.empty((len(texts), 2))
    for row, text in enumerate(texts):
        data = text.encode()
        count = max(1, round(len(data) / CHUNK_BYTES))
        step = max(1, -(-len(data) // count))
        chunks = [data[i : i + step] for i in range(0, len(data), step)] or [b""]
        good, bad = (sum(len(c.compress(x)) for x in chunks) for c in compressors)
        size = len(data) + 16 * len(chunks)  # a frame has some bytes even without content
        out[row] = (bad - good) / size, np.log(good / size)
    return out


def sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most `per_class` ids of each class, the first by hash: bounded whatever the size of `labels`."""
    rows = labels.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Learn from `docs` (doc_id, text) and those of `labels` (doc_id, `label` 0 or 1) that may be learned from.

    The driver receives at most 2 * PIECES pieces of PIECE_CHARS characters, drawn by hash from all parts of
    whole texts, and two numbers for each calibration document. Classes keep the weight they have in
    `labels`. Labels other than 0 and 1, and those without a document, teach nothing; a label may repeat.
    """
    drawn = sample(labels, label, SAMPLE_DOCS)
    taught = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text")).join(
        F.broadcast(drawn), "doc_id"
    )
    calibrates = F.xxhash64(F.lit("calibrate"), "doc_id") % 2 == 0
    pieces = taught.where(~calibrates & (F.length("text") > 0)).select(
        "label",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE_CHARS)),
                lambda i: F.substring("text", (i * PIECE_CHARS + 1).cast("int"), F.lit(PIECE_CHARS)),
            )
        ).alias("at", "piece"),
        "doc_id",
    )
    order = (F.xxhash64("doc_id", "at"), F.col("piece"))
    dictionaries = []
    for k in (1, 0):
        rows = pieces.where(F.col("label") == k).orderBy(*order).select("piece").limit(PIECES).collect()
        dictionaries.append(dictionary([r["piece"].encode() for r in rows]))
    good, bad = dictionaries
    model = QualityModel(good, bad, (0.0, 0.0), (1.0, 1.0), (0.0, 0.0, 0.0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for batch in batches:
            x = features(batch["text"].to_pylist(), tools)
            yield pa.RecordBatch.from_arrays([batch["label"], *map(pa.array, x.T.copy())], ["label", "x0", "x1"])

    measured = taught.where(calibrates).select("label", "text").mapInArrow(lean(measure), "label int, x0 double, x1 double")
    rows = np.array(sorted(tuple(r) for r in measured.collect()), float).reshape(-1, 3)
    known = labels.where(F.col(label).cast("int").isin(0, 1))
    counts = {r[0]: r[1] for r in known.groupBy(F.col(label).cast("int")).count().collect()}
    release()
    released_everywhere(docs.sparkSession)
    return calibrated(model, rows[:, 1:], rows[:, 0], counts)


def dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the pieces themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:] or b"\0" * 8


def calibrated(model: QualityModel, x: np.ndarray, y: np.ndarray, counts: dict[int, int]) -> QualityModel:
    """The model with a logistic curve from features to the share of label 1; without both classes, the share."""
    present = [int((y == k).sum()) for k in (0, 1)]
    if min(present) == 0:
        share = (present[1] + 1) / (sum(present) + 2)
        return QualityModel(model.good, model.bad, (0.0, 0.0), (1.0, 1.0), (float(np.log(share / (1 - share))), 0.0, 0.0))
    weight = np.where(y == 1, counts[1] / present[1], counts[0] / present[0])
    weight *= len(y) / weight.sum()
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z, beta = np.c_[np.ones(len(x)), (x - mean) / scale], np.zeros(3)
    ridge = np.diag([0.0, 0.01, 0.01])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -700, 700)))
        slope = z.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((z.T * (weight * p * (1 - p))) @ z + ridge + 1e-9 * np.eye(3), slope)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return QualityModel(model.good, model.bad, tuple(mean), tuple(scale), tuple(beta))


def scored(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """All rows and columns of `docs` in their order with a score from 0 to 1, higher for good text.

    Only `text` is looked at; missing texts are empty, and empty texts get the score of no difference. A column
    called `name` is replaced. `docs` goes through the tasks as it is read, without a shuffle.
    """
    kept = [c for c in docs.columns if c != name]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = model.compressors()
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):  # only a run's texts are strings, and only its rows go on
                part = batch.slice(first, n)
                values = pa.array(model.score(features([t or "" for t in part["text"].to_pylist()], tools)))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), values], [*kept, name])

    rest = docs.select(*kept)
    return rest.mapInArrow(lean(score), with_fields(rest, **{name: "double"}))
