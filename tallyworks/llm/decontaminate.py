"""Benchmark leaks by latent semantic retrieval, checked word by word.

Documents and benchmark items are read as sequences of benchmark words. Windows of the documents are passages; a
randomised singular value decomposition of their TF-IDF matrix, computed over all of them in two distributed
passes, gives a latent space. Windows near an item in that space are candidates; the longest common subsequence
of words, and for paraphrases the item's answer, decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import bounded, free_name, whole_text
from tallyworks.llm.encoding import runs
from tallyworks.llm.workers import lean
from tallyworks.sources.workspace import written

ITEMS = 500  # benchmark items whose passages a task compares with its windows at once
PASSAGE = 64  # words of a document passage, and of an item passage at most
SCALES = ((64, 16), (24, 8))  # windows that are searched: words, words between their beginnings
NARROW = (10, 3)  # the same for items of fewer than LEAST_WORDS words, which wider windows would drown
RANK, EXTRA = 24, 8  # leading dimensions of the latent space, and more that the random projection takes
RESIDUAL = 72  # random dimensions for what the leading ones leave
STOP_SHARE = 0.01  # words in more than this share of all passages have no weight,
OWN_WORDS = 8  # unless they are among so many rarest words of an item passage
LEAST_WEIGHTED = 4  # words with a weight that a window must have to be compared, if all item passages have as many
NEAR = 0.33  # cosine of a candidate, at least
LEAK = 0.8  # share of an item's words in common order that makes a leak
PARAPHRASE = 0.5  # the same where the passage also has the item's answer
ANSWER_WORDS = 5  # an answer is the last sentence of an item, and so many words at least
RUN_BYTES = 1 << 20  # texts and numbered words are taken in runs of about this size: a word needs 400 bytes and more
WINDOWS, CHECKED = 10_000, 5_000  # windows that are compared, and candidates whose words are counted, at once
LEAST_WORDS = 8  # items with fewer words say too little and match only as a whole

SENTENCE = re.compile(r"[.!?\n]+")
GAPS = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"  # what str.split takes beyond ASCII's


def plain(word: str) -> str:
    """Letters and digits of a word, in lower case."""
    return word.lower() if word.isalnum() else "".join(c for c in word.lower() if c.isalnum())


def words_of(text: str) -> list[str]:
    return [w for w in map(plain, text.split()) if w]


@dataclass(frozen=True)
class Passage:
    """A piece of a benchmark item: numbers of its words, and how many at its end are the answer."""

    item_id: int
    words: tuple[int, ...]
    answer: int

    def masks(self) -> dict[int, int]:
        out: dict[int, int] = {}
        for i, w in enumerate(self.words):
            out[w] = out.get(w, 0) | 1 << i
        return out


def passages_of(items: list[tuple[int, str]], number: dict[str, int]) -> list[Passage]:
    """Items in pieces of at most PASSAGE words, of about equal size."""
    found = []
    for item_id, text in items:
        words = [number[w] for w in words_of(text)]
        last = next((n for s in reversed(SENTENCE.split(text)) if (n := len(words_of(s)))), 0)
        count = -(-len(words) // PASSAGE)
        bounds = [len(words) * i // max(1, count) for i in range(count + 1)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            answer = min(b - a, max(ANSWER_WORDS, last)) if b == len(words) else 0
            found.append(Passage(item_id, tuple(words[a:b]), answer))
    return found


def common(masks: dict[int, int], m: int, words: list[int]) -> int:
    """Length of the longest common subsequence, one bit for each of the m words behind `masks`."""
    row = full = (1 << m) - 1
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return m - row.bit_count()


def holds(words: list[int], part: tuple[int, ...]) -> bool:
    """Does the sequence have the part, word after word?"""
    return any(words[i] == part[0] and tuple(words[i : i + len(part)]) == part for i in range(len(words) - len(part) + 1))


def leaks(passage: Passage, masks: dict[int, int], words: list[int]) -> float:
    """The share of the passage's words that `words` has in common order, 0 if that is no leak."""
    m = len(passage.words)
    share = common(masks, m, words) / m
    if m < LEAST_WORDS:
        return share if holds(words, passage.words) else 0.0
    if share >= LEAK:
        return share
    answer = passage.words[m - passage.answer :] if passage.answer else ()
    return share if share >= PARAPHRASE and answer and holds(words, answer) else 0.0


def word_lists(texts: pa.Array) -> tuple[pa.Array, pa.Array, list[str]]:
    """The words of each text between all Unicode white space, as for items; those in a row, coded; the distinct ones."""
    while True:
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        listed = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if all(w.isalnum() or len(w.split()) < 2 for w in listed):
            return split, coded, listed
        texts = pc.replace_substring_regex(texts, GAPS, " ")


def numbered(docs: DataFrame, number: dict[str, int]) -> DataFrame:
    """doc_id and words: each document as 32-bit numbers of its words, 0 for words that no item has."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get

        def marked(word: str) -> int:
            return find(p, 0) if (p := plain(word)) else -1

        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                split, coded, listed = word_lists(batch["text"].slice(first, n).cast(pa.large_string()))
                numbers = [find(w.lower(), 0) if w.isalnum() else marked(w) for w in listed]
                at = np.array(numbers, np.int32)[coded.indices.to_numpy()]
                ends = np.concatenate([[0], np.cumsum(at >= 0)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
                offsets = pa.array((4 * ends).astype(np.int32))
                words = at[at >= 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, n),
                        pa.BinaryArray.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(words)]),
                    ],
                    ["doc_id", "words"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    return texts.mapInArrow(lean(encode), "doc_id long, words binary")


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """doc_ids, all words in a row, and the bounds of the documents in them."""
    for batch in batches:
        for first, n in runs(batch["words"], RUN_BYTES):
            part = batch["words"].slice(first, n)
            sizes = pc.binary_length(part).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            words = np.frombuffer(b"".join(part.to_pylist()), np.int32)
            yield batch["doc_id"].slice(first, n), words, np.concatenate([[0], np.cumsum(sizes)])


def windows(bounds: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, beginning and end of all windows: every `step` words, the last one at the end of its document."""
    n = np.diff(bounds)
    count = np.where(n > 0, -(-np.maximum(0, n - size) // step) + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    i = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(i * step, np.maximum(0, n[doc] - size)) + bounds[doc]
    return doc, start, np.minimum(start + size, bounds[doc + 1])


def chunks(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Beginning and end of the pieces of `size` words that cut up every document; the last may be shorter."""
    count = -(-np.diff(bounds) // size)
    first = np.repeat(bounds[:-1], count) + size * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    return first, np.minimum(first + size, np.repeat(bounds[1:], count))


def running_sums(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Row i is the sum of the table's rows over the first i words that are not 0."""
    rows = table[words[words > 0]]
    return np.concatenate([np.zeros((1, table.shape[1]), np.float32), np.cumsum(rows, axis=0)])


def sums(table: np.ndarray, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The sum of the table's rows over the words of each window."""
    known, running = np.flatnonzero(words), running_sums(table, words)
    return running[np.searchsorted(known, end)] - running[np.searchsorted(known, start)]


def added(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the tasks' arrays, which come as pieces (piece, data); Spark adds equal pieces up."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in table["data"].to_pylist())
        return pa.table({"piece": table["piece"][:1], "data": [total.tobytes()]})

    rows = parts.groupBy("piece").applyInArrow(lean(add), "piece int, data binary").collect()
    flat = np.concatenate([np.frombuffer(r["data"], np.float64) for r in sorted(rows)] or [np.zeros(0)])
    return flat.reshape(shape) if len(flat) else np.zeros(shape)


def pieces(total: np.ndarray, count: int = 32) -> pa.RecordBatch:
    parts = np.array_split(np.asarray(total, np.float64).ravel(), count)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["piece", "data"]
    )


@dataclass(frozen=True)
class LatentSpace:
    idf: np.ndarray  # of each word number, 0 for stop words
    axes: np.ndarray  # word x dimension

    def table(self) -> np.ndarray:
        return (self.axes * self.idf[:, None]).astype(np.float32)

    def of(self, passages: list[Passage]) -> np.ndarray:
        table = self.table()
        vectors = np.array([table[list(p.words)].sum(0) for p in passages]).reshape(-1, table.shape[1])
        return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def inverse_frequencies(counts: np.ndarray, total: float, passages: list[Passage]) -> np.ndarray:
    """idf of each word number by the passages it is in; 0 for no word and for stop words."""
    stop = counts > STOP_SHARE * total
    for p in passages:
        stop[sorted(set(p.words), key=lambda w: (counts[w], w))[:OWN_WORDS]] = False
    stop[0] = True
    return np.where(stop, 0.0, np.log((1 + total) / (1 + counts)) + 1e-6)


def latent_space(stored: DataFrame, vocabulary: int, passages: list[Passage]) -> LatentSpace:
    """Randomised SVD of the TF-IDF matrix of all passages of PASSAGE words, `vocabulary` words and one for none.

    With random directions W, one pass gives A'AW and so an orthonormal basis Q of about the leading right
    singular vectors; a second one gives the small matrix (AQ)'AQ, whose eigenvectors turn Q into their order.
    """
    schema, size = "piece int, data binary", vocabulary + 1

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1)
        for _, words, bounds in sequences(batches):
            start, end = chunks(bounds, PASSAGE)
            known = np.flatnonzero(words)
            passage = np.searchsorted(end, known, "right")
            once = pd.unique(passage * size + words[known])
            total[:size] += np.bincount(once % size, minlength=size)
            total[size] += len(start)
        yield pieces(total)

    counts = added(stored.mapInArrow(lean(frequencies), schema), (size + 1,))
    idf = inverse_frequencies(counts[:size], counts[size], passages)
    rank = min(RANK + EXTRA, vocabulary)

    def passage_sums(table, words, bounds):
        start, end = chunks(bounds, PASSAGE)
        words = np.where(idf[words] > 0, words, 0)
        known = np.flatnonzero(words)
        return sums(table, words, start, end), np.searchsorted(end, known, "right"), words[known]

    random = np.random.default_rng(0).standard_normal((size, rank))
    first = (random * idf[:, None]).astype(np.float32)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, rank))
        for _, words, bounds in sequences(batches):
            projected, passage, word = passage_sums(first, words, bounds)
            order = np.argsort(word, kind="stable")
            present, at = np.unique(word[order], return_index=True)
            if len(present):
                total[present] += np.add.reduceat(projected[passage[order]], at, axis=0)
        yield pieces(total * idf[:, None])

    basis, _ = np.linalg.qr(added(stored.mapInArrow(lean(spread), schema), (size, rank)))
    second = (basis * idf[:, None]).astype(np.float32)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for _, words, bounds in sequences(batches):
            projected, _, _ = passage_sums(second, words, bounds)
            total += projected.T @ projected
        yield pieces(total)

    values, turn = np.linalg.eigh(added(stored.mapInArrow(lean(small), schema), (rank, rank)))
    leading = basis @ turn[:, np.argsort(-values)[:RANK]]
    # Words that hardly any passage has are in no leading direction, and cosines of passages made of them would
    # be noise. What the leading directions leave of each word is kept in random ones, which preserve inner
    # products up to about 1 / sqrt(RESIDUAL).
    rest = np.random.default_rng(1).standard_normal((size, RESIDUAL)) / np.sqrt(RESIDUAL)
    return LatentSpace(idf, np.hstack([leading, rest - leading @ (leading.T @ rest)]))


FOUND = "doc_id long, item_id long, start long, end long, share double, cosine double"


@dataclass(frozen=True)
class Searched:
    """Passages of some items with what the search needs of them, in arrays over the words that they have."""

    passages: list[Passage]
    local: np.ndarray  # of each word number, its place among these words, 0 for others
    table: np.ndarray  # latent vector of each of these words
    vectors: np.ndarray  # of each passage
    parts: np.ndarray  # passage x word: 1 for a weighted word of the passage, 3 for one of its answer
    answers: np.ndarray  # weighted words of each answer
    size: np.ndarray  # words of each passage
    leak: np.ndarray  # weighted words that a leak must share at least
    paraphrase: np.ndarray  # the same for a paraphrase
    least: int  # weighted words of a window that is worth a look

    @staticmethod
    def of(passages: list[Passage], space: LatentSpace) -> Searched:
        known = np.array(sorted({w for p in passages for w in p.words}), np.int64)
        local = np.zeros(len(space.idf), np.int32)
        local[known] = np.arange(1, len(known) + 1)
        weight = np.concatenate([[0.0], space.idf[known]])
        rare = np.zeros((len(passages), len(weight)), bool)
        answer = np.zeros_like(rare)
        for i, p in enumerate(passages):
            rare[i, local[list(p.words)]] = True
            answer[i, local[list(p.words[len(p.words) - p.answer :])]] = True
        rare &= weight > 0
        answer &= weight > 0
        size = np.array([len(p.words) for p in passages])
        stops = np.array([sum(space.idf[w] == 0 for w in p.words) for p in passages])
        leak = np.where(size < LEAST_WORDS, size, np.ceil(LEAK * size)) - stops
        paraphrase = np.where(answer.any(1), np.ceil(PARAPHRASE * size) - stops, size + 1)
        parts = rare.astype(np.uint8) | answer.astype(np.uint8) << 1
        least = min(LEAST_WEIGHTED, int(rare.sum(1).min(initial=LEAST_WEIGHTED)))
        return Searched(
            passages,
            local,
            np.concatenate([np.zeros((1, space.axes.shape[1]), np.float32), space.table()[known]]),
            space.of(passages),
            parts,
            answer.sum(1),
            size,
            np.maximum(1, leak),
            np.maximum(1, paraphrase),
            least,
        )

    def near(self, words: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """document, passage, beginning and end of the part to check, and cosine of the windows of all scales that
        are near a passage and have enough of its weighted words around them."""
        words = self.local[words]
        weighted = np.where(self.table.any(1)[words], words, 0)
        before = np.concatenate([[0], np.cumsum(weighted > 0)])  # weighted words before each position
        running = running_sums(self.table, weighted)
        found = [[np.zeros(0, np.int64)] * 5]
        for size, step in SCALES:
            found += self._near(windows(bounds, size, step), bounds, weighted, before, running, np.arange(len(self.size)))
        short = np.flatnonzero(self.size < LEAST_WORDS)
        if len(short):
            found += self._near(windows(bounds, *NARROW), bounds, weighted, before, running, short)
        return [np.concatenate(x) for x in zip(*found, strict=True)]

    def _near(self, places, bounds, weighted, before, running, among):
        doc, start, end = places
        worth = before[end] - before[start] >= self.least
        doc, start, end = doc[worth], start[worth], end[worth]
        for first in range(0, len(doc), WINDOWS):
            part = slice(first, first + WINDOWS)
            inside = running[before[end[part]]] - running[before[start[part]]]
            inside /= np.maximum(np.linalg.norm(inside, axis=1), 1e-6)[:, None]
            cosine = inside @ self.vectors[among].T
            row, place = np.nonzero(cosine >= NEAR)
            d, item, value = doc[part][row], among[place], cosine[row, place]
            margin = self.size[item] * 3 // 4
            a = np.maximum(bounds[d], start[part][row] - margin)
            b = np.minimum(bounds[d + 1], end[part][row] + margin)
            enough = np.zeros(len(row), bool)
            for some in range(0, len(row), CHECKED):
                g = slice(some, some + CHECKED)
                at = a[g][:, None] + np.arange((b[g] - a[g]).max())
                w = np.where(at < b[g][:, None], weighted[np.minimum(at, len(weighted) - 1)], 0)
                said = self.parts[item[g][:, None], w]
                shared, answered = np.count_nonzero(said, axis=1), np.count_nonzero(said == 3, axis=1)
                enough[g] = (shared >= self.leak[item[g]]) | (
                    (shared >= self.paraphrase[item[g]]) & (answered >= self.answers[item[g]])
                )
            yield [x[enough] for x in (d, item, a, b, value)]


def search(stored: DataFrame, passages: list[Passage], space: LatentSpace) -> DataFrame:
    """doc_id, item_id, start and end (words), share (of the passage's words in common order) and cosine of the
    leaks in numbered documents; at most one for each document and item passage, the nearest window that is one."""
    ids = sorted({p.item_id for p in passages})
    blocks = [set(ids[i : i + ITEMS]) for i in range(0, len(ids), ITEMS)]
    parts = [Searched.of([p for p in passages if p.item_id in block], space) for block in blocks]
    shared = stored.sparkSession.sparkContext.broadcast(parts)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [(wanted, [p.masks() for p in wanted.passages]) for wanted in shared.value]
        for doc_ids, words, bounds in sequences(batches):
            rows = []
            for wanted, masks in searched:
                doc, item, start, end, cosine = wanted.near(words, bounds)
                done = None
                for i in np.lexsort((-cosine, item, doc)):
                    key = doc[i], item[i]
                    if key == done:
                        continue
                    passage = wanted.passages[item[i]]
                    share = leaks(passage, masks[item[i]], words[start[i] : end[i]].tolist())
                    if share:
                        done, base = key, bounds[doc[i]]
                        rows.append((doc[i], passage.item_id, start[i] - base, end[i] - base, share, float(cosine[i])))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(columns[0], pa.int64()))]
                + [pa.array(columns[k], pa.int64()) for k in (1, 2, 3)]
                + [pa.array(columns[k], pa.float64()) for k in (4, 5)],
                ["doc_id", "item_id", "start", "end", "share", "cosine"],
            )

    return stored.mapInArrow(lean(find), FOUND)


def leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The leaks of `benchmark` (item_id, text) in `docs` (doc_id, text): doc_id, item_id, start, end, share, cosine.

    start and end are the word positions of the checked part of the document. Whole texts are searched. The
    benchmark is taken whole, by the driver and by every task: the documents are stored once as numbers of its words,
    and read four times however many items there are; a task compares its windows with ITEMS items at once. Rows
    without item_id or without a word are no items. Repeated documents are found each; missing texts have no leaks; a
    missing doc_id stays missing.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    rows = sorted((r["item_id"], r["text"]) for r in items.collect())
    known = sorted({w for _, text in rows for w in words_of(text)})
    if not known:
        return docs.sparkSession.createDataFrame([], FOUND)
    number = {w: i + 1 for i, w in enumerate(known)}
    passages = passages_of(rows, number)
    stored = written(numbered(docs, number), "numbered")
    return written(search(stored, passages, latent_space(stored, len(known), passages)), "leaks")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, whose text has no leak of `benchmark`."""
    row = F.xxhash64(docs["doc_id"], whole_text(docs))  # an id may stand for several texts
    found = leaked(docs.select(row.alias("doc_id"), "text"), benchmark)
    name = free_name(docs, "_leak")
    ids = written(found.select(F.col("doc_id").alias(name)).distinct(), "leaked-rows")
    return docs.join(bounded(ids), row == F.col(name), "left_anti")
