"""Packing documents into sequences: dominance reduction on the counts of lengths, then best fit."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text
from tallyworks.llm.encoding import encoder, runs
from tallyworks.llm.workers import lean

MEMO_WORDS, RUN_BYTES = 100_000, 1 << 20  # less memory than encoding takes by default: it runs after other stages

Pattern = tuple[tuple[int, ...], int]  # lengths of the pieces of one sequence, number of such sequences


class Lengths:
    """A multiset of lengths with fast search."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: v for k, v in counts.items() if v > 0}
        self.sizes = sorted(self.counts)

    def take(self, items: tuple[int, ...], times: int) -> None:
        for size, each in Counter(items).items():
            self.counts[size] -= each * times
            if not self.counts[size]:
                del self.counts[size]
                del self.sizes[bisect_left(self.sizes, size)]

    def most(self, items: tuple[int, ...]) -> int:
        """How many times these items can be taken together."""
        return min(self.counts.get(size, 0) // each for size, each in Counter(items).items())

    def largest(self, limit: int, without: tuple[int, ...]) -> int:
        """The largest length up to `limit` that is left once `without` is set aside; 0 if none."""
        away = Counter(without)
        i = bisect_right(self.sizes, limit) - 1
        while i >= 0 and self.counts[self.sizes[i]] <= away[self.sizes[i]]:
            i -= 1
        return self.sizes[i] if i >= 0 else 0

    def smallest(self, k: int, without: tuple[int, ...]) -> list[int]:
        """The k smallest lengths left once `without` is set aside."""
        away, found = Counter(without), []
        for size in self.sizes:
            found += [size] * min(k - len(found), self.counts[size] - away[size])
            if len(found) == k:
                break
        return found


def dominating(left: Lengths, item: int, capacity: int) -> tuple[int, ...] | None:
    """A set with `item` that dominates every other feasible set with it, or None if none is proven.

    Nothing else fits: the item alone. One companion fills the room exactly, or is at least as large as any
    two that fit: that pair. At most two companions fit, k is the largest and l the largest beside it, and in
    any other pair the smaller one is at most l: those three. In each case the companions of every other set
    fit into the places of the chosen ones, so some best packing has the chosen set.
    """
    room = capacity - item
    one = left.largest(room, (item,))
    if not one:
        return (item,)
    if one == room:
        return (item, one)
    few = left.smallest(3, (item,))
    if len(few) < 2 or few[0] + few[1] > room:
        return (item, one)
    if len(few) == 3 and sum(few) <= room:
        return None
    pairs = [
        (a, b)
        for a in left.sizes[: bisect_right(left.sizes, room // 2)]
        if left.counts[a] > (a == item) and (b := left.largest(room - a, (item, a))) >= a
    ]
    if one >= max(map(sum, pairs)):
        return (item, one)
    two = left.largest(room - one, (item, one))
    return (item, one, two) if two and max(a for a, _ in pairs) <= two else None


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences that some best packing has, and what is left; lengths are tried from the largest down."""
    left, fixed = Lengths(counts), []
    for item in sorted(counts, reverse=True):
        while left.counts.get(item):
            chosen = dominating(left, item, capacity)
            if chosen is None:
                break
            times = left.most(chosen)  # taking away pieces keeps the proof, so it holds until one runs out
            left.take(chosen, times)
            fixed.append((chosen, times))
    return fixed, left.counts


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over counts: equal sequences are filled together, so the work follows the number
    of different lengths and not that of documents."""
    open_: dict[int, list[Pattern]] = defaultdict(list)
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], times: int) -> None:
        room = capacity - sum(pattern)
        if not open_[room]:
            rooms.insert(bisect_left(rooms, room), room)
        open_[room].append((pattern, times))

    for item in sorted((k for k, v in counts.items() if v), reverse=True):
        count = counts[item]
        while count:
            i = bisect_left(rooms, item)
            if i == len(rooms):
                each = capacity // item
                if whole := count // each:
                    put((item,) * each, whole)
                if rest := count % each:
                    put((item,) * rest, 1)
                break
            room = rooms[i]
            pattern, times = open_[room].pop()
            if not open_[room]:
                del rooms[i]
            each = min(room // item, count)
            used = min(times, count // each)
            if times > used:
                put(pattern, times - used)
            put(pattern + (item,) * each, used)
            count -= each * used
    return [p for group in open_.values() for p in group]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Every document as ids and `end_id`, cut into pieces of `capacity` ids; the last may be shorter.

    Columns: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), part, rank (number of the piece among those
    of its length in its part). A missing text is empty and gives one piece with the end id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, code = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), encoder(tokenizer, MEMO_WORDS)
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                flat, sizes = code.encode(batch["text"].slice(first, n), end=end_id)
                of_doc = -(-sizes // capacity)
                doc = np.repeat(np.arange(n), of_doc)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(of_doc) - of_doc, of_doc)
                length = np.minimum(sizes[doc] - piece * capacity, capacity)
                order = np.argsort(length, kind="stable")
                by_length = length[order]
                starts = np.searchsorted(by_length, by_length)
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - starts + seen[by_length]
                seen += np.bincount(length, minlength=capacity + 1)
                offsets = pa.array(np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, n).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity),
                        pa.array(length),
                        pa.BinaryArray.from_buffers(
                            pa.binary(), len(doc), [None, offsets.buffers()[1], pa.py_buffer(flat)]
                        ),
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(rank),
                    ],
                    ["doc_id", "piece", "start", "length", "ids", "part", "rank"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids binary, part int, rank long"
    return texts.mapInArrow(lean(cut, encodes=True), schema)


def pack(stored: DataFrame, capacity: int) -> DataFrame:
    """Stored pieces (with length, part and rank) and the sequence_id and offset of each.

    Only the number of pieces of each length, at most `capacity` numbers, reaches the driver. The plan is a
    list of patterns: the k-th piece of a length goes to the place that the patterns give this k. A piece
    knows its k from its rank within its part and the number of such pieces in the parts before.
    """
    in_part = stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("part")) - F.col("_n")
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # by length: times, offset, sequence
    sequence = 0
    for pattern, times in plan(counts, capacity):
        offset = 0
        for length in pattern:
            slots[length].append((times, offset, sequence))
            offset += length
        sequence += times
    table = {length: np.array(rows, np.int64) for length, rows in slots.items()}
    firsts = {length: np.cumsum(rows[:, 0]) - rows[:, 0] for length, rows in table.items()}

    numbered = stored.join(in_part.select("length", "part", before.alias("_before")), ["length", "part"])
    numbered = numbered.withColumn("_k", F.col("_before") + F.col("rank")).drop("_before", "rank", "part")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, k = batch["length"].to_numpy(), batch["_k"].to_numpy()
            sequence_id, offset = np.empty(len(k), np.int64), np.empty(len(k), np.int64)
            for each in np.unique(length):
                rows = np.flatnonzero(length == each)
                slot = np.searchsorted(firsts[each], k[rows], "right") - 1
                sequence_id[rows] = table[each][slot, 2] + k[rows] - firsts[each][slot]
                offset[rows] = table[each][slot, 1]
            kept = [batch[c] for c in batch.schema.names if c != "_k"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence_id), pa.array(offset)], names)

    names = [c for c in numbered.columns if c != "_k"] + ["sequence_id", "offset"]
    types = dict(numbered.dtypes)
    schema = ", ".join(f"`{c}` {types.get(c, 'bigint')}" for c in names)
    return numbered.mapInArrow(lean(place), schema)
