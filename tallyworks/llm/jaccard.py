"""Exact Jaccard join of word shingles: prefix filter for candidates, a prefix tree for the links.

1. Every document becomes the sorted set of hashes of its distinct shingles; equal sets are one node.
2. A global order puts shared shingles after unique ones, and frequent ones last. Two sets that are similar enough
   share one of their first n - ceil(t n) + 1 shingles in any common order. Sets that share one are candidates;
   their connected groups are small, because frequent shingles hardly ever come that early.
3. The sets of a group go into a trie, the group's frequent shingles first. A query walks it with one running
   overlap for all sets below a node and leaves out subtrees whose sizes and remaining shingles cannot reach
   the threshold. One central set is asked first: whatever it links is one component already, and only sets
   it does not reach are asked too. That gives every component without all pairs of its members.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import bounded, free_name, join_hot, whole_text, with_fields
from tallyworks.llm.encoding import runs
from tallyworks.llm.graph import components, spanning
from tallyworks.llm.workers import lean, release
from tallyworks.sources.workspace import released_everywhere, written

WORDS = 5
FREQUENT = 1 << 20  # shingles whose frequency is part of the order, at most; the most frequent ones
SHARED_BITS, MOST_SHARED = 21, 30  # bits of a bucket, and of all, that say which shingles several sets have: 2^21, 2^30
SLOT_BITS = 24  # of a hash that count shingles within a bucket
BUCKET_SHINGLES, MOST_BUCKETS = 21, 16  # as powers of two: shingles of a bucket, about, and buckets
MATCH_BITS = 40  # of a hash that say within a bucket whether two sets share a shingle; a chance match is checked later
CODEC = "zstd"  # of those bits on their way through the driver; few are set as long as there are many for the data
FLUSH = 1_000_000  # shingles a task holds before it sends them on
RUN_BYTES = 1 << 20  # texts are taken in runs of about this size
SPARSE = 16
HELD_LINKS = 1_000_000  # a task that asks holds so many before it drops those that connect nothing new
BLOCK_BYTES = 1 << 19  # sets of a group that one task compares, about; larger groups are cut into blocks
MOST_BLOCKS, MOST_BLOCK_BYTES = 256, 32 << 20  # more blocks only once they are as large as a task should hold


class Threshold:
    """similarity >= percent / 100, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def similar(self, overlap: int, n: int, m: int) -> bool:
        return 100 * overlap >= self.percent * (n + m - overlap)

    def prefix(self, n: int) -> int:
        """So many first shingles of a set of n; with an overlap of ceil(t n) at least, one of them is shared."""
        return n + (-self.percent * n // 100) + 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer words is one shingle, a text
    without words has none. Hashes have 64 bits: two shingles of one pair of sets, or two sets of the corpus,
    are mixed up with a chance of about their number squared over 2^65.
    """
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = split.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    ends = np.concatenate([[0], np.cumsum(real)])[offsets]
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w.encode().lower()) for w in distinct), np.uint64, len(distinct))
    w = of_word[coded.indices.to_numpy()[real]]
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(max(0, len(w) - words + 1), np.uint64)
    for k in range(words):
        h = h * multiplier + w[k : k + len(h)]
    h, sets = mixed(h), []
    for first, end in zip(ends[:-1], ends[1:], strict=True):
        if end - first >= words:
            sets.append(np.unique(h[first : end - words + 1]))
        else:
            short = np.array([end - first], np.uint64)  # its length tells it from whole shingles
            for k in range(first, end):
                short = short * multiplier + w[k]
            sets.append(mixed(mixed(short)) if end > first else np.zeros(0, np.uint64))
    return sets


def node_of(hashes: np.ndarray) -> int:
    """One number for a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"))


def set_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and node (NULL without words) of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                sets = shingle_sets(batch["text"].slice(first, n), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, n),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "node"],
                )

    return texts_of(docs).mapInArrow(lean(describe), "doc_id long, n_shingles long, node long")


def distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """node and hashes of each set that the task has not met yet."""
    met: set[int] = set()
    for batch in batches:
        for first, n in runs(batch["text"], RUN_BYTES):
            for hashes in shingle_sets(batch["text"].slice(first, n)):
                if len(hashes) and (node := node_of(hashes)) not in met:
                    met.add(node)
                    yield node, hashes


def bucket_bits(docs: DataFrame, shingles: int = 0) -> int:
    """Buckets of hashes, as a power of two: at least as many as there are shuffle partitions, and for `shingles` in all
    more, if these are too few for them: a bucket is counted by one task at a time, and its numbers must stay rare."""
    partitions = (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    return max(1, partitions, min(MOST_BUCKETS, max(0, shingles - 1).bit_length() - BUCKET_SHINGLES))


def shingles_of(sets: DataFrame) -> int:
    """The number of shingles of all rows of a stored table of sets."""
    return sets.agg(F.sum("n_shingles")).first()[0] or 0


def by_bucket(bits: int, keys: np.ndarray, columns: list[np.ndarray], names: list[str], key_bits: int = 0) -> pa.RecordBatch:
    """Rows of (bucket, packed columns): the first bits of the key say which bucket. With `key_bits`, the next so many
    bits of the keys come first, as the column "slots" of their gaps; `names` has it too."""
    order = np.argsort(keys, kind="stable")
    bucket = (keys[order] >> np.uint64(64 - bits)).astype(np.int64)
    present, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(bucket))
    packed = [pa.array([c[order[a:b]].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()) for c in columns]
    if key_bits:
        slots = keys[order] >> np.uint64(64 - bits - key_bits) & np.uint64((1 << key_bits) - 1)
        packed.insert(0, pa.array([gaps_packed(slots[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(present, pa.int64()), *packed], ["bucket", *names])


def gaps_packed(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as their gaps, seven bits a byte, the last byte of each below 128."""
    gap = np.diff(values, prepend=values.dtype.type(0))
    size = np.ones(len(gap), np.int64)
    for bits in range(7, 64, 7):
        size += gap >= 1 << bits
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        more = np.where(size[has] > k + 1, 128, 0)
        out[ends[has] - size[has] + k] = (gap[has] >> gap.dtype.type(7 * k) & gap.dtype.type(127)).astype(np.uint8) | more.astype(np.uint8)
    return out.tobytes()


def gaps_unpacked(data: bytes) -> np.ndarray:
    """The numbers that `gaps_packed` was given, with 64 bits."""
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    parts = (raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.cumsum(np.add.reduceat(parts, first) if len(first) else parts, dtype=np.uint64)


def unpacked(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


@dataclass
class Order:
    """How late a shingle comes in the global order: unique ones first, then those of several sets, at last the most
    frequent ones by the logarithm of the number of sets."""

    bits: int  # of a bucket
    keys: np.ndarray  # the first SLOT_BITS + bits bits of the hashes of the most frequent shingles, in order
    levels: np.ndarray
    shared: dict[int, bytes]  # by bucket, compressed: a bit for each beginning of a hash that a shingle of several sets has
    shared_bits: int  # length of such a beginning
    unpacked: np.ndarray | None = None  # these bits, of all buckets

    def flags(self) -> np.ndarray:
        """The bits of all buckets in one array, made by each worker once; the driver only hands on compressed ones."""
        if self.unpacked is None:
            size = max(1, (1 << self.shared_bits - self.bits) >> 3)
            self.unpacked = np.zeros((1 << self.bits) * size, np.uint8)
            while self.shared:  # a worker keeps the order, so each piece goes as soon as it is in its place
                bucket, piece = self.shared.popitem()
                self.unpacked[bucket * size : (bucket + 1) * size] = np.frombuffer(pa.decompress(piece, size, CODEC), np.uint8)
        return self.unpacked

    def level(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.shared_bits)
        level = self.flags()[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1
        if len(self.keys):
            key = hashes >> np.uint64(64 - SLOT_BITS - self.bits)
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            level = np.where(self.keys[place] == key, self.levels[place] + 1, level)
        return level


def shingle_order(docs: DataFrame, limit: int = FREQUENT, shingles: int = 0) -> Order:
    """The order of the shingles of `docs`; `limit` is the number of the most frequent ones that have a level each.

    All shingles of all distinct sets of a task are counted, as SLOT_BITS bits in a bucket; the buckets grow with the
    number of `shingles`, so the chance that two of them share a number, and come in the order with the
    sum of both, stays the same. The bits of those that several sets have grow with the buckets, up to MOST_SHARED.
    Any order finds all links; one that puts fewer shared shingles first has fewer candidates.
    """
    bits = bucket_bits(docs, shingles)
    share = max(1, limit >> bits) if limit else 0
    own_bits = min(SHARED_BITS, max(0, MOST_SHARED - bits))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            return by_bucket(bits, np.concatenate(held), [], ["slots"], SLOT_BITS)

        held, size = [], 0
        for _, hashes in distinct_sets(batches):
            held.append(hashes)
            size += len(hashes)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        slots, n = np.unique(np.concatenate([gaps_unpacked(x) for x in table["slots"].to_pylist()]), return_counts=True)
        several = np.flatnonzero(n > 1)
        flags = np.zeros(max(8, 1 << own_bits), bool)
        flags[slots[several] >> np.uint64(SLOT_BITS - own_bits)] = True
        top = np.sort(several[np.argsort(-n[several], kind="stable")[:share]])
        keys = slots[top] | np.uint64(bucket << SLOT_BITS)
        return pa.table(
            {
                "bucket": [bucket],
                "keys": [keys.tobytes()],
                "level": [np.log2(n[top]).astype(np.uint8).tobytes()],
                "shared": [pa.compress(np.packbits(flags), CODEC, asbytes=True)],
            }
        )

    sent = texts_of(docs).mapInArrow(lean(send), "bucket long, slots binary")
    counted = sent.groupBy("bucket").applyInArrow(lean(count), "bucket long, keys binary, level binary, shared binary")
    found = counted.collect()  # at most FREQUENT keys, and 2^MOST_SHARED bits, compressed
    keys = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in found] or [np.zeros(0, np.uint64)])
    levels = np.concatenate([np.frombuffer(r["level"], np.uint8) for r in found] or [np.zeros(0, np.uint8)])
    shared = {r["bucket"]: bytes(r["shared"]) for r in found}
    order = np.argsort(keys)
    return Order(bits, keys[order], levels[order], shared, bits + own_bits)


def candidate_links(docs: DataFrame, threshold: Threshold, limit: int = FREQUENT, shingles: int = 0) -> DataFrame:
    """Links (a, b) whose connected groups hold every similar pair of nodes.

    Sets that share a shingle of their prefixes are chained by size; a chain breaks where the next set is too
    large to be similar to the one before, and so to any smaller one.
    """
    bits = bucket_bits(docs, shingles)
    shared = docs.sparkSession.sparkContext.broadcast(shingle_order(docs, limit, shingles))
    release()
    released_everywhere(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value

        def flush():
            h = np.concatenate([x[0] for x in held])
            sizes = [len(x[0]) for x in held]
            nodes = np.repeat(np.array([x[1] for x in held], np.int64), sizes)
            n = np.repeat(np.array([x[2] for x in held], np.uint32), sizes)
            return by_bucket(bits, h, [nodes, n], ["slots", "node", "n"], MATCH_BITS)

        held, size = [], 0
        for node, hashes in distinct_sets(batches):
            first = threshold.prefix(len(hashes))
            level = order.level(hashes)
            chosen = hashes[np.argsort(level, kind="stable")[:first]] if level.any() else hashes[:first]
            held.append((chosen, node, len(hashes)))
            size += first
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def chain(table: pa.Table) -> pa.Table:
        h = np.concatenate([gaps_unpacked(x) for x in table["slots"].to_pylist()])
        node, n = unpacked(table["node"], "<i8"), unpacked(table["n"], "<u4")
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        order = order[np.lexsort((node[order], n[order], h[order]))]
        h, node, n = h[order], node[order], n[order].astype(np.int64)
        near = (h[1:] == h[:-1]) & (node[1:] != node[:-1]) & (100 * n[:-1] >= threshold.percent * n[1:])
        pairs = np.stack([node[:-1][near], node[1:][near]], axis=1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    sent = texts_of(docs).mapInArrow(lean(send), "bucket long, slots binary, node binary, n binary")
    return sent.groupBy("bucket").applyInArrow(lean(chain), "a long, b long")


class Trie:
    """Sorted sets of small numbers, with shared beginnings stored once.

    A node is (segment, depth below it, least and largest set below, children, sets that end here).
    """

    def __init__(self, sets: list[np.ndarray], vocabulary: int, threshold: Threshold):
        self.sets, self.threshold, self.mask = sets, threshold, np.zeros(vocabulary, bool)
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.root = self._built(order)

    def _built(self, order: list[int]):
        """The root. Sets that contain each other nest as deep as their number, so nodes to be built wait on a list."""
        ordered = [self.sets[i] for i in order]
        sizes = np.array([len(s) for s in ordered], np.int64)
        top: list = []
        todo = [(0, len(order), 0, 0, top)]
        while todo:
            # The sets low..high agree up to `depth`; the node's segment begins at `start`.
            low, high, start, depth, siblings = todo.pop()
            rest = low
            while rest < high and sizes[rest] == depth:  # a set that ends here sorts before those that go on
                rest += 1
            segment = ordered[low][start:depth] if high > low else np.zeros(0, np.uint32)
            small, large = (int(sizes[low:high].min()), int(sizes[low:high].max())) if high > low else (0, 0)
            below: list = []
            siblings.append((segment, depth, small, large, below, order[low:rest]))
            while rest < high:
                token = ordered[rest][depth]
                end = rest + 1
                while end < high and ordered[end][depth] == token:
                    end += 1
                first, last = ordered[rest], ordered[end - 1]
                n = min(len(first), len(last))
                differs = np.flatnonzero(first[depth:n] != last[depth:n])
                todo.append((rest, end, depth, depth + int(differs[0]) if len(differs) else n, below))
                rest = end
        return top[0]

    def similar_to(self, query: np.ndarray) -> list[int]:
        """All sets similar to the query."""
        t, n, found = self.threshold, len(query), []
        least = -(-t.percent * n // 100)
        self.mask[query] = True
        todo = [(self.root, 0)]
        while todo:
            (segment, depth, small, large, below, here), overlap = todo.pop()
            if large < least or 100 * n < t.percent * small:
                continue
            if len(segment):
                overlap += int(np.count_nonzero(self.mask[segment]))
                left = n - int(np.searchsorted(query, segment[-1], "right"))
            else:
                left = n
            if not t.similar(overlap + min(left, large - depth), n, max(small, least)):
                continue
            found += [i for i in here if t.similar(overlap, n, depth)]
            todo += [(node, overlap) for node in below]
        self.mask[query] = False
        return found


def ranked(sets: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The sets in numbers of the group, frequent shingles first, and the number of sets of each."""
    flat = np.concatenate(sets)
    values, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.uint32)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(values))
    bounds = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(r) for r in np.split(rank[at], bounds)], np.sort(count)[::-1]


def group_links(nodes: list[int], sets: list[np.ndarray], threshold: Threshold) -> list[tuple[int, int]]:
    """Links that connect the same nodes as all similar pairs of the group do.

    Sets are left out first as long as too few of their shingles occur in any other set that is left.
    """
    while True:
        numbers, count = ranked(sets)
        keep = [i for i, s in enumerate(numbers) if 100 * int((count[s] > 1).sum()) >= threshold.percent * len(s)]
        if len(keep) == len(sets):
            break
        nodes, sets = [nodes[i] for i in keep], [sets[i] for i in keep]
        if len(sets) < 2:
            return []
    trie = Trie(numbers, len(count), threshold)
    central = max(range(len(sets)), key=lambda i: (count[numbers[i]].mean(), -i))
    reached = set(trie.similar_to(numbers[central]))
    links = [(nodes[central], nodes[i]) for i in reached if i != central]
    for i in range(len(sets)):
        if i not in reached:
            links += [(nodes[i], nodes[j]) for j in one_of_each(trie.similar_to(numbers[i]), reached) if j != i]
    return links


def one_of_each(found: list[int], reached: set[int]) -> list[int]:
    """The found sets, those that are connected already as one."""
    known = [j for j in found if j in reached][:1]
    return known + [j for j in found if j not in reached]


def member_texts(docs: DataFrame, members: DataFrame, words: int = WORDS) -> DataFrame:
    """The text of each member (doc_id, node and other columns), and those columns.

    An id, or none, may stand for many texts, so rows are joined by their own node too. Copies within a task go
    on once.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple] = set()
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                part = batch.slice(first, n)
                nodes = [node_of(s) if len(s) else None for s in shingle_sets(part["text"], words)]
                new = []
                for i, key in enumerate(zip(part["doc_id"].to_pylist(), nodes, strict=True)):
                    if key[1] is not None and key not in met:
                        met.add(key)
                        new.append(i)
                own = pa.array(nodes, pa.int64())
                made = pa.RecordBatch.from_arrays([part["doc_id"], own, part["text"]], ["_doc", "_own", "text"])
                yield made.take(pa.array(new, pa.int64()))

    marked = texts_of(docs).mapInArrow(lean(mark), "_doc long, _own long, text string")
    same = F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_own") == F.col("node"))
    return marked.join(bounded(members), same).select("text", *members.columns)


def packed_sets(docs: DataFrame, members: DataFrame, words: int = WORDS) -> DataFrame:
    """The shingle hashes of the members (stored; doc_id, node and other columns): those columns and hashes, a row a node.

    Only ids that come again with their text, in several tasks, bring a node more than once; without any, as the numbers
    of rows tell, the hashes are not shuffled.
    """
    kept = members.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                part = batch.slice(first, n)
                hashes = pa.array([s.tobytes() for s in shingle_sets(part["text"], words)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), hashes], [*kept, "hashes"])

    types = dict(members.dtypes)
    # Stored in between: two steps in Python in one stage would need, and keep, two workers a core.
    texts = written(member_texts(docs, members, words), "member-texts")
    packed = texts.mapInArrow(
        lean(pack), ", ".join(f"{c} {types[c]}" for c in kept) + ", hashes binary"
    )
    return packed if texts.count() == members.count() else packed.dropDuplicates(["node"])


GroupLinks = Callable[[list[int], list[np.ndarray], Threshold], list[tuple[int, int]]]


def small_group_links(
    texts: DataFrame, threshold: Threshold, group_links: GroupLinks = group_links, words: int = WORDS, shingles: int = 0
) -> DataFrame:
    """Links of groups that a task can hold; `texts` has root, node and text. Tasks take many groups each.

    Texts are sent to the tasks, which make the sets: hashes of shingles do not compress, and take more room.
    """

    def link(table: pa.Table) -> pa.Table:
        groups: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
        for batch in table.to_batches():
            roots, nodes = batch["root"].to_pylist(), batch["node"].to_pylist()
            for first, n in runs(batch["text"], RUN_BYTES):
                for i, hashes in enumerate(shingle_sets(batch["text"].slice(first, n), words), first):
                    groups[roots[i]][nodes[i]] = hashes
        links = []
        for members in groups.values():
            if len(members) > 1:
                nodes = sorted(members)
                links += group_links(nodes, [members[n] for n in nodes], threshold)
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    tasks = 1 << bucket_bits(texts, shingles)
    dealt = texts.select("root", "node", "text").groupBy(F.pmod(F.xxhash64("root"), F.lit(tasks)).alias("task"))
    return dealt.applyInArrow(lean(link), "a long, b long")


def typical(sets: DataFrame) -> DataFrame:
    """root and node of the set of each group whose shingles are in most of the group's sets, on average.

    One shingle in SPARSE, by hash, is counted. The choice decides how much is left to ask, not what is found.
    """

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.frombuffer(h, "<u8") for h in batch["hashes"].to_pylist()]
            chosen = [h[h % np.uint64(SPARSE) == 0].view(np.int64) for h in hashes]
            at = pa.array(np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]))
            flat = pa.array(np.concatenate(chosen) if chosen else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch["root"].take(at), batch["node"].take(at), flat], ["root", "node", "h"])

    counted = written(sets.select("root", "node", "hashes").mapInArrow(lean(some), "root long, node long, h long"), "some-shingles")
    common = counted.groupBy("root", "h").agg(F.count(F.lit(1)).alias("n"))
    score = counted.join(common, ["root", "h"]).groupBy("root", "node").agg(F.avg("n").alias("score"))
    scored = sets.select("root", "node").join(score, ["root", "node"], "left")
    best = F.max_by("node", F.struct(F.coalesce("score", F.lit(0.0)), F.xxhash64("node")))
    return scored.groupBy("root").agg(best.alias("node"))


def blocked(sets: DataFrame, name: str, block_bytes: int) -> DataFrame:
    """`sets` with the column `name`: each group in order of size, cut into blocks of about `block_bytes`, larger ones
    in groups that would have more than MOST_BLOCKS.

    Sets of one size are dealt by hash, so only sums over the sizes of a group are ordered.
    """
    n = F.octet_length("hashes")
    sizes = sets.groupBy("root", n.alias("_size")).agg(F.sum(n).alias("_bytes"))
    below = Window.partitionBy("root").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    fair = F.sum("_bytes").over(Window.partitionBy("root")) / MOST_BLOCKS
    width = F.greatest(F.lit(block_bytes), F.least(fair, F.lit(MOST_BLOCK_BYTES)))
    sizes = sizes.withColumns({"_before": F.coalesce(F.sum("_bytes").over(below), F.lit(0)), "_width": width})
    sizes = written(sizes.withColumnRenamed("root", "_root"), "sizes")
    share = F.pmod(F.xxhash64("node", F.lit(name)), F.lit(1 << 30)) / (1 << 30)
    block = F.floor((F.col("_before") + F.col("_bytes") * share) / F.col("_width"))
    rows = sets.join(bounded(sizes), (F.col("root") == F.col("_root")) & (n == F.col("_size")))
    return rows.select(*sets.columns, block.cast("long").alias(name))


def block_pairs(sets: DataFrame, queries: DataFrame, threshold: Threshold, block_bytes: int) -> DataFrame:
    """root, block, slice, asks, node and hashes: for each block of members and each slice of the queries of a
    group whose sizes allow similar sets, both. `sets` has block; no (root, block, slice) has more than two blocks."""
    queries = blocked(queries, "slice", block_bytes)
    n = F.octet_length("hashes")
    span = lambda low, high: [F.min(n).alias(low), F.max(n).alias(high)]
    slices = queries.groupBy("root", "slice").agg(*span("_low", "_high"))
    blocks = sets.groupBy("root", "block").agg(*span("_small", "_large"))
    may = (100 * F.col("_high") >= threshold.percent * F.col("_small")) & (
        100 * F.col("_large") >= threshold.percent * F.col("_low")
    )
    pairs = written(blocks.join(slices, "root").where(may).select("root", "block", "slice"), "block-pairs")
    columns = ["root", "block", "slice", "asks", "node", "hashes"]
    own = sets.withColumn("asks", F.lit(False)).join(bounded(pairs), ["root", "block"]).select(*columns)
    sent = queries.withColumn("asks", F.lit(True)).join(bounded(pairs), ["root", "slice"]).select(*columns)
    return own.unionByName(sent)


def large_group_links(sets: DataFrame, threshold: Threshold, block_bytes: int) -> DataFrame:
    """Links of groups that no task can hold; `sets`, stored, has root, node and hashes.

    The sets of a group are cut into blocks by size. The group's most typical set is asked in all blocks that
    can hold similar ones; then the sets that it does not reach, in slices of the same size as blocks. A task
    has one block and one slice, and returns links that connect what all that it found do: fewer than it has sets.
    """

    def ask(table: pa.Table) -> pa.Table:
        rows = table.select(["node", "asks", "hashes"]).to_pylist()
        members = {r["node"]: np.frombuffer(r["hashes"], "<u8") for r in rows if not r["asks"]}
        asking = {r["node"]: np.frombuffer(r["hashes"], "<u8") for r in rows if r["asks"]}
        links = np.zeros((0, 2), np.int64)
        if members and asking:
            nodes, queries = sorted(members), sorted(asking)
            numbers, count = ranked([members[n] for n in nodes] + [asking[q] for q in queries])
            trie, found, held = Trie(numbers[: len(nodes)], len(count), threshold), [links], 0
            for q, number in zip(queries, numbers[len(nodes) :], strict=True):
                found.append(np.array([(q, nodes[i]) for i in trie.similar_to(number) if nodes[i] != q], np.int64).reshape(-1, 2))
                held += len(found[-1])
                if held > HELD_LINKS:
                    found, held = [spanning(np.concatenate(found))], 0
            links = spanning(np.concatenate(found))
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    sets = blocked(sets, "block", block_bytes)  # not stored again: only the sizes are, and the rest is a join with them

    def asked(queries: DataFrame) -> DataFrame:
        pairs = block_pairs(sets, queries.select("root", "node", "hashes"), threshold, block_bytes)
        return pairs.groupBy("root", "block", "slice").applyInArrow(lean(ask), "a long, b long")

    first = typical(sets)
    central = written(asked(sets.join(first, ["root", "node"], "left_semi")), "central-links")
    released_everywhere(sets.sparkSession)
    reached = central.select(F.col("b").alias("node")).unionByName(first.select("node")).distinct()
    return central.unionByName(asked(sets.join(reached, "node", "left_anti")))


def similarity_roots(docs: DataFrame, sets: DataFrame, threshold: Threshold, frequent: int, block_bytes: int) -> DataFrame:
    """node, doc_id (the smallest with that set) and root (one for each component) of every set of `docs`."""
    candidates = candidate_links(docs, threshold, frequent, shingles_of(sets))
    return verified_roots(docs, sets, candidates, threshold, block_bytes)


def verified_roots(
    docs: DataFrame,
    sets: DataFrame,
    candidates: DataFrame,
    threshold: Threshold,
    block_bytes: int,
    words: int = WORDS,
    group_links: GroupLinks = group_links,
) -> DataFrame:
    """node, doc_id (the smallest with that set) and root (one for each component) of every set of `docs`.

    The connected groups of `candidates` (a, b) have to hold every similar pair; each group is compared on its
    full sets of shingles, by `group_links` if a task can hold it. Where most documents have near copies, all of them are
    in groups, so a step's shuffles are done with before the next begins.
    """
    nodes = sets.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles")
    )
    groups = components(candidates)
    size = groups.join(nodes, "node")
    of_group = size.groupBy("root").agg(F.ceil(F.sum("n_shingles") * 8 / block_bytes).cast("long").alias("blocks"))
    members = written(size.join(of_group, "root").select("doc_id", "node", "root", "blocks"), "members")
    released_everywhere(docs.sparkSession)
    small = member_texts(docs, members.where("blocks <= 1").drop("blocks"), words)
    links = written(small_group_links(small, threshold, group_links, words, shingles_of(sets)), "small-links")
    released_everywhere(docs.sparkSession)
    if not members.where("blocks > 1").isEmpty():
        large = written(packed_sets(docs, members.where("blocks > 1").drop("blocks"), words), "large-groups")
        released_everywhere(docs.sparkSession)
        links = links.unionByName(large_group_links(large, threshold, block_bytes))
    linked = components(links)
    return nodes.join(linked, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))


def labelled(sets: DataFrame, named: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `sets`, whose sets have the roots in `named`."""
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = written(named.select("node", "root").join(least, "root").select("node", "component_id"), "labels")
    rows = join_hot(sets, labels, "node")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def similar_groups(docs: DataFrame, percent: int = 75, frequent: int = FREQUENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs` (doc_id, text).

    Two rows are linked when 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest doc_id that links reach, the row's own without links. Missing and empty texts have no shingles
    and no links. Repeated rows count as any equal texts; a missing id is a row, and no component_id.
    """
    sets = written(set_table(docs), "sets")
    return labelled(sets, similarity_roots(docs, sets, Threshold(percent), frequent, block_bytes))


def one_of_each_group(docs: DataFrame, percent: int = 75, frequent: int = FREQUENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs`, all columns, one of each component: that with the smallest doc_id, and of several texts
    or rows with that id one. Rows without shingles are linked with nothing and stay."""
    sets = written(set_table(docs), "sets")
    named = written(similarity_roots(docs, sets, Threshold(percent), frequent, block_bytes), "roots")
    released_everywhere(docs.sparkSession)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "node")  # a missing id comes last
    kept = named.groupBy("root").agg(F.min(first).alias("_first"))
    kept = kept.select("_first.node", F.col("_first.doc_id").alias("_kept"), F.lit(True).alias("_chosen"))
    # Most rows are the only ones of their group. The others are listed: those that go, and those that come again.
    keys = sets.where(F.col("node").isNotNull()).groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("_rows"))
    keys = keys.join(kept, "node", "left")
    stays = F.coalesce(F.col("_chosen") & F.col("doc_id").eqNullSafe(F.col("_kept")), F.lit(False))
    doc, node, stay = (free_name(docs, c) for c in ("_doc", "_set", "_stays"))
    listed = keys.select(F.col("doc_id").alias(doc), F.col("node").alias(node), stays.alias(stay), "_rows")
    listed = written(listed.where(~F.col(stay) | (F.col("_rows") > 1)).drop("_rows"), "listed")
    own = free_name(docs, "_node")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch["text"], "")
            for start, n in runs(texts, RUN_BYTES):
                part = batch.slice(start, n)
                nodes = [node_of(s) if len(s) else None for s in shingle_sets(texts.slice(start, n))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.int64())], [*part.schema.names, own])

    marked = docs.mapInArrow(lean(mark), with_fields(docs, **{own: "long"}))
    same = marked["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(node))
    rows = marked.join(bounded(listed), same, "left").where(F.col(node).isNull() | F.col(stay))
    alone = rows.where(F.col(node).isNull()).select(*docs.columns)
    if listed.where(F.col(stay)).isEmpty():  # no row comes again, and the documents need not be read once more for them
        return alone
    again = rows.where(F.col(node).isNotNull()).dropDuplicates([doc, node])
    return alone.unionByName(again.select(*docs.columns))
