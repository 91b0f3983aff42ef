"""Near duplicates by SuperMinHash signatures, banding, verification on full sets and union-find grouping.

1. Every document becomes the set of hashes of its distinct shingles; equal sets are one node.
2. A signature has SLOTS numbers. Each shingle stands for a random permutation of the slots, drawn one rank at a
   time; a slot keeps the least (rank + fraction) that any shingle gives it. A set is done as soon as every slot
   is below the rank that comes next, so long sets need a rank or two, short ones more.
3. Signatures are cut into BANDS bands of equal length. Sets that agree in a band and do not differ too much in
   size are candidates. Two sets with a similarity of 0.8 agree in no band with a chance of
   (1 - 0.8^6)^48 = 5e-7, more similar ones with less; unrelated ones (0.01) agree in one with a chance of 5e-11.
4. Candidates are not listed as pairs: members of a band are chained by size, in each task first, a chain is held
   together by links to one of its sets, and union-find leaves the spanning ones only.
5. Connected candidates are compared on their full sets; the links that hold make the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.encoding import runs
from tallyworks.llm.graph import UnionFind, spanning
from tallyworks.llm.jaccard import (
    BLOCK_BYTES,
    RUN_BYTES,
    Threshold,
    bucket_bits,
    by_bucket,
    labelled,
    mixed,
    node_of,
    ranked,
    set_table,
    shingle_sets,
    texts_of,
    unpacked,
    verified_roots,
)
from tallyworks.llm.workers import lean
from tallyworks.sources.workspace import written

WORDS = 2
BANDS, ROWS = 48, 6
SLOTS = BANDS * ROWS
ELEMENTS = 8192  # shingles whose permutations are held together
FLUSH = 4096  # sets a task holds before it sends their bands on
SIZE_STEP = np.log(1.01)  # sizes are sent as whole numbers of this step, rounded down
STRIDE = 0x9E3779B97F4A7C15
GOLDEN, LOW = np.uint64(STRIDE), np.uint64(0xFFFFFFFF)


def draws(hashes: np.ndarray, rank: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle: which of the slots that have no rank yet gets this one, counted from `rank`, and the
    number (rank + fraction) * 2^32."""
    z = mixed(hashes + np.uint64((rank + 1) * STRIDE % (1 << 64)))
    chosen = ((z >> np.uint64(32)) * np.uint64(slots - rank)) >> np.uint64(32)
    return chosen.astype(np.int64) + rank, np.uint64(rank << 32) | (z & LOW)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """The SuperMinHash signature of each set, a row each, in units of 2^-32; an empty set has the largest number."""
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    order = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: len(sets[i]))
    start = 0
    while start < len(order):
        end, held = start, 0
        while end < len(order) and (end == start or held + len(sets[order[end]]) <= ELEMENTS):
            held += len(sets[order[end]])
            end += 1
        group = order[start:end]
        out[group] = _ranked_signatures([sets[i] for i in group], slots)
        start = end
    return out


def _ranked_signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    h, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    signature = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = signature.reshape(-1)
    slot, value = draws(h, 0, slots)
    np.minimum.at(flat, of * slots + slot, value)
    # Rank 0 swapped the places 0 and `slot` of the permutation; it is stored for the sets that need more ranks.
    open_sets = signature.max(axis=1) >= 1 << 32
    if not open_sets.any():
        return signature
    left = np.flatnonzero(open_sets[of])
    h, of, slot = h[left], of[left], slot[left]
    kind = np.uint16 if slots <= 1 << 16 else np.uint32
    places = np.tile(np.arange(slots, dtype=kind), (len(h), 1))
    rows = np.arange(len(h))
    places[rows, slot] = 0
    for rank in range(1, slots):
        at, value = draws(h, rank, slots)
        chosen = places[rows, at]
        places[rows, at] = places[:, rank]
        np.minimum.at(flat, of * slots + chosen, value)
        if rank & (rank - 1) and rank % 8:
            continue  # whether sets are done is asked now and then
        open_sets = signature.max(axis=1) >= (rank + 1) << 32
        left = np.flatnonzero(open_sets[of])
        if not len(left):
            break
        if 2 * len(left) <= len(h):
            h, of, places = h[left], of[left], places[left]
            rows = np.arange(len(h))
    return signature


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity that two signatures tell."""
    return float(np.mean(a == b))


def bands(signature: np.ndarray, count: int = BANDS) -> np.ndarray:
    """A hash of each band of each signature (sets x bands)."""
    parts = signature.reshape(len(signature), count, -1)
    h = np.broadcast_to(mixed(np.arange(1, count + 1, dtype=np.uint64) * GOLDEN), parts.shape[:2])
    for k in range(parts.shape[2]):
        h = mixed(h * GOLDEN + parts[:, :, k])
    return h


def chained(h: np.ndarray, node: np.ndarray, low: np.ndarray, high: np.ndarray, steps: int):
    """Chains of the rows that share `h`, and the links (a, b) that hold each chain together.

    A row stands for sets of one chain with sizes from `low` to `high`. In order of the least size, a row goes
    on with the chain before it unless its least size is more than `steps` above all of that chain. Two sets
    with one `h` whose sizes are that near are always in one chain. All rows of a chain are linked to its smallest
    node, which the chains of other bands over the same sets mostly have too, so that their links are the same.
    Returns the chains as rows again, named by that node.
    """
    if not len(h):
        return (h, node, low.astype(np.uint16), high.astype(np.uint16)), np.zeros((0, 2), np.int64)
    order = np.lexsort((low, h))
    h, node, low, high = h[order], node[order], low[order].astype(np.int64), high[order].astype(np.int64)
    group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
    span = int(high.max()) + steps + 2
    reach = np.maximum.accumulate(high + group * span)  # of groups before: less than any low
    goes_on = (h[1:] == h[:-1]) & (low[1:] + group[1:] * span <= reach[:-1] + steps)
    first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    ends = np.append(first[1:], len(h)) - 1
    least = np.minimum.reduceat(node, first)
    links = np.stack([np.repeat(least, ends - first + 1), node], axis=1)
    chains = (h[first], least, low[first].astype(np.uint16), (reach[ends] - group[ends] * span).astype(np.uint16))
    return chains, links[links[:, 0] != links[:, 1]]


def band_links(docs: DataFrame, threshold: Threshold, words: int = WORDS) -> DataFrame:
    """Links (a, b) whose connected groups hold the pairs of nodes that agree in a band and may be similar in size.

    A task chains the sets that it holds itself, and sends one row a band and chain with its spanning links; so
    a text with a great many near copies sends a few rows a task.
    """
    bits = bucket_bits(docs)
    steps = int(np.log(100 / threshold.percent) / SIZE_STEP) + 1  # sizes within the threshold, after rounding down

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        codes, nodes, sizes = [], [], []

        def flush() -> pa.RecordBatch:
            h = np.concatenate(codes).reshape(-1)
            node = np.repeat(np.array(nodes, np.int64), BANDS)
            size = np.repeat((np.log(np.array(sizes)) / SIZE_STEP).astype(np.uint16), BANDS)
            chains, links = chained(h, node, size, size, steps)
            made = by_bucket(bits, chains[0], list(chains), ["h", "node", "low", "high"])
            own = [spanning(links).astype("<i8").tobytes(), *[b""] * (made.num_rows - 1)]
            return pa.RecordBatch.from_arrays([*made.columns, pa.array(own, pa.binary())], [*made.schema.names, "links"])

        for batch in batches:
            for first, n in runs(batch["text"], RUN_BYTES):
                new = []
                for s in shingle_sets(batch["text"].slice(first, n), words):
                    if len(s) and (node := node_of(s)) not in met:
                        met.add(node)
                        new.append((node, s))
                for at in range(0, len(new), FLUSH):
                    part = new[at : at + FLUSH]
                    codes.append(bands(signatures([s for _, s in part])))
                    nodes += [node for node, _ in part]
                    sizes += [len(s) for _, s in part]
                    if len(nodes) >= FLUSH:
                        yield flush()
                        codes, nodes, sizes = [], [], []
        if nodes:
            yield flush()

    def connect(table: pa.Table) -> pa.Table:
        kinds = {"h": "<u8", "node": "<i8", "low": "<u2", "high": "<u2"}
        _, links = chained(*(unpacked(table[c], k) for c, k in kinds.items()), steps)
        pairs = spanning(np.concatenate([links.reshape(-1, 2), unpacked(table["links"], "<i8").reshape(-1, 2)]))
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    sent = texts_of(docs).mapInArrow(lean(send), "bucket long, h binary, node binary, low binary, high binary, links binary")
    return sent.groupBy("bucket").applyInArrow(lean(connect), "a long, b long")


def confirmed(nodes: list[int], sets: list[np.ndarray], threshold: Threshold) -> list[tuple[int, int]]:
    """Links that connect the same nodes as all similar pairs of a group do, by full intersections.

    One set at a time is compared with all others, the one with the commonest shingles first. Sets that it links
    need not ask each other; every other set asks, unless union-find has the whole group connected before.
    """
    numbers, count = ranked(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, starts = np.concatenate(numbers), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    asked, found, links, parts = np.zeros(len(count), np.int64), UnionFind(), [], len(sets)
    first = max(range(len(sets)), key=lambda i: (count[numbers[i]].mean(), -i))
    reached: set[int] = set()
    for i in [first, *(i for i in range(len(sets)) if i != first)]:
        if parts == 1:
            break
        if i in reached:
            continue
        asked[numbers[i]] = 1
        overlap = np.add.reduceat(asked[flat], starts)
        asked[numbers[i]] = 0
        similar = np.flatnonzero(100 * overlap >= threshold.percent * (sizes + sizes[i] - overlap)).tolist()
        if i == first:
            reached = set(similar)
        for j in similar:
            if j != i and found.join(i, j):
                links.append((nodes[i], nodes[j]))
                parts -= 1
    return links


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs` (doc_id, text).

    Two rows are linked when 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest doc_id that links reach, the row's own without links, and `kept` says that it is the row's own.
    Missing and empty texts have no shingles, no links and are kept. Of repeated rows with the smallest id all
    are kept; a missing id is a row like others, never a component_id while the component has another id, and is
    not kept then. An empty table gives an empty one. For thresholds below 80, `BANDS` loses more links than
    said above.
    """
    sets = written(set_table(docs, words), "sets")
    threshold = Threshold(percent)
    named = verified_roots(docs, sets, band_links(docs, threshold, words), threshold, block_bytes, words, confirmed)
    return labelled(sets, named).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
