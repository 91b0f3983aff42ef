"""Token ids on disk as wavelet matrices: one per shard, access, counting and lookup from its bytes."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text
from tallyworks.llm.encoding import encoder, runs
from tallyworks.llm.workers import lean

SHARD_TOKENS = 1 << 22
BLOCK = 8192  # bytes of a bit-plane that are compressed together
MAGIC = b"WVMX1"
SHARD_SCHEMA = "part int, seq int, doc_ids array<long>, counts array<long>, n_tokens long, matrix binary"


class WaveletMatrix:
    """A sequence of unsigned 32-bit ids as bit-planes of their ranks in the alphabet.

    Layout: magic, length, number of planes, compressed alphabet; then for each plane its number of zeros,
    the ones before each block, the place of each block, and the blocks, each raw or compressed.
    Reading one position takes one block of each plane.
    """

    def __init__(self, data: bytes):
        if data[:5] != MAGIC:
            raise ValueError("not a wavelet matrix")
        self.data = data
        self.n, self.planes, size = struct.unpack_from("<QII", data, 5)
        at = 21 + size
        self.alphabet = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[21:at]), "<u4")
        self.blocks = -(-self.n // (8 * BLOCK))
        self.zeros, self.ones_before, self.places = [], [], []
        for _ in range(self.planes):
            zeros, length = struct.unpack_from("<QQ", data, at)
            at += 16
            self.zeros.append(zeros)
            self.ones_before.append(np.frombuffer(data, "<u8", self.blocks + 1, at))
            at += 8 * (self.blocks + 1)
            ends = np.frombuffer(data, "<u8", self.blocks + 1, at)
            at += 8 * (self.blocks + 1)
            self.places.append(ends + at)
            at += length

    @staticmethod
    def build(ids: np.ndarray) -> bytes:
        alphabet, n = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64), len(ids)
        rank = np.zeros(int(alphabet[-1]) + 1 if n else 1, np.uint32)
        rank[alphabet] = np.arange(len(alphabet))
        current = rank[ids].astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        planes = max(1, int(len(alphabet) - 1).bit_length()) if n else 0
        pack = zstandard.ZstdCompressor(level=1).compress
        symbols = pack(alphabet.astype("<u4").tobytes())
        out = [MAGIC, struct.pack("<QII", n, planes, len(symbols)), symbols]
        for level in reversed(range(planes)):
            bits = (current >> level & 1).astype(bool)
            packed = np.packbits(bits)
            raw = [packed[i : i + BLOCK].tobytes() for i in range(0, len(packed), BLOCK)]
            ones = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK), dtype=np.uint64)
            blocks = [min(b, pack(b), key=len) for b in raw]  # raw on a tie: full length means raw
            ends = np.cumsum([0, *map(len, blocks)])
            out += [
                struct.pack("<QQ", n - int(ones.sum()), int(ends[-1])),
                np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes(),
                ends.astype("<u8").tobytes(),
                *blocks,
            ]
            current = np.concatenate([np.compress(~bits, current), np.compress(bits, current)])
        return b"".join(out)

    def block(self, plane: int, i: int) -> np.ndarray:
        raw = self.data[int(self.places[plane][i]) : int(self.places[plane][i + 1])]
        size = min(BLOCK, -(-self.n // 8) - i * BLOCK)
        if len(raw) < size:
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
        return np.frombuffer(raw, np.uint8)

    def bits(self, plane: int) -> np.ndarray:
        packed = np.concatenate([self.block(plane, i) for i in range(self.blocks)])
        return np.unpackbits(packed, count=self.n).astype(bool)

    def ones(self, plane: int, end: int) -> int:
        """Ones among the first `end` bits of a plane."""
        i, rest = divmod(end, 8 * BLOCK)
        before = int(self.ones_before[plane][i])
        return before + int(np.unpackbits(self.block(plane, i), count=rest).sum()) if rest else before

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        current = np.zeros(self.n, kind)
        for plane in reversed(range(self.planes)):
            bits, zeros = self.bits(plane), self.zeros[plane]
            above = np.empty_like(current)
            above[np.flatnonzero(~bits)] = current[:zeros]
            above[np.flatnonzero(bits)] = current[zeros:] | kind(1 << (self.planes - 1 - plane))
            current = above
        return self.alphabet[current] if self.n else current

    def access(self, position: int) -> int:
        if not 0 <= position < self.n:
            raise IndexError(position)
        symbol = 0
        for plane in range(self.planes):
            ones = self.ones(plane, position)
            byte = self.block(plane, position // (8 * BLOCK))[position // 8 % BLOCK]
            bit = int(byte) >> (7 - position % 8) & 1
            symbol = symbol << 1 | bit
            position = self.zeros[plane] + ones if bit else position - ones
        return int(self.alphabet[symbol])

    def _symbol(self, token: int) -> int | None:
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else None

    def _range(self, symbol: int, start: int, end: int) -> tuple[int, int]:
        """Where the symbol's occurrences between two positions lie below the last plane."""
        for plane in range(self.planes):
            before, within = self.ones(plane, start), self.ones(plane, end)
            if symbol >> (self.planes - 1 - plane) & 1:
                start, end = self.zeros[plane] + before, self.zeros[plane] + within
            else:
                start, end = start - before, end - within
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        symbol = self._symbol(token)
        if symbol is None:
            return 0
        low, high = self._range(symbol, start, self.n if end is None else end)
        return high - low

    def find(self, token: int, k: int) -> int:
        """Position of the k-th occurrence, from 0; -1 if there are fewer."""
        symbol = self._symbol(token)
        if symbol is None or not 0 <= k < self.count(token):
            return -1
        position = self._range(symbol, 0, self.n)[0] + k
        for plane in reversed(range(self.planes)):
            bit = symbol >> (self.planes - 1 - plane) & 1
            position = self._select(plane, bit, position - self.zeros[plane] if bit else position)
        return position

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th bit of this kind in a plane."""
        ones = self.ones_before[plane].astype(np.int64)
        starts = np.minimum(np.arange(self.blocks + 1) * 8 * BLOCK, self.n)
        before = ones if bit else starts - ones
        i = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.block(plane, i), count=min(8 * BLOCK, self.n - i * 8 * BLOCK))
        return i * 8 * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[i])])


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode `docs` (doc_id, text) in ascending doc_id order, `end_id` after each document, into `path`.

    The documents are range-partitioned by id. A task encodes its range and cuts it, between documents,
    into shards of at most `shard_tokens` ids (one longer document makes a larger shard); each shard is one
    row with its wavelet matrix, its document ids and their numbers of ids. Missing texts are empty,
    missing ids come first, rows with the same id follow each other ordered by the beginning of the text, then as
    the table has them; so many rows with one id, or none, or equal ones, are dealt to several tasks like others.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, code = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        ids, counts, names, held = [], [], [], 0

        def shard():
            sequence, sizes = np.concatenate(ids), np.concatenate(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([pa.concat_arrays(names).to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([len(sequence)], pa.int64()),
                    pa.array([WaveletMatrix.build(sequence)], pa.binary()),
                ],
                ["part", "seq", "doc_ids", "counts", "n_tokens", "matrix"],
            )

        for batch in batches:
            for first, length in runs(batch["text"]):
                flat, sizes = code.encode(batch["text"].slice(first, length), end=end_id)
                ends, done = np.cumsum(sizes), 0
                while done < length:
                    before = int(ends[done - 1]) if done else 0
                    take = int(np.searchsorted(ends, before + shard_tokens - held, "right"))
                    if take <= done and held:
                        yield shard()
                        ids, counts, names, held, seq = [], [], [], 0, seq + 1
                        continue
                    take = max(take, done + 1)
                    ids.append(flat[before : int(ends[take - 1])])
                    counts.append(sizes[done:take])
                    names.append(batch["doc_id"].slice(first + done, take - done))
                    held, done = held + int(ends[take - 1]) - before, take
        if held:
            yield shard()

    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    order = ["doc_id", "_begins", "_row"]
    ranged = ranged.withColumns({"_begins": F.substring("text", 1, 32), "_row": F.monotonically_increasing_id()})
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(lean(encode, encodes=True), SHARD_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Number of ids before each shard: part, seq, base."""
    sizes = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    parts = parts.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    placed = sizes.withColumn("within", within).join(parts, "part")
    return placed.select("part", "seq", (F.col("before") + F.col("within")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards in `path`: part, seq, doc_id, within (ids before it in its shard), ids
    (little-endian unsigned 32-bit, with the end id). Shards are decoded one at a time."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, seq, names, counts, data = (batch[i][row] for i in range(5))
                ids = WaveletMatrix(data.as_py()).decode().astype("<u4")
                ends = np.cumsum(counts.values.to_numpy())
                offsets = pa.array(np.concatenate([[0], ends * 4]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ends), part.as_py(), np.int32)),
                        pa.array(np.full(len(ends), seq.as_py(), np.int32)),
                        names.values,
                        pa.array(ends - counts.values.to_numpy()),
                        pa.BinaryArray.from_buffers(
                            pa.binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(ids)]
                        ),
                    ],
                    ["part", "seq", "doc_id", "within", "ids"],
                )

    stored = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "doc_ids", "counts", "matrix")
    return stored.mapInArrow(lean(decode), "part int, seq int, doc_id long, within long, ids binary")
