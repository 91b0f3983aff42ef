"""Hard negatives by a GNAT-style multiway hyperplane tree over quantised embeddings. Exact.

1. The tree is grown on a bounded sample: a node has up to FANOUT split points, far from each other, and a vector
   goes on to the child of the nearest one. Every row of the table then falls into a leaf.
2. For each node, the least and largest distance from every split point to the rows of every child, and the
   least and largest length of these, are taken over all rows. They are as many as the tree has places for.
3. A question is an anchor with windows of scores. With the lengths below a child, a window of inner products is a
   ring of distances around the anchor; a child is left out if, by the triangle inequality, any split point's
   stored range does not meet the ring. What is left is compared row by row, in blocks of bounded size.
4. Each question looks into its own block first: the k-th best score found there lifts the window's lower end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.workers import lean, lean_pair
from tallyworks.sources.workspace import written

FANOUT = 8
SAMPLE_ROWS = 8192  # the tree's split points are chosen among so many rows, drawn by hash
LEAF_ROWS = 1024  # rows of the table in a leaf, about, while the sample is large enough to tell leaves apart
LEAST_SAMPLE = 32  # rows of the sample that are not split any more
BLOCK_ROWS = 16_384  # rows of a leaf that one task compares, about
QUESTIONS = 16_384  # questions that one task puts to a block, about
AT_ONCE = 64  # questions whose scores are held together
FAR = 1 << 62  # beyond any score


@dataclass
class Node:
    """Split points, and for each a child: another node, or the number of a leaf."""

    points: np.ndarray
    children: list = field(default_factory=list)
    at: int = 0  # its place in the tree's list of nodes


@dataclass
class Tree:
    root: Node | int
    nodes: list[Node]
    leaves: int


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Of each row of `x` to each point."""
    square = squares(x)[:, None] + squares(points)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


def split_points(x: np.ndarray, fanout: int) -> np.ndarray:
    """Up to `fanout` different rows: the first, and again and again the one farthest from all chosen."""
    chosen = [0]
    nearest = distances(x, x[:1])[:, 0]
    while len(chosen) < fanout and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def grow(sample: np.ndarray, rows_each: float, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS, least: int = LEAST_SAMPLE) -> Tree:
    """The tree of a sample of which each row stands for `rows_each` rows."""
    tree = Tree(0, [], 0)

    def leaf() -> int:
        tree.leaves += 1
        return tree.leaves - 1

    todo: list[tuple[np.ndarray, list]] = []
    top: list = []
    todo.append((sample, top))
    while todo:
        x, siblings = todo.pop()
        points = split_points(x, fanout) if len(x) > least and len(x) * rows_each > leaf_rows else x[:0]
        if len(points) < 2:
            siblings.append(leaf())
            continue
        node = Node(points, [], len(tree.nodes))
        tree.nodes.append(node)
        siblings.append(node)
        nearest = distances(x, points).argmin(axis=1)
        # A list a child, filled in when its rows come up, keeps the children in the order of their points.
        node.children = [[] for _ in points]
        todo += [(x[nearest == i], node.children[i]) for i in range(len(points))]
    for node in tree.nodes:
        node.children = [c[0] for c in node.children]
    tree.root = top[0]
    return tree


def descend(tree: Tree, x: np.ndarray):
    """The leaf of each row, and for each node that rows pass: node, their distances to its points, their child."""
    leaf, passed = np.zeros(len(x), np.int64), []
    todo = [(tree.root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            leaf[rows] = node
            continue
        far = distances(x[rows], node.points)
        child = far.argmin(axis=1)
        passed.append((node, rows, far, child))
        todo += [(c, rows[child == i]) for i, c in enumerate(node.children)]
    return leaf, passed


@dataclass
class Ranges:
    """For each node: least and largest distance from point i to the rows of child j, and of these rows the least
    and largest squared length. A child without rows has an empty range."""

    low: list[np.ndarray]
    high: list[np.ndarray]
    short: list[np.ndarray]
    long: list[np.ndarray]

    @staticmethod
    def empty(tree: Tree) -> Ranges:
        m = [len(n.points) for n in tree.nodes]
        square = lambda v: [np.full((k, k), v) for k in m]
        return Ranges(square(np.inf), square(-np.inf), [np.full(k, np.inf) for k in m], [np.full(k, -np.inf) for k in m])


def needed(tree: Tree, ranges: Ranges, x: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Which leaves may hold a row whose score with an anchor (a row of `x`) lies in one of its windows."""
    found = np.zeros((len(x), tree.leaves), bool)
    length = squares(x)
    todo = [(tree.root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            found[rows, node] = True
            continue
        far = distances(x[rows], node.points)
        low, high, short, long = (r[node.at] for r in (ranges.low, ranges.high, ranges.short, ranges.long))
        slack = 1e-6 * (1 + far.max(axis=1))[:, None, None]
        may = np.zeros(far.shape, bool)
        for w in range(lows.shape[1]):
            least, most = lows[rows, w, None], highs[rows, w, None]
            # The ring around the anchor, for each child: squared distance = length + length below - 2 score.
            outer = length[rows, None] + long[None, :] - 2.0 * least
            inner = length[rows, None] + short[None, :] - 2.0 * most
            with np.errstate(invalid="ignore"):
                out, inn = (np.sqrt(np.maximum(r, 0))[:, None, :] for r in (outer, inner))
                d = far[:, :, None]
                meets = (d - out <= high[None] + slack) & (d + out >= low[None] - slack) & (inn - d <= high[None] + slack)
            may |= meets.all(axis=1) & (outer >= -1) & (least <= most)
        todo += [(c, rows[may[:, j]]) for j, c in enumerate(node.children)]
    return found


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and v, the whole numbers floor(scale * x) of `embedding`; rows that lack something, or have a
    component that is missing or not finite, are left out, and equal rows are one."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    kept = rows.where(known & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("v")).distinct()


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors of a binary column, each of `width` 64-bit whole numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


def padded(column: pa.Array, width: int) -> np.ndarray:
    """The lists as rows; a shorter vector ends in zeros."""
    ends = np.cumsum(lengths := np.diff(column.offsets.to_numpy()))
    out = np.zeros((len(column), width), "<i8")
    out[np.repeat(np.arange(len(column)), lengths), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)] = (
        column.flatten().to_numpy()
    )
    return out


class Index:
    """The rows in the tree's leaves, cut into blocks, with the ranges of all nodes.

    `table` has leaf, chunk, vec_id, label and vec (64-bit whole numbers); leaf and chunk name a block.
    """

    def __init__(self, vectors: DataFrame, leaf_rows: int, block_rows: int):
        spark = vectors.sparkSession
        length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        rows, self.width, longest = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(length)).first()
        if rows and longest >= FAR:
            raise ValueError("scores of vectors this long do not fit in 64 bits")
        # Sums of products are at most the square of the largest length, so whole numbers below 2^53 stay exact.
        self.kind = np.float64 if not rows or longest < 1 << 53 else np.int64
        self.width = self.width or 0
        # About twice the sample by hash first, so that tasks do not send a whole sample each.
        draw, share = F.xxhash64("vec_id", "v"), min(1.0, (2 * SAMPLE_ROWS + 100) / max(1, rows))
        some = vectors.where(F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30)))
        drawn = some.orderBy(draw, "vec_id").limit(SAMPLE_ROWS).select("v").collect()
        sample = np.zeros((len(drawn), self.width))
        for i, (v,) in enumerate(drawn):
            sample[i, : len(v)] = v
        self.tree = grow(sample, rows / max(1, len(drawn)), leaf_rows=leaf_rows)
        self.placed = written(self._placed(vectors), "placed")
        self.ranges = self._ranges()
        sizes = self.placed.groupBy("leaf").count().collect()  # one a leaf
        self.chunks = {r["leaf"]: -(-r["count"] // block_rows) for r in sizes}
        chunks = spark.createDataFrame([(k, n) for k, n in self.chunks.items()], "leaf long, chunks int")
        dealt = F.pmod(F.xxhash64("vec_id", "vec"), F.col("chunks")).cast("int")
        named = self.placed.join(F.broadcast(chunks), "leaf").withColumn("chunk", dealt).drop("chunks")
        self.table = named.select("leaf", "chunk", "vec_id", "label", "vec")

    def _placed(self, vectors: DataFrame) -> DataFrame:
        tree, width = self.tree, self.width

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = padded(batch["v"], width)
                leaf, _ = descend(tree, x.astype(np.float64))
                packed = pa.array([row.tobytes() for row in x], pa.binary())
                columns = [pa.array(leaf), batch["vec_id"], batch["label"], packed]
                yield pa.RecordBatch.from_arrays(columns, ["leaf", "vec_id", "label", "vec"])

        return vectors.mapInArrow(lean(place), "leaf long, vec_id long, label long, vec binary")

    def _ranges(self) -> Ranges:
        tree, width = self.tree, self.width

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Ranges.empty(tree)
            for batch in batches:
                x = matrix(batch["vec"], width).astype(np.float64)
                length = squares(x)
                for node, rows, far, child in descend(tree, x)[1]:
                    for j in np.unique(child):
                        mine = child == j
                        own.low[node.at][:, j] = np.minimum(own.low[node.at][:, j], far[mine].min(axis=0))
                        own.high[node.at][:, j] = np.maximum(own.high[node.at][:, j], far[mine].max(axis=0))
                        own.short[node.at][j] = min(own.short[node.at][j], length[rows[mine]].min())
                        own.long[node.at][j] = max(own.long[node.at][j], length[rows[mine]].max())
            out = [
                (node.at, i, j, own.low[node.at][i, j], own.high[node.at][i, j], own.short[node.at][j], own.long[node.at][j])
                for node in tree.nodes
                for i in range(len(node.points))
                for j in range(len(node.points))
                if own.short[node.at][j] <= own.long[node.at][j]
            ]
            names = ["node", "i", "j", "low", "high", "short", "long"]
            kinds = [pa.int32()] * 3 + [pa.float64()] * 4
            columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

        each = self.placed.select("vec").mapInArrow(
            lean(measure), "node int, i int, j int, low double, high double, short double, long double"
        )
        all_rows = each.groupBy("node", "i", "j").agg(F.min("low"), F.max("high"), F.min("short"), F.max("long"))
        ranges = Ranges.empty(tree)
        for at, i, j, low, high, short, long in all_rows.collect():  # as many as the tree has places for
            ranges.low[at][i, j], ranges.high[at][i, j] = low, high
            ranges.short[at][j], ranges.long[at][j] = short, long
        return ranges

    def best(self, questions: DataFrame, k: int, same: bool, group: int = QUESTIONS) -> DataFrame:
        """key, window, vec_id, score and rank (from 1) of the first k rows in each window of each question.

        `questions`, stored, has key (one of its own), leaf, chunk, vec_id, label, vec, and the arrays lows and highs,
        equally long. Rows with the anchor's own vec_id are left out, and those with another (`same`) or with its
        label (not `same`). Larger scores come first, then smaller vec_ids.
        """
        columns = ["key", "vec_id", "label", "vec", "lows", "highs"]
        asked, here = questions.select("leaf", "chunk", *columns), self.table
        own = asked.groupBy("leaf", "chunk").cogroup(here.groupBy("leaf", "chunk"))
        types = "key long, vec_id long, label long, vec binary, lows array<long>, highs array<long>"
        lifted = written(own.applyInArrow(lean_pair(self._lifted(k, same)), types), "lifted")
        groups = -(-lifted.count() // group)
        ways = lifted.mapInArrow(lean(self._ways()), f"leaf long, chunks int, {types}")
        ways = ways.select("leaf", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), *columns)
        ways = ways.withColumn("part", F.pmod("key", F.lit(max(1, groups))).cast("int"))
        parts = F.explode(F.sequence(F.lit(0), F.lit(max(1, groups) - 1))).alias("part")
        keys = ["leaf", "chunk", "part"]
        both = ways.groupBy(*keys).cogroup(here.select("*", parts).groupBy(*keys))
        found = both.applyInArrow(lean_pair(self._found(k, same)), "key long, window int, vec_id long, score long")
        first = Window.partitionBy("key", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)

    def _compared(self, k: int, same: bool):
        """A function over questions and rows: for each window of each question, the first k rows."""
        width, kind = self.width, self.kind

        def compare(asked: pa.Table, rows: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
            ids, labels = (rows[c].to_numpy() for c in ("vec_id", "label"))
            x = matrix(rows["vec"], width).astype(kind)
            a = matrix(asked["vec"], width).astype(kind)
            own, label = (asked[c].to_numpy() for c in ("vec_id", "label"))
            lows, highs = (asked[c].to_pylist() for c in ("lows", "highs"))
            for start in range(0, len(a), AT_ONCE):
                scores = (a[start : start + AT_ONCE] @ x.T).astype(np.int64)
                for i, score in enumerate(scores, start):
                    may = (labels == label[i]) if same else (labels != label[i])
                    may &= ids != own[i]
                    for w, (low, high) in enumerate(zip(lows[i], highs[i], strict=True)):
                        at = np.flatnonzero(may & (score >= low) & (score <= high))
                        if len(at) > k:
                            least = np.partition(score[at], len(at) - k)[len(at) - k]
                            at = at[score[at] >= least]
                        at = at[np.lexsort((ids[at], -score[at]))[:k]]
                        yield i, w, ids[at], score[at]

        return compare

    def _lifted(self, k: int, same: bool):
        compare = self._compared(k, same)

        def lift(asked: pa.Table, rows: pa.Table) -> pa.Table:
            asked = asked.drop_columns(["leaf", "chunk"])
            lows = asked["lows"].to_pylist()
            if asked.num_rows:
                for i, w, ids, scores in compare(asked, rows):
                    if len(ids) == k:
                        lows[i][w] = int(scores[-1])
            for name, values in (("lows", lows), ("highs", asked["highs"].to_pylist())):
                asked = asked.set_column(asked.schema.get_field_index(name), name, pa.array(values, pa.list_(pa.int64())))
            return asked

        return lift

    def _found(self, k: int, same: bool):
        compare = self._compared(k, same)

        def find(asked: pa.Table, rows: pa.Table) -> pa.Table:
            keys, windows, ids, scores = [], [], [], []
            if asked.num_rows and rows.num_rows:
                key = asked["key"].to_numpy()
                for i, w, vec_ids, own in compare(asked, rows):
                    keys.append(np.full(len(own), key[i]))
                    windows.append(np.full(len(own), w, np.int32))
                    ids.append(vec_ids)
                    scores.append(own)
            flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0, kind))
            columns = [flat(keys, np.int64), flat(windows, np.int32), flat(ids, np.int64), flat(scores, np.int64)]
            return pa.Table.from_arrays(columns, ["key", "window", "vec_id", "score"])

        return find

    def _ways(self):
        """A function over questions: a row for each leaf that a question has to look into."""
        tree, ranges, width, chunks = self.tree, self.ranges, self.width, self.chunks
        names = ["key", "vec_id", "label", "vec", "lows", "highs"]

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    lows, highs = part["lows"].to_pylist(), part["highs"].to_pylist()
                    most = max([1, *map(len, lows)])
                    low = np.array([[*x, *[1] * (most - len(x))] for x in lows], np.float64).reshape(-1, most)
                    high = np.array([[*x, *[0] * (most - len(x))] for x in highs], np.float64).reshape(-1, most)
                    may = needed(tree, ranges, matrix(part["vec"], width).astype(np.float64), low, high)
                    for leaf in np.flatnonzero(may.any(axis=0)).tolist():
                        if leaf in chunks:
                            some = part.take(pa.array(np.flatnonzero(may[:, leaf])))
                            columns = [pa.array([leaf] * some.num_rows, pa.int64()), pa.array([chunks[leaf]] * some.num_rows, pa.int32())]
                            yield pa.RecordBatch.from_arrays([*columns, *(some[c] for c in names)], ["leaf", "chunks", *names])

        return route


def share(value: str, percent: int, up: bool) -> Column:
    """value * percent / 100 of a long column, rounded up or down to a whole number."""
    exact = F.col(value).cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
    group: int = QUESTIONS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    `rows` has vec_id, label and embedding (an array of numbers); those for which `anchors`, a condition on vec_id,
    holds are the anchors. A score is the inner product of two embeddings in whole numbers floor(scale * x); larger
    ones come first, then smaller vec_ids. An anchor's positives are its first `positives` rows of its label with
    another vec_id; for each, the negatives are the first rows of other labels with
    least * positive score <= 100 * score <= most * positive score.

    Rows without vec_id, label or embedding, or with a component that is missing or not finite, take no part. Equal
    rows count once; rows that differ under one vec_id are rows each, and never each other's positives. Of embeddings
    of different lengths the shorter one is taken to end in zeros; an empty one scores 0. An anchor without positives,
    or a positive without negatives, gives no row; an empty table gives none. Scores that need more than 64 bits are
    an error.
    """
    index = Index(written(quantised(rows, scale), "vectors"), leaf_rows, block_rows)
    key = F.xxhash64("vec_id", "label", "vec").alias("key")
    one = lambda bound: F.array(F.lit(bound).cast("long"))
    asked = index.table.where(anchors).select("*", key)
    asked = written(asked, "anchors")
    everything = asked.withColumns({"lows": one(-FAR), "highs": one(FAR)})
    near = index.best(everything, positives, True, group).select(
        "key", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    near = written(near, "positives")
    windows = near.withColumns({"low": share("positive_score", least, True), "high": share("positive_score", most, False)})
    windows = windows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("nth", "low", "high"))).alias("w"))
    asking = asked.join(windows.select("key", F.col("w.low").alias("lows"), F.col("w.high").alias("highs")), "key")
    far = index.best(written(asking, "windows"), negatives, False, group)
    far = far.select("key", (F.col("window") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = asked.select("key", F.col("vec_id").alias("anchor_id"))
    return far.join(near, ["key", "nth"]).join(named, "key").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
