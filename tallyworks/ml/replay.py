"""Replays of fitted tree ensembles over their training rows, node by node.

The rows are read once: each tree says in which leaf a row lies, and per (tree, leaf) sums of the rows' targets are
combined before the shuffle. Sums of inner nodes follow from their leaves. What the model stores about each node is
read from its saved form. Both are as large as the model, not as the data.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.workspace import new_folder

#: A forest's trees see each row a random number of times (once on average), so their leaves differ from the means
#: of all rows that reach them. Squared differences are 1 to 2.5 times what drawing alone makes for trees that were
#: grown on these labels, and 7 times or more for trees that were grown on others.
MOST_DEVIATION = 4.0
#: The trees' squared errors on their own training rows, together, may exceed those of the mean by this many times what
#: drawing makes: labels that the features tell nothing about make 0.7 times at most, wrong labels 4 times or more.
MOST_LOSS = 2.0
SIGMAS = 8.0  # of the number, mean and impurity that drawing gives a node
ENOUGH = 100  # rows of a node for which these are told apart


@dataclass
class Node:
    """What a model stores about a node: the sums of its training rows, and its children if it is no leaf."""

    prediction: float
    impurity: float
    stats: list[float]
    gain: float
    left: int
    right: int


def stored_nodes(model: Model) -> dict[int, dict[int, Node]]:
    """The nodes of each tree by their number, in the order of a walk that visits left children first."""
    path = new_folder(SparkSession.active(), "trees")
    model.save(path)
    trees: dict[int, dict[int, Node]] = defaultdict(dict)
    for row in SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():  # a model's size
        trees[row["treeID"]][row["id"]] = Node(
            row["prediction"], row["impurity"], list(row["impurityStats"]), row["gain"], row["leftChild"], row["rightChild"]
        )
    return trees


def leaf_ways(nodes: dict[int, Node]) -> list[list[int]]:
    """For each leaf, in the order in which the model numbers leaves, the nodes from the root to it."""
    ways, todo = [], [(0, [0])]
    while todo:
        at, way = todo.pop()
        if nodes[at].left < 0:
            ways.append(way)
        else:
            todo += [(nodes[at].right, [*way, nodes[at].right]), (nodes[at].left, [*way, nodes[at].left])]
    return ways


Said = Callable[[Column, Column], Column]


def with_trees(model: Model, rows: DataFrame) -> tuple[DataFrame, list[tuple[Column, Column]]]:
    """`rows` with what each tree says, and for each tree the leaf and that (a number, or the class shares)."""
    said = []
    for i, tree in enumerate(model.trees):
        tree, names = tree.copy(), {"leafCol": f"_leaf{i}", "predictionCol": f"_said{i}"}
        if tree.hasParam("probabilityCol"):
            names |= {"probabilityCol": f"_shares{i}", "rawPredictionCol": f"_raw{i}"}
        rows = tree._set(**names).transform(rows)
        told = vector_to_array(f"_shares{i}") if "probabilityCol" in names else F.col(f"_said{i}")
        said.append((F.col(f"_leaf{i}").cast("int"), told))
    return rows, said


def node_sums(model: Model, rows: DataFrame, sums: Callable[[int, list[Column]], list[Column]], nodes) -> dict[tuple[int, int], list[float]]:
    """For each (tree, node) the number of rows that reach it and the sums of what `sums` makes of the tree's place
    and what all trees say about a row."""
    rows, said = with_trees(model, rows)
    told = [s for _, s in said]
    entries = [
        F.struct(F.lit(i).alias("tree"), leaf.alias("leaf"), F.array(F.lit(1.0), *sums(i, told)).alias("x"))
        for i, (leaf, _) in enumerate(said)
    ]
    one_each = rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    width = 1 + len(sums(0, told))
    by_leaf = one_each.groupBy("tree", "leaf").agg(*(F.sum(F.col("x")[k]).alias(f"x{k}") for k in range(width)))
    found: dict[tuple[int, int], list[float]] = defaultdict(lambda: [0.0] * width)
    ways = {tree: leaf_ways(own) for tree, own in nodes.items()}
    for row in by_leaf.collect():  # one a leaf
        for node in ways[row["tree"]][row["leaf"]]:
            total = found[row["tree"], node]
            for k in range(width):
                total[k] += row[f"x{k}"]
    return found


def near(a: float, b: float, scale: float, tolerance: float = 1e-6) -> bool:
    return abs(a - b) <= tolerance * max(abs(a), abs(b), scale, 1.0)


# --- boosted trees ----------------------------------------------------------------------------


def squared_residual(label: Column, so_far: Column) -> Column:
    return 2 * (label - so_far)


def logistic_residual(sign: Column, so_far: Column) -> Column:
    """For labels -1 and 1 and the log loss 2 log(1 + exp(-2 label sum))."""
    return 4 * sign / (1 + F.exp(2 * sign * so_far))


def wrong_stages(model: Model, rows: DataFrame, label: str, two_classes: bool = False) -> int:
    """Nodes of boosted trees that are not what their stage is fitted on.

    The first tree is fitted on the labels (two classes: -1 and 1), each later one on the negative slope of the loss
    at the weighted sum of those before it. A node has to hold the number, sum and square sum of that over the training
    rows that reach it, and a leaf has to say their mean.
    """
    nodes = stored_nodes(model)
    target = (2 * F.col(label) - 1 if two_classes else F.col(label)).cast("double")
    residual = logistic_residual if two_classes else squared_residual
    weights = [float(w) for w in model.treeWeights]

    def sums(tree: int, said: list[Column]) -> list[Column]:
        if not tree:
            value = target
        else:
            so_far = F.lit(0.0)
            for weight, one in zip(weights[:tree], said, strict=False):
                so_far = so_far + weight * one
            value = residual(target, so_far)
        return [value, value * value]

    found, wrong = node_sums(model, rows, sums, nodes), 0
    for tree, own in nodes.items():
        for at, node in own.items():
            n, total, square = found[tree, at]
            same = near(node.stats[0], n, 1) and near(node.stats[1], total, n) and near(node.stats[2], square, n)
            says = node.left >= 0 or (n > 0 and near(node.prediction, total / n, 1))
            wrong += not (same and says)
    return wrong


# --- forests ----------------------------------------------------------------------------------


def impurity_of(stats: list[float], classes: int) -> float:
    """Variance of (number, sum, square sum), or the Gini impurity of class numbers."""
    if not classes:
        return max(0.0, stats[2] / stats[0] - (stats[1] / stats[0]) ** 2)
    total = sum(stats)
    return 1 - sum((s / total) ** 2 for s in stats)


def wrong_nodes(nodes: dict[int, Node], classes: int) -> int:
    """Nodes whose impurity, prediction or gain is not what their own and their children's sums say."""
    size = sum if classes else (lambda stats: stats[0])
    wrong = 0
    for node in nodes.values():
        own = impurity_of(node.stats, classes)
        fair = near(node.impurity, own, 1) or (node.left < 0 and node.impurity < 0)  # the deepest leaves store none
        if classes:
            fair &= node.stats[int(node.prediction)] == max(node.stats)
        else:
            fair &= near(node.prediction, node.stats[1] / node.stats[0], 1)
        if node.left >= 0:
            left, right = nodes[node.left], nodes[node.right]
            fair &= all(near(a + b, c, size(node.stats)) for a, b, c in zip(left.stats, right.stats, node.stats, strict=True))
            below = sum(size(c.stats) * impurity_of(c.stats, classes) for c in (left, right)) / size(node.stats)
            fair &= near(node.gain, own - below, 1)
        wrong += not fair
    return wrong


def drawn_far(node: Node, sums: list[float], classes: int) -> bool:
    """The node's number, shares (or mean) and impurity lie further from those of all rows that reach it than drawing
    rows with replacement explains."""
    n = sums[0]
    if n < ENOUGH:
        return False
    drawn = sum(node.stats) if classes else node.stats[0]
    if abs(drawn - n) > SIGMAS * n**0.5:
        return True
    if classes:
        shares = [s / n for s in sums[1:]]
        return any(abs(a / drawn - p) > SIGMAS * (p * (1 - p) / n) ** 0.5 + 1e-9 for a, p in zip(node.stats, shares, strict=True))
    m1, m2, m3, m4 = (s / n for s in sums[1:])
    variance = max(0.0, m2 - m1 * m1)
    fourth = max(0.0, m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * m1**4)
    if abs(node.stats[1] / drawn - m1) > SIGMAS * (variance / n) ** 0.5 + 1e-9:
        return True
    return abs(impurity_of(node.stats, 0) - variance) > SIGMAS * (max(0.0, fourth - variance**2) / n) ** 0.5 + SIGMAS**2 * variance / n + 1e-9


def forest_faults(model: Model, rows: DataFrame, label: str, classes: int = 0) -> int:
    """What is wrong with a forest (a regression without `classes`), over its training rows: nodes at odds with their
    own sums, nodes too far from the rows that reach them, and one fault each if the leaves of all trees together
    deviate too much from the means of their rows, or if the trees' errors are too far above those of one mean."""
    nodes = stored_nodes(model)
    y = F.col(label).cast("double")
    values = [(y == k).cast("double") for k in range(classes)] if classes else [y, y * y, y * y * y, y * y * y * y]
    found = node_sums(model, rows, lambda tree, said: values, nodes)
    wrong, excess, expected, error, spread = 0, 0.0, 0.0, 0.0, 0.0
    for tree, own in nodes.items():
        wrong += wrong_nodes(own, classes) + sum(drawn_far(node, found[tree, at], classes) for at, node in own.items())
        for at, node in own.items():
            n, *sums = found[tree, at]
            if not n or (node.left >= 0 and at):
                continue
            means = [s / n for s in sums] if classes else sums[:1] and [sums[0] / n]
            variance = sum(p * (1 - p) for p in means) if classes else max(0.0, sums[1] / n - means[0] ** 2)
            if not at:
                spread += n * variance
            if node.left < 0:
                says = [s / sum(node.stats) for s in node.stats] if classes else [node.prediction]
                off = sum((a - m) ** 2 for a, m in zip(says, means, strict=True))
                excess, expected, error = excess + n * off, expected + variance, error + n * (variance + off)
    slack = 1e-9 * (1 + spread)
    return wrong + int(excess > MOST_DEVIATION * expected + slack) + int(error > spread + MOST_LOSS * expected + slack)
