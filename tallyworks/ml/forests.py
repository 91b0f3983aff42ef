"""Forests of several depths from one fit.

A tree is grown level by level: what a level draws and splits does not depend on how many levels follow. So the forest
of a smaller depth is the deeper one of the same other settings, cut there.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark import SparkContext
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame


class NestedForestClassifier(RandomForestClassifier):
    """A forest whose settings that differ in depth alone are fitted together, once at the largest depth, when a search
    fits many; each setting gets the model that a fit of its own gives."""

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> _FitMultipleIterator:
        own = [self.copy(params) for params in paramMaps]
        alike: dict[tuple, list[int]] = defaultdict(list)
        for i, estimator in enumerate(own):
            values = {p.name: repr(v) for p, v in estimator.extractParamMap().items() if p.name != "maxDepth"}
            alike[tuple(sorted(values.items()))].append(i)
        of = {i: key for key, group in alike.items() for i in group}
        locks, deepest = {key: threading.Lock() for key in alike}, {}

        def fitted(i: int) -> RandomForestClassificationModel:
            key = of[i]
            with locks[key]:
                if key not in deepest:
                    deepest[key] = max((own[j] for j in alike[key]), key=lambda e: e.getMaxDepth()).fit(dataset)
            return cut_at(deepest[key], own[i])

        return _FitMultipleIterator(fitted, len(own))


def cut_at(model: RandomForestClassificationModel, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """The model with all trees cut at the estimator's depth, and with its parameters."""
    depth, deep = estimator.getMaxDepth(), model._java_obj
    if depth == model.getMaxDepth():
        return model
    gateway = SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml
    kind = kinds.classification.DecisionTreeClassificationModel
    trees = deep.trees()
    cut = gateway.new_array(kind, len(trees))
    for i, tree in enumerate(trees):
        cut[i] = kind(tree.uid(), cut_node(kinds.tree, tree.rootNode(), depth), tree.numFeatures(), tree.numClasses())
    java = kinds.classification.RandomForestClassificationModel(deep.uid(), cut, deep.numFeatures(), deep.numClasses())
    made = estimator._copyValues(RandomForestClassificationModel(java))
    made._transfer_params_to_java()
    return made


def cut_node(kinds, node: JavaObject, depth: int) -> JavaObject:
    """The node without what lies more than `depth` levels below. As in any fit, two leaves that say the same are one."""
    below = node.subtreeDepth()
    if below <= depth:
        return node
    stats = node.impurityStats()
    if not depth:
        return kinds.LeafNode(node.prediction(), node.impurity(), stats)
    left, right = (cut_node(kinds, child, depth - 1) for child in (node.leftChild(), node.rightChild()))
    if left.subtreeDepth() == right.subtreeDepth() == 0 and left.prediction() == right.prediction():
        return kinds.LeafNode(left.prediction(), node.impurity(), stats)
    return kinds.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), stats)
