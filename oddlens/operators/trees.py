"""Outputs of the single trees of a boosted model, a batch of rows at a time.

Spark scores a whole ensemble itself. What it cannot give is the output of each tree:
running margins for a history, and the margins of the trees that use one feature. Here
the node table that Spark writes with a model becomes a few arrays, and a batch of rows
walks down all nodes of a tree level by level in numpy, inside tasks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddlens.sources.stages import StageStore

#: Rows that walk down the trees at once.
ROWS = 2048


def node_table(model: GBTClassificationModel, spark: SparkSession) -> DataFrame:
    """Spark's own node table of a model: one row per node."""
    path = StageStore(spark, run="models").path(uuid.uuid4().hex[:16])
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


@dataclass(frozen=True)
class TreeArrays:
    """Nodes of all trees, tree after tree. A leaf is its own child on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    output: np.ndarray  # of a node, times the weight of its tree
    depth: int
    #: For splits on categories: the row in ``members``, which marks the categories that go left; -1 for others.
    kind: np.ndarray
    members: np.ndarray

    def margins(self, x: np.ndarray, trees: np.ndarray | None = None) -> np.ndarray:
        """One row per row of ``x`` and one column per tree: what the tree adds to the margin."""
        chosen = np.arange(len(self.roots)) if trees is None else trees
        node = np.tile(self.roots[chosen], (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            value = x[row, self.feature[node]]
            down = value <= self.threshold[node]
            if len(self.members):
                kind = self.kind[node]
                code = np.clip(value, 0, self.members.shape[1] - 1).astype(np.int64)
                down = np.where(kind >= 0, self.members[kind, code], down)
            node = np.where(down, self.left[node], self.right[node])
        return self.output[node]

    def users(self, feature: int) -> np.ndarray:
        """The trees with a split on a feature."""
        tree = np.searchsorted(self.roots, np.arange(len(self.feature)), "right") - 1
        return np.unique(tree[(self.feature == feature) & (self.left != np.arange(len(self.left)))])


def tree_arrays(model: GBTClassificationModel, spark: SparkSession, count: int | None = None) -> TreeArrays:
    """The first ``count`` trees (all of them by default); as many nodes as the parameters of the fit allow."""
    weights = model.treeWeights
    count = len(weights) if count is None else count
    rows = node_table(model, spark).where(F.col("treeID") < count).select("treeID", "id", "prediction", "leftChild", "rightChild", "split").orderBy("treeID", "id").collect()
    roots = np.flatnonzero(np.diff([-1, *(r.treeID for r in rows)]))
    base = roots[np.cumsum(np.diff([rows[0].treeID, *(r.treeID for r in rows)]) != 0)]
    own = np.arange(len(rows))
    inner = np.array([r.leftChild >= 0 for r in rows])
    left, right = (np.where(inner, base + np.array([getattr(r, c) for r in rows]), own) for c in ("leftChild", "rightChild"))
    threshold, kind, sets = np.zeros(len(rows)), np.full(len(rows), -1), []
    for k, r in enumerate(rows):
        if r.leftChild >= 0 and r.split.numCategories >= 0:
            kind[k] = len(sets)
            sets.append((r.split.numCategories, r.split.leftCategoriesOrThreshold))
        elif r.leftChild >= 0:
            threshold[k] = r.split.leftCategoriesOrThreshold[0]
    members = np.zeros((len(sets), max((n for n, _ in sets), default=0)), bool)
    for k, (_, chosen) in enumerate(sets):
        members[k, np.array(chosen, np.int64)] = True
    depth, level = 0, roots
    while (left[level] != level).any():
        level = np.concatenate([left[level], right[level]])
        level, depth = level[left[level] != level], depth + 1
        if not len(level):
            break
    return TreeArrays(
        roots=roots,
        feature=np.where(inner, [max(r.split.featureIndex, 0) for r in rows], 0),
        threshold=threshold,
        left=left,
        right=right,
        output=np.array([r.prediction * weights[r.treeID] for r in rows]),
        depth=depth,
        kind=kind,
        members=members,
    )


def first_trees(model: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """A model of the first ``count`` trees, scored by Spark as one ensemble."""
    context = SparkContext._active_spark_context
    gateway = context._gateway
    classes = context._jvm.org.apache.spark.ml
    trees = gateway.new_array(classes.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(context._jvm.double, count)
    own = model._java_obj.trees()
    for k in range(count):
        trees[k] = own[k]
        weights[k] = float(model.treeWeights[k])
    java = classes.classification.GBTClassificationModel(f"{model.uid}_{count}", trees, weights, model.numFeatures, 2)
    java.setFeaturesCol(model.getFeaturesCol())
    return GBTClassificationModel(java)
