"""Tree ensembles as flat arrays, walked by all rows of an Arrow batch at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyscore.functions.kernels import _matrix, skipping_nulls

#: Places in the trees (rows times trees) that one step of a walk holds.
PLACES = 1 << 20


@dataclass(frozen=True)
class FlatTrees:
    """Nodes of all trees, breadth first. A row goes left where its feature is at most the threshold; a leaf leads to
    itself. Trees from one of ``rounds`` to the next are summed by their weights; the outputs are those sums, each with
    all before it."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    weights: np.ndarray
    rounds: np.ndarray

    @classmethod
    def of(cls, trees: Sequence[dict[int, tuple]], weights: Sequence[float], rounds: Sequence[int] | None = None) -> FlatTrees:
        """``trees``: for each, node id -> (feature, threshold, left, right, value), with feature -1 for a leaf and the root at the least id.
        ``rounds`` are the places of the first trees of the rounds; without them each tree is one."""
        roots, nodes, depth = [], [], 0
        for tree in trees:
            level, place = [min(tree)], {}
            roots.append(len(nodes))
            order, steps = [], -1
            while level:
                order += level
                level = [child for i in level if tree[i][0] >= 0 for child in tree[i][2:4]]
                steps += 1
            depth = max(depth, steps)
            place = {i: roots[-1] + k for k, i in enumerate(order)}
            for i in order:
                feature, threshold, left, right, value = tree[i]
                inner = feature >= 0
                nodes.append((max(feature, 0), threshold if inner else np.inf, place[left] if inner else place[i], place[right] if inner else place[i], value))
        columns = list(zip(*nodes))
        kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
        arrays = [np.array(c, k) for c, k in zip(columns, kinds)]
        starts = np.arange(len(trees)) if rounds is None else np.asarray(rounds)
        return cls(np.array(roots, np.int32), *arrays, depth, np.asarray(weights, float), starts)


def walk(features: Column, flat: FlatTrees) -> Column:
    """The outputs of an ensemble, one for each round, for an array of features; null for null."""
    matrix, places = _matrix(), PLACES
    roots, feature, threshold, left, right, value, depth, weights, rounds = (getattr(flat, n) for n in flat.__dataclass_fields__)

    skip = skipping_nulls

    @F.arrow_udf("array<double>")
    def outputs(column):
        return skip(sums)(column)

    def sums(column):
        import numpy as np
        import pyarrow as pa

        n, trees = len(column), len(roots)
        x = matrix(column, len(column.flatten()) // n if n else 0)
        out = np.empty((n, len(rounds)))
        step = max(1, places // max(trees, 1))
        for start in range(0, n, step):
            rows = x[start : start + step]
            at = np.tile(roots, (len(rows), 1))
            each = np.arange(len(rows))[:, None]
            for _ in range(depth):
                at = np.where(rows[each, feature[at]] <= threshold[at], left[at], right[at])
            out[start : start + step] = np.cumsum(np.add.reduceat(value[at] * weights, rounds, axis=1), axis=1)
        offsets = np.arange(n + 1, dtype=np.int32) * len(rounds)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return outputs(features)


def saved_trees(nodes: DataFrame, classes: bool) -> list[dict[int, tuple]]:
    """Trees of a saved Spark ensemble or tree, from its table of nodes, in the order of their ids.

    ``classes``: a leaf's value is the share of class 1, else its prediction.
    """
    node = F.col("nodeData") if "nodeData" in nodes.columns else F.struct("*")
    tree = F.col("treeID") if "treeID" in nodes.columns else F.lit(0)
    table = nodes.select(tree.alias("tree"), node.alias("n")).select(
        "tree", "n.id", "n.leftChild", "n.rightChild", "n.prediction", "n.impurityStats",
        F.col("n.split.featureIndex").alias("feature"), F.col("n.split.leftCategoriesOrThreshold").alias("at"), F.col("n.split.numCategories").alias("categories"),
    )
    trees: dict[int, dict[int, tuple]] = {}
    for r in table.collect():
        if r.leftChild >= 0 and r.categories != -1:
            raise ValueError("only splits at a threshold can be walked")
        value = r.impurityStats[1] / sum(r.impurityStats) if classes else r.prediction
        inner = r.leftChild >= 0
        split = (r.feature, r.at[0], r.leftChild, r.rightChild) if inner else (-1, 0.0, -1, -1)
        trees.setdefault(r.tree, {})[r.id] = (*split, value)
    return [trees[t] for t in sorted(trees)]
