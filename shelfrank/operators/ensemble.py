"""Tree ensembles as node tables, and their scoring.

A model is a small list of nodes (see ``schemas.TREE_NODES``): at most a few
hundred trees of a few dozen leaves. It is data of the plan, not of the tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from shelfrank.schemas import TREE_NODES

# up to this many trees the model is a generated expression inside the codegen
EXPRESSION_TREES = 50


@dataclass(frozen=True)
class Node:
    """A split (``feature`` from 1, ``x <= threshold`` goes left) or a leaf."""

    tree: int
    node: int
    weight: float
    feature: int | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    output: float | None = None

    @property
    def is_leaf(self) -> bool:
        return self.feature is None


Model = Sequence[Node]


def model_frame(spark: SparkSession, model: Model | LinearModel) -> DataFrame:
    """A model as rows; a linear one has a row per feature, without leaf or children."""
    if isinstance(model, LinearModel):
        model = [Node(i, 0, weight, feature=i) for i, weight in enumerate(model.weights, 1)]
    return spark.createDataFrame([asdict(node) for node in model], TREE_NODES)


def model_from_frame(nodes: DataFrame) -> list[Node] | LinearModel:
    """A model is a bounded table; its nodes become part of the plan."""
    rows = nodes.select(*TREE_NODES.names).orderBy("tree", "node").collect()
    if rows and all(row["output"] is None and row["left"] is None for row in rows):
        return LinearModel(tuple(row["weight"] for row in rows))
    return [Node(**row.asDict()) for row in rows]


def _by_tree(model: Model) -> list[dict[int, Node]]:
    trees: dict[int, dict[int, Node]] = {}
    for node in model:
        trees.setdefault(node.tree, {})[node.node] = node
    return [trees[tree] for tree in sorted(trees)]


def value_at(features: Column, position: int) -> Column:
    """A feature that is NULL, or beyond the array, or of a NULL array counts as 0.

    NaN stays NaN: it is above every threshold, so it goes right.
    """
    return F.coalesce(F.get(features, F.lit(position)), F.lit(0.0))


def tree_column(nodes: dict[int, Node], features: Column, leaf_id: bool = False) -> Column:
    """One tree as nested conditions; the leaf's number instead of its output on request."""

    def walk(number: int) -> Column:
        node = nodes[number]
        if node.is_leaf:
            return F.lit(node.node) if leaf_id else F.lit(float(node.output))
        return F.when(value_at(features, node.feature - 1) <= F.lit(node.threshold), walk(node.left)).otherwise(
            walk(node.right)
        )

    return walk(0)


def _flat(model: Model):
    """The trees as arrays; leaves point at themselves."""
    trees = _by_tree(model)
    width = max(len(nodes) for nodes in trees)
    shape = (len(trees), width)
    feature = np.zeros(shape, dtype=np.int64)
    threshold = np.full(shape, np.inf)
    left = np.tile(np.arange(width), (len(trees), 1))
    right = left.copy()
    output = np.zeros(shape)
    weight = np.array([nodes[0].weight for nodes in trees])
    for row, nodes in enumerate(trees):
        for number, node in nodes.items():
            if node.is_leaf:
                output[row, number] = node.output
            else:
                feature[row, number] = node.feature - 1
                threshold[row, number] = node.threshold
                left[row, number] = node.left
                right[row, number] = node.right
    return feature, threshold, left, right, output, weight


def _batch_column(model: Model, features: Column) -> Column:
    flat = _flat(model)
    rounds = max(len(nodes) for nodes in _by_tree(model))

    @pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        feature, threshold, left, right, output, weight = flat
        rows_of_trees = np.arange(len(weight))
        for batch in batches:
            values = np.array(batch.tolist(), dtype=float)
            at = np.zeros((len(values), len(weight)), dtype=np.int64)
            for _ in range(rounds):
                x = np.take_along_axis(values, feature[rows_of_trees, at], axis=1)
                step = np.where(
                    x <= threshold[rows_of_trees, at],
                    left[rows_of_trees, at],
                    right[rows_of_trees, at],
                )
                if np.array_equal(step, at):
                    break
                at = step
            yield pd.Series(output[rows_of_trees, at] @ weight)

    # whole arrays without NULL, by the same rule as in the expression
    used = max((node.feature for node in model if not node.is_leaf), default=1)
    return score(F.array(*[value_at(features, position) for position in range(used)]))


def ensemble_column(model: Model, features: Column) -> Column:
    """Sum of weight times leaf over all trees."""
    trees = _by_tree(model)
    if not trees:
        return F.lit(0.0)
    if len(trees) > EXPRESSION_TREES:
        return _batch_column(model, features)
    total = F.lit(0.0)
    for nodes in trees:
        total = total + F.lit(float(nodes[0].weight)) * tree_column(nodes, features)
    return total


@dataclass(frozen=True)
class LinearModel:
    """Weights per feature, as coordinate ascent finds them."""

    weights: tuple[float, ...]

    def column(self, features: Column) -> Column:
        total = F.lit(0.0)
        for position, weight in enumerate(self.weights):
            total = total + F.lit(float(weight)) * value_at(features, position)
        return total


def score_column(model: Model | LinearModel, features: Column) -> Column:
    if isinstance(model, LinearModel):
        return model.column(features)
    return ensemble_column(model, features)


def score_ensemble(
    df: DataFrame, model: Model | LinearModel, features: str = "features", name: str = "model_score"
) -> DataFrame:
    return df.withColumn(name, score_column(model, F.col(features)))
