"""Fitted models as small picklable scorers for the Python stages.

Both hold only model parameters, whose size follows from the number of features
or of trees and never from the data.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from hazeline.session import scratch_path


@dataclass(frozen=True)
class LinearPredictor:
    features: tuple
    weights: tuple
    intercept: float

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        return matrix @ np.asarray(self.weights) + self.intercept


@dataclass(frozen=True)
class TreePredictor:
    """Weighted sum of regression trees, padded to (tree, node) arrays.

    ``left`` is -1 at leaves; a row goes left when its value is at most the
    node's threshold. ``count`` is the training rows that reached the node.
    """

    features: tuple
    weights: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    count: np.ndarray

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        total = np.zeros(len(matrix))
        for part in self.parts(matrix):
            total += part
        return total

    def parts(self, matrix: np.ndarray):
        """What each tree in turn adds to the predictions."""
        rows = np.arange(len(matrix))
        for t, weight in enumerate(self.weights):
            node = np.zeros(len(matrix), dtype=np.int64)
            while True:
                inner = self.left[t, node] >= 0
                if not inner.any():
                    break
                goes_left = matrix[rows, np.maximum(self.feature[t, node], 0)] <= self.threshold[t, node]
                child = np.where(goes_left, self.left[t, node], self.right[t, node])
                node = np.where(inner, child, node)
            yield weight * self.value[t, node]


def linear_predictor(model, features) -> LinearPredictor:
    return LinearPredictor(tuple(features), tuple(model.coefficients.toArray()), float(model.intercept))


def unscaled_linear(model, scaler, features) -> LinearPredictor:
    """A linear model behind a standardising stage, folded into raw inputs."""
    weights = model.coefficients.toArray() / np.where(scaler.std.toArray() == 0, 1.0, scaler.std.toArray())
    shift = float(weights @ scaler.mean.toArray())
    return LinearPredictor(tuple(features), tuple(weights), float(model.intercept) - shift)


def tree_predictor(spark, model, features) -> TreePredictor:
    """Read the nodes of a boosted or bagged tree model from its saved table.

    The driver receives trees x nodes rows, a bound set by the model parameters.
    """
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"),
            node["id"].alias("id"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["prediction"].alias("value"),
            node["rawCount"].alias("count"),
        )
        .toPandas()
    )
    weights = np.asarray(model.treeWeights, dtype=float)
    if type(model).__name__.startswith("RandomForest"):
        weights = weights / weights.sum()
    shape = (len(weights), int(nodes["id"].max()) + 1)
    where = (nodes["tree"].to_numpy(), nodes["id"].to_numpy())

    def table(name, empty, dtype):
        out = np.full(shape, empty, dtype=dtype)
        out[where] = nodes[name].fillna(empty).to_numpy().astype(dtype)
        return out

    return TreePredictor(
        tuple(features),
        weights,
        table("left", -1, np.int64),
        table("right", -1, np.int64),
        table("feature", -1, np.int64),
        table("threshold", 0.0, float),
        table("value", 0.0, float),
        table("count", 0, float),
    )
