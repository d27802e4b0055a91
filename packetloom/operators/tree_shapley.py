"""Exact Shapley values of boosted trees.

The game of a row lets a coalition of features answer the splits on them; splits on other features are answered by the
shares of training rows on both sides. Under it a leaf is worth its value times one factor per feature of its path: whether
the row follows the splits on it, or the share of rows that do. The Shapley value of such a product is an integral of a
polynomial, which Gauss-Legendre nodes give exactly, so no coalition is listed: the work of a row is the number of
leaves times the square of their depth.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, OneVsRestModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions.columns import finite_or_zero
from packetloom.operators.learners import TrafficModel
from packetloom.session import delete, shared_path


@dataclass(frozen=True)
class Leaf:
    """Value of a leaf, weighted by its tree; per feature of its path the interval (low, high] and the share of rows."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


@dataclass(frozen=True)
class Trees:
    leaves: list[Leaf]
    #: The score when no feature is known: the mean over the training rows, path by path.
    base: float


def _leaves(nodes: dict[int, tuple], weight: float) -> Iterator[Leaf]:
    todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while todo:
        number, path = todo.pop()
        prediction, count, left, right, feature, threshold = nodes[number]
        if left < 0:
            names = sorted(path)
            rows = np.asarray([path[f] for f in names], float).reshape(-1, 3)
            yield Leaf(weight * prediction, np.asarray(names, int), rows[:, 0], rows[:, 1], rows[:, 2])
            continue
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        todo.append((left, path | {feature: (low, min(high, threshold), share * nodes[left][1] / count)}))
        todo.append((right, path | {feature: (max(low, threshold), high, share * nodes[right][1] / count)}))


def trees_of(spark: SparkSession, model: GBTClassificationModel) -> Trees:
    """Leaves of a fitted model, from its saved form; their number is bounded by its trees and depth."""
    path = shared_path(spark, "trees")
    model.write().save(path)
    try:
        rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    finally:
        delete(spark, path)
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        split = r["split"]
        if split["numCategories"] not in (-1, None) and r["leftChild"] >= 0:
            raise ValueError("splits on categories have no interval")
        threshold = split["leftCategoriesOrThreshold"][0] if r["leftChild"] >= 0 else 0.0
        trees.setdefault(r["treeID"], {})[r["id"]] = (
            r["prediction"], r["rawCount"], r["leftChild"], r["rightChild"], split["featureIndex"], threshold
        )
    leaves = [leaf for number, nodes in sorted(trees.items()) for leaf in _leaves(nodes, model.treeWeights[number])]
    return Trees(leaves, float(sum(leaf.value * leaf.share.prod() for leaf in leaves)))


def shapley(x: np.ndarray, trees: Trees) -> np.ndarray:
    """Attributions of every feature of every row; a row's add up to its score less the base."""
    deepest = max((len(leaf.features) for leaf in trees.leaves), default=0)
    points, weights = np.polynomial.legendre.leggauss(max(1, (deepest + 1) // 2))
    points, weights = (points + 1) / 2, weights / 2
    out = np.zeros_like(x, dtype=float)
    for leaf in trees.leaves:
        if not len(leaf.features):
            continue
        values = x[:, leaf.features]
        follows = ((values > leaf.low) & (values <= leaf.high)).astype(float)
        for u, w in zip(points, weights):
            factors = u * follows + (1 - u) * leaf.share
            out[:, leaf.features] += w * leaf.value * factors.prod(axis=1, keepdims=True) / factors * (follows - leaf.share)
    return out


def _attributed(df: DataFrame, key: str, features: Sequence[str], models: Sequence[Trees]) -> DataFrame:
    """key and __m: per model an array of entries, all models in one pass over the rows."""
    shared = df.sparkSession.sparkContext.broadcast(list(models))
    names = [f"x{i}" for i in range(len(features))]

    @F.pandas_udf("array<array<double>>")
    def attributions(columns: pd.DataFrame) -> pd.Series:
        x = columns.to_numpy(dtype=float)
        found = np.stack([shapley(x, trees) for trees in shared.value], axis=1)
        return pd.Series([list(row) for row in found])

    values = [finite_or_zero(F.col(f"`{f}`")) for f in features]
    parts = df.select(key, F.array(*values).alias("__x"), attributions(F.struct(*[v.alias(n) for v, n in zip(values, names)])).alias("__a"))

    def entries(one: Column) -> Column:
        cells = [(F.lit(f).alias("feature"), F.get("__x", F.lit(i)).alias("value"), F.get(one, F.lit(i)).alias("attribution")) for i, f in enumerate(features)]
        return F.array(*[F.struct(*cell) for cell in cells])

    return parts.select(key, F.transform("__a", entries).alias("__m"))


def tree_attribution(df: DataFrame, key: str, model: TrafficModel) -> DataFrame:
    """key and entries (feature, value, attribution) of every row, for the margin of a boosted-tree model of two classes.

    The probability is ``1 / (1 + exp(-2 margin))``. Missing and infinite values count as 0, as in the model.
    """
    if not isinstance(model.model, GBTClassificationModel):
        raise ValueError("exact attributions need boosted trees")
    found = _attributed(df, key, model.features, [trees_of(df.sparkSession, model.model)])
    return found.select(key, F.get("__m", F.lit(0)).alias("entries"))


def class_attributions(df: DataFrame, key: str, model: TrafficModel) -> DataFrame:
    """key, class, feature, value, attribution of every row and class, for a model of boosted trees per class."""
    if not isinstance(model.model, OneVsRestModel):
        raise ValueError("attributions by class need one model per class")
    trees = [trees_of(df.sparkSession, one) for one in model.model.models]
    found = _attributed(df, key, model.features, trees).select(key, F.posexplode("__m").alias("class", "entries"))
    return found.select(key, "class", F.inline("entries"))
