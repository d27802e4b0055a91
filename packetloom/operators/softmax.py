"""Boosted trees for several classes at once: softmax gradients and one histogram aggregate per level.

A round grows one tree per class on the gradients of the softmax loss. Features are cut into a few bins by quantiles once, so
the sums of gradients by class, node, feature and bin tell all splits of a level, for all classes: tasks add them up
where the rows are, Spark adds the parts, and one row per node comes back. Nodes of a row follow from the trees so far, and
the scores of a round are stored, so nothing but those sums is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.functions.columns import finite_or_zero
from packetloom.operators.features import require_classes
from packetloom.session import get_text, put_text, settle

BINS, DEPTH, ROUNDS, STEP, L2, LEAST_HESSIAN = 32, 4, 30, 0.3, 1.0, 1e-3


@dataclass
class Tree:
    """Nodes by number, the children of n are 2n + 1 and 2n + 2; feature is -1 at a leaf, rows up to the bin go left."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        nodes = (1 << (depth + 1)) - 1
        return cls(np.full(nodes, -1), np.zeros(nodes, int), np.zeros(nodes))

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The deepest node that each row reaches."""
        at, line = np.zeros(len(bins), int), np.arange(len(bins))
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            right = bins[line, np.maximum(feature, 0)] > self.bin[at]
            at = np.where(inner, 2 * at + 1 + right, at)


@dataclass
class SoftmaxModel:
    features: list[str]
    classes: int
    edges: list[list[float]]
    rounds: list[list[Tree]] = field(default_factory=list)

    def bins_of(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)]) if len(x) else np.empty((0, len(self.edges)), int)

    def scores(self, x: np.ndarray) -> np.ndarray:
        bins, out = self.bins_of(x), np.zeros((len(x), self.classes))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.nodes_of(bins)]
        return out

    def with_class_probabilities(self, df: DataFrame, column: str) -> DataFrame:
        """Adds the probabilities of all classes as an array."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def probabilities(columns: pd.DataFrame) -> pd.Series:
            return pd.Series(list(softmax(shared.value.scores(columns.to_numpy(dtype=float)))))

        return df.withColumn(column, probabilities(F.struct(*[finite_or_zero(F.col(f"`{f}`")).alias(f"x{i}") for i, f in enumerate(self.features)])))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds probability and prediction, the first of the likeliest classes."""
        scored = self.with_class_probabilities(df, "probability")
        return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        trees = [[{"feature": t.feature.tolist(), "bin": t.bin.tolist(), "value": t.value.tolist()} for t in trees] for trees in self.rounds]
        put_text(spark, f"{path}/model.json", json.dumps({"features": self.features, "classes": self.classes, "edges": self.edges, "rounds": trees}))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SoftmaxModel:
        found = json.loads(get_text(spark, f"{path}/model.json"))
        rounds = [[Tree(np.asarray(t["feature"]), np.asarray(t["bin"]), np.asarray(t["value"])) for t in trees] for trees in found["rounds"]]
        return cls(found["features"], found["classes"], found["edges"], rounds)


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    return raised / raised.sum(axis=1, keepdims=True) if len(scores) else scores


def quantile_bins(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Inner edges of each feature: different approximate quantiles, one pass for all."""
    grid = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(finite_or_zero(F.col(f"`{f}`")), grid, F.lit(10_000)).alias(f"e{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(row[f"e{i}"] or [])) for i in range(len(features))]


def _arrays(batch: pa.RecordBatch, width: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    read = lambda name, kind, n: np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(-1, n)
    return batch.column("y").to_numpy(), read("bins", np.uint16, width), read("scores", np.float64, classes)


def _histograms(rows: DataFrame, trees: list[Tree], level: int, width: int, bins: int) -> DataFrame:
    """class, node, feature, bin, g, h, n: sums over the rows in the nodes of a level."""
    classes, first = len(trees), (1 << level) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (classes, 1 << level, width, bins)
        g, h, n = np.zeros(size), np.zeros(size), np.zeros(size)
        for batch in batches:
            y, binned, scores = _arrays(batch, width, classes)
            p = softmax(scores)
            for k, tree in enumerate(trees):
                node = tree.nodes_of(binned) - first
                mine = np.flatnonzero(node >= 0)
                gradient, hessian = (y[mine] == k) - p[mine, k], p[mine, k] * (1 - p[mine, k])
                for f in range(width):
                    cell = node[mine] * bins + binned[mine, f]
                    for total, weight in ((g, gradient), (h, hessian), (n, None)):
                        total[k, :, f, :] += np.bincount(cell, weight, minlength=(1 << level) * bins).reshape(-1, bins)
        at = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(a.astype(np.int32)) for a in at), pa.array(g[at]), pa.array(h[at]), pa.array(n[at].astype(np.int64))],
            names=["class", "node", "feature", "bin", "g", "h", "n"],
        )

    parts = rows.mapInArrow(run, "class int, node int, feature int, bin int, g double, h double, n long")
    return parts.groupBy("class", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def best_splits(histograms: DataFrame, l2: float = L2, least: float = LEAST_HESSIAN) -> DataFrame:
    """class, node, g, h of every node, and feature, bin, gain of its best split (null without one); ties: the first feature and bin."""
    of = Window.partitionBy("class", "node", "feature")
    left = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = histograms.withColumns({"lg": F.sum("g").over(left), "lh": F.sum("h").over(left), "tg": F.sum("g").over(of), "th": F.sum("h").over(of)})
    part = lambda g, h: g * g / (h + l2)
    rg, rh = F.col("tg") - F.col("lg"), F.col("th") - F.col("lh")
    gain = part(F.col("lg"), F.col("lh")) + part(rg, rh) - part(F.col("tg"), F.col("th"))
    # rounded, so that sums added in another order choose the same split
    usable = F.when((F.col("lh") >= least) & (rh >= least) & (gain > 1e-6), F.struct(F.round(gain, 9).alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin")))
    found = sums.withColumn("split", usable).groupBy("class", "node").agg(F.max("split").alias("split"), F.max_by("tg", "feature").alias("g"), F.max_by("th", "feature").alias("h"))
    return found.select("class", "node", "g", "h", (-F.col("split.feature")).alias("feature"), (-F.col("split.bin")).alias("bin"), F.col("split.gain").alias("gain"))


def fit_softmax(
    df: DataFrame,
    features: Sequence[str],
    label: str = "y",
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    step: float = STEP,
    bins: int = BINS,
    l2: float = L2,
) -> SoftmaxModel:
    """Fit on classes 0, 1, ...; missing and infinite values count as 0, rows without a label are left out.

    What the driver gets per level is one row per class and node.
    """
    known = df.where(F.col(label).isNotNull())
    require_classes(known, label)
    classes = int(known.agg(F.max(label)).first()[0]) + 1
    model = SoftmaxModel(list(features), classes, quantile_bins(known, features, bins))
    width, size = len(model.features), max(len(e) for e in model.edges) + 1

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f"x{i}").to_numpy() for i in range(width)])
            binned = model.bins_of(x).astype(np.uint16)
            zero = np.zeros(classes).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([b.tobytes() for b in binned], pa.binary()), pa.array([zero] * len(binned), pa.binary())], names=["y", "bins", "scores"]
            )

    stored = "y int, bins binary, scores binary"
    values = [finite_or_zero(F.col(f"`{f}`")).alias(f"x{i}") for i, f in enumerate(model.features)]
    rows = settle(known.select(F.col(label).cast("int").alias("y"), *values).mapInArrow(prepare, stored), "boosting")
    for _ in range(rounds):
        trees = [Tree.empty(depth) for _ in range(classes)]
        for level in range(depth + 1):
            histograms = _histograms(rows, trees, level, width, size)
            for r in best_splits(histograms, l2).collect():
                tree, node = trees[r["class"]], (1 << level) - 1 + r["node"]
                tree.value[node] = step * (classes - 1) / classes * r["g"] / (r["h"] + l2)
                if level < depth and r["feature"] is not None:
                    tree.feature[node], tree.bin[node] = r["feature"], r["bin"]
            # rows of nodes without a split stay in them and count for no later level
        model.rounds.append(trees)

        def advance(batches: Iterator[pa.RecordBatch], trees: list[Tree] = trees) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, binned, scores = _arrays(batch, width, classes)
                more = np.column_stack([tree.value[tree.nodes_of(binned)] for tree in trees])
                new = [s.tobytes() for s in scores + more]
                yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("bins"), pa.array(new, pa.binary())], names=["y", "bins", "scores"])

        rows = settle(rows.mapInArrow(advance, stored), "boosting")
    return model
