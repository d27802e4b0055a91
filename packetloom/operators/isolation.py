"""Isolation forest (Liu, Ting and Zhou 2008) as a Spark job.

Each tree needs at most ``sample_size`` rows. They are drawn by hash, one group per tree builds a tree in parallel, and the
node table (at most trees * (2 * sample_size - 1) rows) is broadcast for scoring with a vectorised function.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.functions.columns import finite_or_zero
from packetloom.operators.ordering import exact_quantiles
from packetloom.schemas import record
from packetloom.session import settle

TREES = 100
SAMPLE_SIZE = 256
AUTO_OFFSET = -0.5
EULER = 0.5772156649015329
NODES = record(tree="int", node="int", feature="int", threshold="double", left="int", right="int", path="double")


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def grow(rows: np.ndarray, max_depth: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes ``(node, feature, threshold, left, right, path)`` of one tree; leaves have feature -1 and their path length."""
    nodes: list[tuple] = []
    waiting = [(0, rows, 0)]
    following = 1
    while waiting:
        node, part, depth = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or len(varying) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + float(average_path(len(part)))))
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= cut
        left, right = following, following + 1
        following += 2
        nodes.append((node, feature, cut, left, right, 0.0))
        waiting += [(left, part[goes_left], depth + 1), (right, part[~goes_left], depth + 1)]
    return nodes


@dataclass
class Forest:
    """Fitted forest: node table, features and the offset that makes negative scores abnormal."""

    nodes: pd.DataFrame
    features: list[str]
    sample_size: int
    offset: float = AUTO_OFFSET

    def _tables(self):
        """Node attributes as trees x nodes arrays."""
        trees = int(self.nodes["tree"].max()) + 1
        width = int(self.nodes["node"].max()) + 1
        at = (self.nodes["tree"].to_numpy(), self.nodes["node"].to_numpy())

        def table(name: str, kind, fill=0):
            values = np.full((trees, width), fill, dtype=kind)
            values[at] = self.nodes[name].to_numpy()
            return values

        return (
            table("feature", np.int32, -1),
            table("threshold", np.float64),
            table("left", np.int32),
            table("right", np.int32),
            table("path", np.float64),
        )

    def score(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        """Add the decision score: lower is more abnormal, below 0 is an anomaly at the fitted offset."""
        spark = df.sparkSession
        shared = spark.sparkContext.broadcast(self._tables())
        scale = float(average_path(self.sample_size))
        offset = self.offset

        def decide(rows: pd.DataFrame) -> pd.Series:
            feature, threshold, left, right, path = shared.value
            x = rows.to_numpy(dtype=float)
            total = np.zeros(len(x))
            line = np.arange(len(x))
            for t in range(feature.shape[0]):
                node = np.zeros(len(x), dtype=np.int32)
                while True:
                    f = feature[t, node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    goes_left = x[line, np.maximum(f, 0)] <= threshold[t, node]
                    node = np.where(inner, np.where(goes_left, left[t, node], right[t, node]), node)
                total += path[t, node]
            return pd.Series(-np.exp2(-(total / feature.shape[0]) / scale) - offset)

        run = F.pandas_udf(decide, T.DoubleType())
        vector = F.struct(*[finite_or_zero(F.col(f"`{f}`")).alias(f"x{i}") for i, f in enumerate(self.features)])
        return df.withColumn(name, run(vector))

    def save(self, spark: SparkSession, path: str) -> None:
        meta = [(f, i, self.sample_size, self.offset) for i, f in enumerate(self.features)]
        spark.createDataFrame(self.nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(meta, "feature string, position int, sample_size int, offset double").write.mode(
            "overwrite"
        ).json(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        meta = spark.read.json(f"{path}/model").orderBy("position").collect()
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes").toPandas()
        return cls(nodes, [r["feature"] for r in meta], meta[0]["sample_size"], meta[0]["offset"])


def _tree_rows(df: DataFrame, key: Sequence[str], rows: int, trees: int, sample_size: int, salt: str) -> DataFrame:
    """Rows tagged with the tree they are drawn for: every tree draws ``sample_size`` of all rows without replacement.

    A row's lot for a tree is a hash of its key and the tree. Lots below a cut that nearly always leaves enough rows go on,
    and each tree keeps its smallest ones, so little more than the samples is shuffled.
    """
    cut = min(1.0, (sample_size + 8 * math.sqrt(sample_size) + 8) / max(1, rows))
    lots = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.xxhash64(*[F.col(k) for k in key], t, F.lit(salt)).alias("lot")),
    )
    low = -(1 << 63)
    chosen = F.filter(lots, lambda x: x["lot"] <= F.lit(min((1 << 63) - 1, low + int(cut * (1 << 64)))))
    drawn = df.withColumn("__lots", chosen).where(F.size("__lots") > 0)
    drawn = drawn.withColumn("__lot", F.explode("__lots")).withColumns({"tree": F.col("__lot.tree"), "__n": F.col("__lot.lot")})
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("__n", *key))
    return drawn.drop("__lots", "__lot").withColumn("__rank", rank).where(F.col("__rank") <= sample_size).drop("__rank")


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    trees: int = TREES,
    sample_size: int = SAMPLE_SIZE,
    contamination: float | None = None,
    seed: int = 42,
) -> Forest:
    """Fit on normal rows. ``contamination`` sets the offset so that this share of them scores below 0."""
    features = list(features)
    cleaned = df.select(*key, *[finite_or_zero(F.col(f"`{f}`")).alias(f"x{i}") for i, f in enumerate(features)])
    total = cleaned.count()
    drawn = _tree_rows(cleaned, key, total, trees, sample_size, f"forest-{seed}")
    columns = [f"x{i}" for i in range(len(features))]

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        values = rows.sort_values("__n")[columns].to_numpy(dtype=float)
        depth = math.ceil(math.log2(max(2, len(values))))
        nodes = grow(values, depth, np.random.default_rng([seed, tree]))
        return pd.DataFrame([(tree, *n) for n in nodes], columns=NODES.names)

    nodes = drawn.groupBy("tree").applyInPandas(build, NODES).toPandas()
    drawn_size = min(sample_size, total)
    forest = Forest(nodes, features, drawn_size)
    if contamination is not None:
        # the quantile takes several passes, the trees are walked once
        raw = settle(Forest(nodes, features, drawn_size, 0.0).score(df, "__score").select("__score"), "forest-scores")
        forest.offset = exact_quantiles(raw, {"__score": [contamination]})["__score"][0]
    return forest
