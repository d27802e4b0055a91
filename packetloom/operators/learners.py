"""Supervised models on MLlib: baselines, boosted trees, search, feature selection, ensembles, batch scoring."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.functions.columns import finite_or_zero
from packetloom.functions.hashing import hash_uniform
from packetloom.operators.evaluation import (
    binary_metrics,
    comparison_row,
    macro_metrics,
    roc_auc,
    soft_vote,
    soft_vote_classes,
    with_class_weight,
)
from packetloom.operators.features import require_classes, strict_select
from packetloom.operators.sampling import stratified_split
from packetloom.session import settle

VECTOR = "features"
LABEL = "y"
WEIGHT = "weight"

# Defaults of the two boosted-tree configurations and the search ranges.
TREE_DEFAULTS = {
    "deep": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3},
    "wide": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1},
}
FOREST_TREES = 100
GRID = {
    "maxIter": [100, 200, 300],
    "maxDepth": [3, 5, 7, 10],
    "stepSize": [0.01, 0.1, 0.3],
    "subsamplingRate": [0.7, 0.9, 1.0],
}
RANGES = {"maxIter": (50, 300), "maxDepth": (3, 12), "stepSize": (0.01, 0.3), "subsamplingRate": (0.5, 1.0)}
SEED = 42


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model input vector; a missing feature is an error, missing and infinite values become 0."""
    strict_select(df, features)
    # plain working names, because feature names may hold dots
    names = [f"__x{i}" for i in range(len(features))]
    cleaned = df.withColumns({n: finite_or_zero(F.col(f"`{f}`")) for n, f in zip(names, features)})
    return VectorAssembler(inputCols=names, outputCol=VECTOR).transform(cleaned).drop(*names)


def estimator(kind: str, params: Mapping | None = None, task: str = "binary", seed: int = SEED, weight: str | None = None):
    """An unfitted learner: ``deep`` or ``wide`` boosted trees, ``forest``, ``logistic`` or ``svc``.

    Boosted trees of MLlib separate two classes; for more, one such model per class is fitted against the rest.
    """
    params = dict(params or {})
    common = {"featuresCol": VECTOR, "labelCol": LABEL}
    if weight:
        common["weightCol"] = weight
    if kind in TREE_DEFAULTS:
        trees = GBTClassifier(**common, seed=seed, **{**TREE_DEFAULTS[kind], **params})
        if task != "multiclass":
            return trees
        return OneVsRest(classifier=trees, featuresCol=VECTOR, labelCol=LABEL)
    if kind == "logistic":
        return LogisticRegression(**common, **{"maxIter": 1000, **params})
    if kind == "svc":
        return LinearSVC(**common, **params)
    return RandomForestClassifier(**common, seed=seed, **{"numTrees": FOREST_TREES, **params})


@dataclass
class TrafficModel:
    """A fitted learner with its feature list: probabilities and verdicts for any table that has the features."""

    model: Model
    features: list[str]
    name: str

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(assemble(df, self.features))
        return scored.withColumn("prediction", F.col("prediction").cast("int"))

    def with_probability(self, df: DataFrame, column: str) -> DataFrame:
        """Adds the probability of class 1 and nothing else."""
        scored = self.transform(df).withColumn(column, positive_probability())
        return scored.select(*df.columns, column)

    def with_class_probabilities(self, df: DataFrame, column: str) -> DataFrame:
        """Adds the probabilities of all classes as an array and nothing else.

        Of one model per class each gives the probability of its own class; they are scaled to a sum of one.
        """
        if not isinstance(self.model, OneVsRestModel):
            scored = self.transform(df).withColumn(column, vector_to_array("probability"))
            return scored.select(*df.columns, column)
        rows, parts = assemble(df, self.features), []
        for i, one in enumerate(self.model.models):
            parts.append(f"__p{i}")
            rows = one.transform(rows).withColumn(parts[-1], positive_probability())
            rows = rows.drop("probability", "rawPrediction", "prediction")
        total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
        scaled = F.array(*[F.when(total > 0, F.col(p) / total).otherwise(F.lit(1.0 / len(parts))) for p in parts])
        return rows.withColumn(column, scaled).select(*df.columns, column)


def positive_probability(column: str = "probability") -> Column:
    return F.get(vector_to_array(F.col(column)), F.lit(1))


def train(
    kind: str,
    df: DataFrame,
    features: Sequence[str],
    params: Mapping | None = None,
    task: str = "binary",
    seed: int = SEED,
    balanced: bool = False,
    name: str | None = None,
) -> TrafficModel:
    require_classes(df, LABEL)
    rows = with_class_weight(df, LABEL, WEIGHT) if balanced else df
    fitted = estimator(kind, params, task, seed, WEIGHT if balanced else None).fit(assemble(rows, features))
    return TrafficModel(fitted, list(features), name or kind)


def evaluate(model: TrafficModel, test: DataFrame, task: str = "binary") -> DataFrame:
    scored = model.transform(test)
    metrics = binary_metrics(scored, LABEL) if task == "binary" else macro_metrics(scored, LABEL)
    return comparison_row(metrics, model.name)


def train_baselines(train_rows: DataFrame, test: DataFrame, features: Sequence[str], params: Mapping | None = None) -> DataFrame:
    """Class-balanced logistic regression, random forest and linear SVC: precision, recall, F1, AUC, FAR.

    The AUC of the SVC uses its decision value.
    """
    params = params or {}
    report = None
    for kind, name in (("logistic", "LogisticRegression"), ("forest", "RandomForest"), ("svc", "LinearSVC")):
        model = train(kind, train_rows, features, params.get(kind), balanced=True, name=name)
        scored = model.transform(test)
        value = positive_probability() if kind != "svc" else F.get(vector_to_array("rawPrediction"), F.lit(1))
        ranked = scored.select(LABEL, "prediction", value.alias("score"))
        auc = roc_auc(ranked, "score", LABEL).select("auc").scalar()
        row = binary_metrics(ranked, LABEL).select(
            F.lit(name).alias("Model"),
            F.col("precision").alias("Precision"),
            F.col("recall").alias("Recall"),
            F.col("f1").alias("F1"),
            auc.alias("AUC"),
            F.col("far").alias("FAR"),
        )
        report = row if report is None else report.unionByName(row)
    return report


def sampled_grid(learner, grid: Mapping[str, Sequence], draws: int, seed: int = SEED) -> list[dict]:
    """Distinct random combinations of listed parameter values."""
    chooser = random.Random(seed)
    chosen: list[dict] = []
    total = 1
    for values in grid.values():
        total *= len(values)
    while len(chosen) < min(draws, total):
        candidate = {learner.getParam(n): chooser.choice(list(values)) for n, values in grid.items()}
        if candidate not in chosen:
            chosen.append(candidate)
    return chosen


def sampled_ranges(learner, ranges: Mapping[str, tuple], draws: int, seed: int = SEED) -> list[dict]:
    """Random points of parameter ranges; integers stay integers, the step size is drawn on a log scale."""
    chooser = random.Random(seed)

    def point(name: str, low, high):
        if isinstance(low, int):
            return chooser.randint(low, high)
        if name == "stepSize":
            return low * (high / low) ** chooser.random()
        return chooser.uniform(low, high)

    return [{learner.getParam(n): point(n, *r) for n, r in ranges.items()} for _ in range(draws)]


def f1_evaluator(task: str = "binary") -> MulticlassClassificationEvaluator:
    if task == "binary":
        return MulticlassClassificationEvaluator(
            labelCol=LABEL, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0
        )
    return MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1")


def random_search(
    df: DataFrame,
    features: Sequence[str],
    grid: Mapping[str, Sequence] = GRID,
    draws: int = 10,
    folds: int = 3,
    kind: str = "deep",
    parallelism: int = 4,
    seed: int = SEED,
) -> tuple[TrafficModel, dict[str, object], float]:
    """Random search with cross-validated F1 and weighted classes: (best model, its parameters, its F1)."""
    learner = estimator(kind, seed=seed, weight=WEIGHT)
    candidates = sampled_grid(learner, grid, draws, seed)
    rows = assemble(with_class_weight(df, LABEL, WEIGHT), features).select(LABEL, WEIGHT, VECTOR)
    search = CrossValidator(
        estimator=learner, estimatorParamMaps=candidates, evaluator=f1_evaluator(), numFolds=folds,
        parallelism=parallelism, seed=seed,
    ).fit(rows)
    return _best(search.bestModel, search.avgMetrics, candidates, features, kind)


def tune(
    df: DataFrame,
    features: Sequence[str],
    ranges: Mapping[str, tuple] = RANGES,
    trials: int = 20,
    kind: str = "wide",
    task: str = "binary",
    key: Sequence[str] | None = None,
    seed: int = SEED,
) -> tuple[TrafficModel, dict[str, object], float]:
    """Random search on one 80/20 split, stratified by class, maximising F1: (best model, its parameters, its F1).

    The split is by a hash of ``key`` (default: of the features), so it does not depend on the partitions.
    """
    learner = estimator(kind, task=task, seed=seed)
    base = learner.getClassifier() if isinstance(learner, OneVsRest) else learner
    candidates = sampled_ranges(base, ranges, trials, seed)
    split = settle(stratified_split(df, LABEL, list(key or features), 0.2, salt=f"tune-{seed}"), "tuning")
    rows = assemble(split, features).select(LABEL, VECTOR, "is_test")
    fitting, judging = rows.where(~F.col("is_test")).cache(), rows.where("is_test").cache()
    measure, found = f1_evaluator(task), []
    for params in candidates:
        model = learner.copy() if isinstance(learner, OneVsRest) else learner
        if isinstance(learner, OneVsRest):
            model = model.setClassifier(base.copy(params)).fit(fitting)
        else:
            model = model.fit(fitting, params)
        found.append((measure.evaluate(model.transform(judging)), model))
    fitting.unpersist()
    judging.unpersist()
    return _best([m for _, m in found], [f1 for f1, _ in found], candidates, features, kind)


@dataclass
class Halving:
    """Best model, its parameters and its F1, the passes over all training rows that the search took, and its rounds."""

    model: TrafficModel
    params: dict[str, object]
    f1: float
    row_fits: float
    rounds: list[tuple[float, int, float]]


def halving_search(
    df: DataFrame,
    features: Sequence[str],
    ranges: Mapping[str, tuple] = RANGES,
    trials: int = 27,
    eta: int = 3,
    kind: str = "wide",
    task: str = "binary",
    key: Sequence[str] | None = None,
    fewest_rows: int = 2000,
    seed: int = SEED,
) -> Halving:
    """Successive halving: many draws are fitted on a small sample, the best ``1 / eta`` of them on ``eta`` times as many rows,
    until few are fitted on all.

    Samples are hash ranges of ``key`` (default: of the features), each part of the next, of at least ``fewest_rows``
    rows. All are judged on one hold-out of a fifth of the rows, stratified by class. A third of the places of the next
    round go to new draws near the best one so far, so the search moves to where it found something.
    """
    if eta < 2 or trials < 1:
        raise ValueError("halving needs a factor of at least 2 and a trial")
    learner = estimator(kind, task=task, seed=seed)
    base = learner.getClassifier() if isinstance(learner, OneVsRest) else learner
    keys = list(key or features)
    split = stratified_split(df, LABEL, keys, 0.2, salt=f"halving-{seed}")
    lot = hash_uniform([F.col(f"`{k}`") for k in keys], f"halving-sample-{seed}")
    rows = settle(assemble(split.withColumn("__lot", lot), features).select(LABEL, VECTOR, "is_test", "__lot"), "halving")
    fitting, judging = rows.where(~F.col("is_test")), rows.where("is_test")
    total, measure = fitting.count(), f1_evaluator(task)

    rungs = 0
    while eta ** (rungs + 1) <= trials:
        rungs += 1
    candidates = sampled_ranges(base, ranges, trials, seed)
    row_fits, rounds, found = 0.0, [], []
    for rung in range(rungs + 1):
        share = min(1.0, max(float(eta) ** (rung - rungs), fewest_rows / max(1, total)))
        sample = fitting if share >= 1 else fitting.where(F.col("__lot") < share)
        found = []
        for params in candidates:
            if isinstance(learner, OneVsRest):
                model = learner.copy().setClassifier(base.copy(params)).fit(sample)
            else:
                model = learner.fit(sample, params)
            found.append((measure.evaluate(model.transform(judging)), model, params))
        row_fits += share * len(candidates)
        found.sort(key=lambda x: -x[0])  # stable: ties keep the order of the draws
        rounds.append((share, len(candidates), found[0][0]))
        if share >= 1:
            break
        places = max(1, len(candidates) // eta)
        fresh = places // 3
        kept = [params for _, _, params in found[: places - fresh]]
        candidates = kept + _near(base, kept[0], ranges, fresh, seed + rung + 1)
    f1, model, params = found[0]
    return Halving(TrafficModel(model, list(features), kind), {p.name: x for p, x in params.items()}, float(f1), row_fits, rounds)


def _near(learner, params: Mapping, ranges: Mapping[str, tuple], draws: int, seed: int) -> list[dict]:
    """Draws from the quarter of every range around the values of ``params``."""
    chooser = random.Random(seed)

    def point(name: str, low, high):
        value = params[learner.getParam(name)]
        if isinstance(low, int) and isinstance(high, int):
            reach = max(1, (high - low) // 8)
            return chooser.randint(max(low, value - reach), min(high, value + reach))
        if name == "stepSize":
            reach = (high / low) ** 0.125
            return min(high, max(low, value * reach ** chooser.uniform(-1, 1)))
        return min(high, max(low, value + (high - low) * chooser.uniform(-0.125, 0.125)))

    return [{learner.getParam(n): point(n, *r) for n, r in ranges.items()} for _ in range(draws)]


def _best(model, metrics, candidates, features, kind):
    position = max(range(len(metrics)), key=metrics.__getitem__)
    params = {p.name: value for p, value in candidates[position].items()}
    best = model[position] if isinstance(model, list) else model
    return TrafficModel(best, list(features), kind), params, float(metrics[position])


def feature_importance(model: TrafficModel, spark: SparkSession, k: int | None = None) -> DataFrame:
    """Built-in importances, largest first; of one model per class their mean. Other models have none."""
    parts = model.model.models if isinstance(model.model, OneVsRestModel) else [model.model]
    if not all(hasattr(m, "featureImportances") for m in parts):
        raise ValueError(f"{model.name} has no feature importances")
    values = sum(m.featureImportances.toArray() for m in parts) / len(parts)
    rows = spark.createDataFrame(
        [(f, float(x)) for f, x in zip(model.features, values)], "feature string, importance double"
    ).orderBy(F.col("importance").desc(), "feature")
    return rows if k is None else rows.limit(k)


def select_features(df: DataFrame, features: Sequence[str], k: int, task: str = "binary", params: Mapping | None = None) -> list[str]:
    """Names of the ``k`` features a forest finds most important."""
    model = train("forest", df, features, params, task)
    return [r["feature"] for r in feature_importance(model, df.sparkSession, k).collect()]


def train_ensemble(
    train_rows: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    params: Mapping[str, Mapping] | None = None,
    seed: int = SEED,
    task: str = "binary",
    kinds: Sequence[str] = tuple(TREE_DEFAULTS),
) -> tuple[list[TrafficModel], DataFrame]:
    """Models of several kinds (default: both boosted-tree ones), their soft vote, and the comparison table of all."""
    params = params or {}
    models = [train(kind, train_rows, features, params.get(kind), task, seed) for kind in kinds]
    report = None
    for model in models:
        row = evaluate(model, test, task)
        report = row if report is None else report.unionByName(row)
    voted = ensemble_vote(models, test, task)
    metrics = binary_metrics(voted, LABEL) if task == "binary" else macro_metrics(voted, LABEL)
    return models, report.unionByName(comparison_row(metrics, "Ensemble"))


def ensemble_vote(models: Sequence[TrafficModel], rows: DataFrame, task: str = "binary") -> DataFrame:
    """Mean probability of the models and their verdict; for several classes the mean of every class and the largest."""
    names = [f"p_{m.name}" for m in models]
    for model, name in zip(models, names):
        rows = model.with_probability(rows, name) if task == "binary" else model.with_class_probabilities(rows, name)
    return soft_vote(rows, names) if task == "binary" else soft_vote_classes(rows, names)


def score_batch(model: TrafficModel, rows: DataFrame) -> DataFrame:
    """Class and confidence (largest class probability) for every row."""
    scored = model.with_class_probabilities(rows, "__classes")
    best = F.array_max("__classes")
    chosen = (F.array_position("__classes", best) - 1).cast("int")
    return scored.select(*rows.columns, chosen.alias("class"), best.alias("confidence"))


def scorer(model: TrafficModel, anomaly: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Flow scorer for the detection jobs: supervised probability and label, then the anomaly score."""

    def score(flows: DataFrame) -> DataFrame:
        supervised = model.with_probability(flows, "xgb_prob")
        return anomaly(supervised.withColumn("xgb_label", (F.col("xgb_prob") >= 0.5).cast("int")))

    return score
