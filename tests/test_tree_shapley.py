import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from packetloom.operators import explain, learners, tree_shapley

FEATURES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6)).round(3)
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(int)
    kind = (x[:, 0] > 0).astype(int) + (x[:, 3] > 0.5)
    rows = [(i, *map(float, v), int(a), int(b)) for i, (v, a, b) in enumerate(zip(x, y, kind))]
    return spark.createDataFrame(rows, ["id", *FEATURES, "y", "kind"]).cache()


def coalition_value(trees, row, coalition):
    """Sum over the leaves of what a row is worth if only the coalition is known."""
    total = 0.0
    for leaf in trees.leaves:
        part = leaf.value
        for f, low, high, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
            part *= float(low < row[f] <= high) if f in coalition else share
        total += part
    return total


def by_definition(trees, row, n=6):
    out = []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        value = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for coalition in itertools.combinations(rest, size):
                known = set(coalition)
                value += weight * (coalition_value(trees, row, known | {i}) - coalition_value(trees, row, known))
        out.append(value)
    return out


def test_equals_all_coalitions_and_adds_up(spark, data):
    model = learners.train("wide", data, FEATURES, {"maxIter": 6, "maxDepth": 5, "stepSize": 0.3})
    trees = tree_shapley.trees_of(spark, model.model)
    scored = model.transform(data).withColumn("margin", F.get(vector_to_array("rawPrediction"), F.lit(1)))
    margins = {r["id"]: r["margin"] for r in scored.select("id", "margin").collect()}
    found = {r["id"]: r["entries"] for r in tree_shapley.tree_attribution(data, "id", model).collect()}
    assert len(found) == 600
    for i, entries in found.items():
        assert [e["feature"] for e in entries] == FEATURES
        assert abs(sum(e["attribution"] for e in entries) + trees.base - margins[i]) < 1e-9
    for i in (0, 7, 311):
        row = [e["value"] for e in found[i]]
        assert [e["attribution"] for e in found[i]] == pytest.approx(by_definition(trees, row), abs=1e-9)
    ranked = explain.global_importance(explain.unnest(tree_shapley.tree_attribution(data, "id", model), "id")).collect()
    assert {r["feature"] for r in ranked[:3]} == {"f0", "f1", "f2"}


def test_missing_values_and_other_models(spark, data):
    model = learners.train("wide", data, FEATURES, {"maxIter": 2, "maxDepth": 2})
    odd = data.limit(1).withColumn("f0", F.lit(None).cast("double")).withColumn("f1", F.lit(float("nan")))
    entries = tree_shapley.tree_attribution(odd, "id", model).first()["entries"]
    assert entries[0]["value"] == entries[1]["value"] == 0.0
    assert tree_shapley.tree_attribution(data.limit(0), "id", model).count() == 0
    with pytest.raises(ValueError):
        tree_shapley.tree_attribution(data, "id", learners.train("logistic", data, FEATURES, {"maxIter": 2}))


def test_classes_of_one_model_each(spark, data):
    rows = data.drop("y").withColumnRenamed("kind", "y")
    model = learners.train("wide", rows, FEATURES, {"maxIter": 3, "maxDepth": 3}, task="multiclass")
    found = tree_shapley.class_attributions(rows, "id", model)
    assert found.count() == 600 * 3 * 6 and {r["class"] for r in found.select("class").distinct().collect()} == {0, 1, 2}
    for number, one in enumerate(model.model.models):
        base = tree_shapley.trees_of(spark, one).base
        margin = F.get(vector_to_array("rawPrediction"), F.lit(1))
        scored = one.transform(learners.assemble(rows, FEATURES)).select("id", margin.alias("m"))
        total = found.where(F.col("class") == number).groupBy("id").agg(F.sum("attribution").alias("t")).join(scored, "id")
        assert total.agg(F.max(F.abs(F.col("t") + base - F.col("m")))).first()[0] < 1e-9
    combined = explain.combine_classes(found, "id")
    top = {r["feature"] for r in explain.global_importance(combined).limit(2).collect()}
    assert combined.count() == 3600 and top == {"f0", "f3"}


def test_halving_finds_a_planted_optimum_with_fewer_fits(spark, data):
    """Only deep trees can tell the classes: the search must end there, with less work than as many full fits."""
    ranges = {"maxDepth": (1, 4), "maxIter": (2, 4), "stepSize": (0.1, 0.5)}
    x = np.random.default_rng(6).normal(size=(5000, 2))
    many = spark.createDataFrame([(i, float(a), float(b), int((a > 0) ^ (b > 0))) for i, (a, b) in enumerate(x)], ["id", "f0", "f1", "y"]).cache()
    found = learners.halving_search(many, FEATURES[:2], ranges, trials=9, key=["id"])
    assert found.params["maxDepth"] >= 3 and found.f1 > 0.8
    assert found.row_fits < 9 and [n for _, n, _ in found.rounds] == [9, 3, 1]
    found = learners.halving_search(many, FEATURES[:2], ranges, trials=9, key=["id"], fewest_rows=400)
    assert found.row_fits < 3.5 and found.f1 > 0.8 and [n for _, n, _ in found.rounds] == [9, 3, 1]
    assert learners.halving_search(data, FEATURES, ranges, trials=1, key=["id"]).row_fits == 1
    with pytest.raises(ValueError):
        learners.halving_search(data, FEATURES, ranges, trials=0)
