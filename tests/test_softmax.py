import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.operators import softmax
from packetloom.operators.evaluation import macro_metrics

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 3)).round(2)
    y = np.where(x[:, 0] > 0.4, 2, np.where(x[:, 1] * x[:, 2] > 0, 1, 0))
    rows = [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", *FEATURES, "y"]).repartition(4).cache()


def test_learns_classes_and_comes_back(spark, data, tmp_path):
    model = softmax.fit_softmax(data, FEATURES, rounds=6, depth=3)
    scored = model.transform(data).cache()
    assert macro_metrics(scored, "y").first()["f1"] > 0.9
    total = F.aggregate("probability", F.lit(0.0), lambda a, b: a + b)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    model.save(spark, str(tmp_path / "m"))
    again = softmax.SoftmaxModel.load(spark, str(tmp_path / "m"))
    x = np.random.default_rng(1).normal(size=(50, 3))
    assert (again.scores(x) == model.scores(x)).all()
    odd = spark.createDataFrame([(None, float("nan"), float("inf"))], "a double, b double, c double")
    assert model.transform(odd).first()["prediction"] in (0, 1, 2)


def test_first_level_equals_a_plain_search(spark, data):
    model = softmax.fit_softmax(data, FEATURES, rounds=1, depth=1, bins=8)
    rows = data.toPandas()
    binned, y = model.bins_of(rows[FEATURES].to_numpy()), rows["y"].to_numpy()
    for k in range(3):
        g, h = (y == k) - 1 / 3, np.full(len(y), 2 / 9)
        worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
        everything = np.ones(len(y), bool)
        gains = {
            (f, b): worth(binned[:, f] <= b) + worth(binned[:, f] > b) - worth(everything)
            for f in range(3) for b in range(binned[:, f].max())
        }
        tree = model.rounds[0][k]
        best = max(gains, key=lambda s: (round(gains[s], 9), -s[0], -s[1]))
        assert (tree.feature[0], tree.bin[0]) == best
        left = binned[:, best[0]] <= best[1]
        for node, part in ((1, left), (2, ~left)):
            assert tree.value[node] == pytest.approx(0.3 * 2 / 3 * g[part].sum() / (h[part].sum() + 1))


def test_partitions_do_not_matter(data):
    one = softmax.fit_softmax(data.coalesce(1), FEATURES, rounds=2, depth=2)
    many = softmax.fit_softmax(data.repartition(7), FEATURES, rounds=2, depth=2)
    for a, b in zip(one.rounds, many.rounds):
        for s, t in zip(a, b):
            assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and s.value == pytest.approx(t.value)


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError):
        softmax.fit_softmax(spark.createDataFrame([(1.0, 0)], "a double, y int"), ["a"])
