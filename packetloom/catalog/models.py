"""Model queries: MLlib learners, isolation forest and sampled attributions on the flow table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.catalog.sampling import _u as hash_sql
from packetloom.functions.hashing import hash_uniform
from packetloom.operators import explain, isolation, learners, softmax, tree_shapley
from packetloom.operators.evaluation import binary_metrics, flag_below, macro_metrics
from packetloom.operators.sampling import stratified_split
from packetloom.plans import anomaly, supervised
from packetloom.session import settle, shared_path
from packetloom.sources import writers

query = Catalog()

FEATURES = ["log_bytes", "pkts_total", "syn_count", "ack_count", "rst_count", "duration"]
SMALL = {"deep": {"maxIter": 8, "maxDepth": 4}, "wide": {"maxIter": 8, "maxDepth": 3, "stepSize": 0.2}}
FOREST = {"numTrees": 20, "maxDepth": 5}


def labelled_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with a learnable truth: the fixed scorer's verdict with five percent of the labels flipped."""
    scored = v.scored_flows(spark, sf_dir)
    flip = hash_uniform(F.col("flow_id"), "noise") < 0.05
    truth = F.when(flip, 1 - F.col("xgb_label")).otherwise(F.col("xgb_label"))
    return scored.select("flow_id", *FEATURES, truth.alias("y"))


def split_flows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test), written once because training reads them many times."""
    rows = settle(stratified_split(labelled_flows(spark, sf_dir), "y", ["flow_id"]), "flows")
    return rows.where(~F.col("is_test")), rows.where("is_test")


_LABELLED_SQL = v.SCORED_SQL + f""",
labelled AS (SELECT *, CASE WHEN {hash_sql("flow_id", "noise")} < 0.05 THEN 1 - xgb_label ELSE xgb_label END AS y FROM scored),
parted AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {hash_sql("flow_id", "split")}, flow_id) AS k, count(*) OVER (PARTITION BY y) AS n FROM labelled),
test AS (SELECT * FROM parted WHERE k <= floor(n * 0.2 + 0.5))"""

# Fitted models are not SQL. These queries return what must hold of them, row by row; the SQL states it.


@query("SELECT unnest(['LogisticRegression', 'RandomForest', 'LinearSVC']) AS model, true AS ranks_well, true AS separates, true AS consistent")
def ml_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per baseline: AUC and F1 above chance, rates within 0 and 1."""
    train, test = split_flows(spark, sf_dir)
    report = learners.train_baselines(
        train, test, FEATURES, {"forest": FOREST, "logistic": {"maxIter": 30}, "svc": {"maxIter": 20}}
    )
    rates = [F.col(c).between(0, 1) for c in ("Precision", "Recall", "F1", "AUC", "FAR")]
    return report.select(
        F.col("Model").alias("model"), (F.col("AUC") > 0.65).alias("ranks_well"), (F.col("F1") > 0.3).alias("separates"),
        reduce(and_, rates).alias("consistent"),
    )


@query("SELECT unnest(['deep', 'wide', 'Ensemble']) AS model, true AS separates, true AS consistent")
def ml_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both boosted models and their vote: F1 above chance, detection rate equal to recall."""
    train, test = split_flows(spark, sf_dir)
    report = learners.train_ensemble(train, test, FEATURES, SMALL)[1]
    return report.select(
        F.col("Model").alias("model"), (F.col("F1_Score") > 0.3).alias("separates"), (F.col("DR") == F.col("Recall")).alias("consistent")
    )


@query("SELECT unnest(range(1, 4))::INT AS rank, true AS known, true AS ordered")
def ml_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most important features of a forest, ranked."""
    train, _ = split_flows(spark, sf_dir)
    top = learners.feature_importance(learners.train("forest", train, FEATURES, FOREST), spark, 3)
    by_rank = Window.orderBy(F.col("importance").desc(), "feature")  # three rows
    ranked = top.withColumns({"rank": F.row_number().over(by_rank), "next": F.lead("importance").over(by_rank)})
    ordered = (F.col("importance") >= F.coalesce("next", F.lit(0.0))) & F.col("importance").between(1e-9, 1)
    return ranked.select("rank", F.col("feature").isin(*FEATURES).alias("known"), ordered.alias("ordered"))


@query("SELECT unnest(['log_bytes', 'pkts_total', 'syn_count', 'ack_count', 'rst_count', 'duration']) AS feature, true AS counted")
def ml_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of boosted trees for all features add up to one."""
    train, _ = split_flows(spark, sf_dir)
    found = learners.feature_importance(learners.train("wide", train, FEATURES, SMALL["wide"]), spark)
    total = F.sum("importance").over(Window.partitionBy())  # one row per feature
    return found.select("feature", ((F.abs(total - 1) < 1e-6) & F.col("importance").between(0, 1)).alias("counted"))


@query("SELECT 2::BIGINT AS selected, true AS useful")
def ml_feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model on the two features that a forest selects still separates the classes."""
    train, test = split_flows(spark, sf_dir)
    chosen = learners.select_features(train, FEATURES, 2, params=FOREST)
    row = learners.evaluate(learners.train("wide", train, chosen, SMALL["wide"]), test)
    return row.select(F.lit(len(set(chosen) & set(FEATURES))).cast("bigint").alias("selected"), (F.col("F1_Score") > 0.3).alias("useful"))


def _constant_f1(train: DataFrame) -> float:
    """F1 of a model that names every flow an attack."""
    share = train.agg(F.avg("y")).first()[0]
    return 2 * share / (1 + share)


def _beats_one_class(judged: DataFrame, train: DataFrame) -> bool:
    return binary_metrics(judged, learners.LABEL).first()["f1"] > _constant_f1(train) + 0.05


def _search_row(spark: SparkSession, params: dict, f1: float, allowed, train: DataFrame) -> DataFrame:
    inside = set(params) == set(allowed) and all(allowed[n](x) for n, x in params.items())
    return spark.createDataFrame([(inside, _constant_f1(train) + 0.05 < f1 <= 1.0)], "inside boolean, separates boolean")


@query("SELECT true AS inside, true AS separates")
def ml_random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of a cross-validated search is one of the listed combinations."""
    train, _ = split_flows(spark, sf_dir)
    grid = {"maxIter": [3, 5], "maxDepth": [2, 3], "stepSize": [0.1, 0.3]}
    _, params, f1 = learners.random_search(train, FEATURES, grid, draws=3)
    return _search_row(spark, params, f1, {n: values.__contains__ for n, values in grid.items()}, train)


@query(f"WITH {_LABELLED_SQL} SELECT flow_id, true AS class_valid, true AS confidence_valid, true AS beats_one_class FROM test")
def ml_batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test flow gets the class and the confidence that the margins of the saved trees give it."""
    train, test = split_flows(spark, sf_dir)
    model = learners.train("wide", train, FEATURES, SMALL["wide"])
    scored = learners.score_batch(model, test.select("flow_id", *FEATURES))
    leaves = tree_shapley.trees_of(spark, model.model)
    # margins from the saved trees alone, by a path of their own
    entries = explain.unnest(tree_shapley.tree_attribution(test, "flow_id", model), "flow_id")
    margins = entries.groupBy("flow_id").agg((F.sum("attribution") + leaves.base).alias("margin"))
    own = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("margin") * -2))
    judged = settle(scored.join(margins, "flow_id").join(test.select("flow_id", "y"), "flow_id").withColumn("own", own), "judged")
    return judged.select(
        "flow_id", ((F.col("class") == (F.col("own") > 0.5).cast("int")) | (F.abs(F.col("own") - 0.5) < 1e-9)).alias("class_valid"),
        (F.abs(F.col("confidence") - F.greatest("own", 1 - F.col("own"))) < 1e-9).alias("confidence_valid"),
        F.lit(_beats_one_class(judged.withColumn("prediction", F.col("class")), train)).alias("beats_one_class"),
    )


@query("SELECT true AS inside, true AS separates")
def ml_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of a search over ranges lies inside them."""
    train, _ = split_flows(spark, sf_dir)
    ranges = {"maxIter": (3, 6), "maxDepth": (2, 4), "stepSize": (0.05, 0.3)}
    _, params, f1 = learners.tune(train, FEATURES, ranges, trials=3, key=["flow_id"])
    return _search_row(spark, params, f1, {n: lambda x, r=r: r[0] <= x <= r[1] for n, r in ranges.items()}, train)


@query(f"WITH {v.PACKETS_SQL} SELECT packet_id, true AS class_valid, true AS confidence_valid FROM packets")
def ml_packet_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets scored by a saved detector that was fitted on packets: the training and the request path share its steps."""
    packets = v.packets(spark, sf_dir).select("packet_id", "src_ip", "dst_ip", "protocol", "length", "flags", "label")
    detector = supervised.fit_detector(packets, ["packet_id"], params=SMALL["wide"])
    path = shared_path(spark, "detector")
    writers.save_fitted(detector.model, path)
    scored = supervised.predict(writers.load_fitted(path), packets.drop("label"))
    return scored.select(
        "packet_id", F.col("class").isin(0, 1).alias("class_valid"), F.col("confidence").between(0.5, 1).alias("confidence_valid")
    )


def _vector_classes(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame, DataFrame]:
    """Names of all 64 values, and vectors to train and to test: the class is which of the first ten values is largest."""
    names = [f"x{i}" for i in range(64)]
    rows = v.table(spark, sf_dir, "embeddings").where(F.col("label").isNotNull())
    first = F.slice("embedding", 1, 10)
    largest = (F.array_position(first, F.array_max(first)) - 1).cast("int").alias("y")
    rows = rows.select("vec_id", largest, *[F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)])
    rows = settle(stratified_split(rows, "y", ["vec_id"]), "vectors")
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    return names, train, test


_CLASSES_SQL = f"""WITH named AS (SELECT vec_id, list_position(embedding[1:10], list_max(embedding[1:10])) AS label FROM embeddings WHERE label IS NOT NULL),
picked AS (SELECT vec_id, row_number() OVER (PARTITION BY label ORDER BY {hash_sql("vec_id::VARCHAR", "split")}, vec_id) AS k,
  count(*) OVER (PARTITION BY label) AS n FROM named)"""


@query(f"""{_CLASSES_SQL}
SELECT vec_id, 10::INT AS classes, true AS sums_to_one, true AS class_valid, true AS beats_one_class FROM picked WHERE k <= floor(n * 0.2 + 0.5)""")
def ml_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 values, ten classes, which of the first ten is largest: boosted trees per class and a forest vote."""
    names, train, test = _vector_classes(spark, sf_dir)
    small = {"wide": {"maxIter": 2, "maxDepth": 2}, "forest": {"numTrees": 10, "maxDepth": 4}}
    models = [learners.train(kind, train, names, small[kind], "multiclass") for kind in small]
    voted = settle(learners.ensemble_vote(models, test.select("vec_id", *names), "multiclass").select("vec_id", "probability_mean", "prediction"), "voted")
    # naming one class for all rows has a macro F1 below a fiftieth with ten classes
    judged = macro_metrics(voted.join(test.select("vec_id", "y"), "vec_id"), learners.LABEL).first()
    better = judged["f1"] > 0.2
    total = F.aggregate("probability_mean", F.lit(0.0), lambda a, b: a + b)
    return voted.select(
        "vec_id", F.size("probability_mean").alias("classes"), (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
        F.col("prediction").between(0, 9).alias("class_valid"), F.lit(better).alias("beats_one_class"),
    )


@query(f"WITH {_LABELLED_SQL} SELECT flow_id, y, true AS in_range, true AS share_as_asked, true AS planted_first FROM labelled")
def isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows scored by a forest fitted on the flows without an attack label: one in a hundred of those is below 0."""
    rows = settle(labelled_flows(spark, sf_dir), "flows")
    normal = rows.where("y = 0")
    forest = isolation.fit_forest(normal, FEATURES, ["flow_id"], contamination=0.01)
    scored = settle(forest.score(rows).select("flow_id", "y", "anomaly_score"), "scores")
    counts = scored.where("y = 0").agg(F.count_if(F.col("anomaly_score") < 0).alias("below"), F.count(F.lit(1)).alias("n")).first()
    asked = abs(counts["below"] - 0.01 * counts["n"]) <= 1 + 0.01 * counts["n"]  # equal scores share a side
    # flows far outside the range of all others must score below nearly all normal ones
    planted = explain.take_by_hash(normal, ["flow_id"], 20, "planted").withColumns({f: F.abs(F.col(f)) * 20 + 1000 for f in FEATURES})
    worst = forest.score(planted).agg(F.max("anomaly_score")).first()[0]
    lower = scored.where((F.col("y") == 0) & (F.col("anomaly_score") < worst)).count()
    return scored.select(
        "flow_id", "y", F.col("anomaly_score").between(-1, 1).alias("in_range"), F.lit(asked).alias("share_as_asked"),
        F.lit(lower <= 0.01 * counts["n"]).alias("planted_first"),
    )


@query(f"""WITH {v.SCORED_SQL},
labelled AS (SELECT flow_id, CASE WHEN {hash_sql("flow_id", "noise")} < 0.05 THEN 1 - xgb_label ELSE xgb_label END AS y FROM scored),
parted AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY {hash_sql("flow_id", "split")}, flow_id) AS k, count(*) OVER (PARTITION BY y) AS n FROM labelled)
SELECT count(*) FILTER (WHERE y = 0) AS normal, count(*) FILTER (WHERE y = 1) AS attacks, true AS consistent, true AS same_when_loaded FROM parted WHERE k <= floor(n * 0.5 + 0.5)""")
def anomaly_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest fitted on normal flows, threshold chosen and judged on labelled flows: every test row is judged once, and the saved detector flags the same."""
    rows = settle(labelled_flows(spark, sf_dir).withColumnRenamed("y", "label"), "flows")
    detector = anomaly.train_and_tune(rows.where("label = 0"), rows, ["flow_id"])
    path = shared_path(spark, "detector")
    detector.save(spark, path)
    verdicts = [d.flag(rows).select("flow_id", anomaly.SCORE, "prediction") for d in (detector, anomaly.AnomalyDetector.load(spark, path))]
    same = verdicts[0].exceptAll(verdicts[1]).isEmpty()
    rates = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1", "far", "dr")]
    return detector.test.select(
        (F.col("tn") + F.col("fp")).alias("normal"), (F.col("tp") + F.col("fn")).alias("attacks"), reduce(and_, rates).alias("consistent"),
        F.lit(same).alias("same_when_loaded"),
    )


@query(f"WITH {_LABELLED_SQL} SELECT flow_id, true AS flagged_below, true AS one_in_a_hundred FROM labelled")
def anomaly_retraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows below the percentile threshold of a forest retrained on normal flows."""
    rows = settle(labelled_flows(spark, sf_dir).withColumnRenamed("y", "label"), "flows")
    forest, threshold = anomaly.retrain_on_normal(rows.where("label = 0"), ["flow_id"])
    flagged = settle(flag_below(forest.score(rows), anomaly.SCORE, threshold).select("flow_id", "label", anomaly.SCORE, "prediction"), "flagged")
    counts = flagged.where("label = 0").agg(F.sum("prediction").alias("below"), F.count(F.lit(1)).alias("n")).first()
    share = abs(counts["below"] - 0.01 * counts["n"]) <= 1 + 0.01 * counts["n"]
    below = (F.col(anomaly.SCORE) < threshold) == (F.col("prediction") == 1)
    return flagged.select("flow_id", below.alias("flagged_below"), F.lit(share).alias("one_in_a_hundred"))


@query(f"WITH {_LABELLED_SQL} SELECT flow_id, 6::BIGINT AS features, true AS bounded FROM test")
def sampled_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributions of the boosted trees for every test flow: they add up to a difference of two probabilities."""
    train, test = split_flows(spark, sf_dir)
    model = learners.train("wide", train, FEATURES, SMALL["wide"])
    background = explain.take_by_hash(train, ["flow_id"], explain.BACKGROUND, "background")
    score = lambda mixed: model.with_probability(mixed, "score")
    found = explain.sampled_shapley(test, "flow_id", FEATURES, settle(background, "background"), score, permutations=8)
    scores = score(test.select("flow_id", *FEATURES)).select("flow_id", "score")
    added = found.groupBy("flow_id").agg(F.count(F.lit(1)).alias("features"), F.sum("attribution").alias("total")).join(scores, "flow_id")
    # the difference of the row's own probability and a mean of others'
    bounded = (F.col("score") - F.col("total")).between(-1e-9, 1 + 1e-9)
    return added.select("flow_id", "features", bounded.alias("bounded"))


@query(f"WITH {_LABELLED_SQL} SELECT flow_id, 6::BIGINT AS features, true AS adds_up FROM test")
def tree_shapley_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact attributions of the boosted trees for every test flow: they add up to its margin less that of an unknown flow."""
    train, test = split_flows(spark, sf_dir)
    model = learners.train("wide", train, FEATURES, SMALL["wide"])
    base = tree_shapley.trees_of(spark, model.model).base
    found = explain.unnest(tree_shapley.tree_attribution(test, "flow_id", model), "flow_id")
    margin = F.get(vector_to_array("rawPrediction"), F.lit(1))
    scores = model.transform(test).select("flow_id", margin.alias("margin"))
    added = found.groupBy("flow_id").agg(F.count(F.lit(1)).alias("features"), F.sum("attribution").alias("total")).join(scores, "flow_id")
    return added.select("flow_id", "features", (F.abs(F.col("total") + base - F.col("margin")) < 1e-9).alias("adds_up"))


@query("SELECT true AS inside, true AS beats_one_class, true AS cheaper")
def ml_halving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of a halving search lies inside the ranges, beats naming every flow an attack, and took fewer passes than draws."""
    train, _ = split_flows(spark, sf_dir)
    ranges = {"maxIter": (3, 6), "maxDepth": (2, 4), "stepSize": (0.05, 0.3)}
    found = learners.halving_search(train, FEATURES, ranges, trials=9, key=["flow_id"], fewest_rows=200)
    inside = set(found.params) == set(ranges) and all(ranges[n][0] <= x <= ranges[n][1] for n, x in found.params.items())
    return spark.createDataFrame([(inside, found.f1 > _constant_f1(train) + 0.05, found.row_fits < 9)], "inside boolean, beats_one_class boolean, cheaper boolean")


@query(f"""{_CLASSES_SQL}
SELECT vec_id, 10::INT AS classes, true AS sums_to_one, true AS beats_one_class FROM picked WHERE k <= floor(n * 0.2 + 0.5)""")
def ml_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten classes by trees that are grown for all of them at once, saved and loaded."""
    names, train, test = _vector_classes(spark, sf_dir)
    model = softmax.fit_softmax(train, names[:10], rounds=3, depth=3, bins=16)
    path = shared_path(spark, "softmax")
    model.save(spark, path)
    scored = settle(softmax.SoftmaxModel.load(spark, path).transform(test).select("vec_id", "y", "probability", "prediction"), "softmax")
    better = macro_metrics(scored, learners.LABEL).first()["f1"] > 0.3
    total = F.aggregate("probability", F.lit(0.0), lambda a, b: a + b)
    return scored.select(
        "vec_id", F.size("probability").alias("classes"), (F.abs(total - 1) < 1e-6).alias("sums_to_one"), F.lit(better).alias("beats_one_class")
    )
