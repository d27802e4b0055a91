"""Model evaluation: confusion counts, rankings of scores, thresholds and promotion gates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.columns import present, ratio_or_zero
from packetloom.operators.ordering import EXACT_VALUES, TOTAL_ROWS, exact_quantiles, few, quantile_scan, running_totals
from packetloom.schemas import record
from packetloom.session import settle

# Sweep grid and gate limits.
SWEEP_FROM, SWEEP_TO, SWEEP_STEPS = 0.1, 50.0, 200
MIN_F1_GAIN = 0.0
MAX_FAR_INCREASE = 0.005
CANARY_MIN_F1 = 0.9
ZERO_DAY_MIN_RECALL = 0.1
SWEEP = record(step="int", threshold="double", tp="bigint", fp="bigint", fn="bigint", tn="bigint")


def confusion(df: DataFrame, truth: str = "y", predicted: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp as one aggregate, optionally per group."""
    y, p = F.col(truth), F.col(predicted)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, false alarm and detection rate from confusion counts; 0 for an empty base."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
            "far": ratio_or_zero(fp, fp + tn),
            "dr": ratio_or_zero(tp, tp + fn),
        }
    )


def binary_metrics(df: DataFrame, truth: str = "y", predicted: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return with_rates(confusion(df, truth, predicted, by))


def comparison_row(metrics: DataFrame, model: str) -> DataFrame:
    """One row of the model comparison table with its published column names."""
    return metrics.select(
        F.lit(model).alias("Model"),
        F.col("accuracy").alias("Accuracy"),
        F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"),
        F.col("f1").alias("F1_Score"),
        F.col("far").alias("FAR"),
        F.col("dr").alias("DR"),
    )


def per_class(df: DataFrame, truth: str = "y", predicted: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as truth or as prediction."""
    cells = df.select(
        F.inline(
            F.array(
                F.struct(F.col(truth).alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("hit")),
                F.struct(
                    F.col(predicted).cast(df.schema[truth].dataType).alias("class"),
                    F.lit(0).alias("t"),
                    F.lit(1).alias("p"),
                    (F.col(truth) == F.col(predicted)).cast("int").alias("hit"),
                ),
            )
        )
    )
    counts = cells.groupBy("class").agg(
        F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum("hit").alias("hits")
    )
    return counts.withColumns(
        {
            "precision": ratio_or_zero(F.col("hits"), F.col("predicted")),
            "recall": ratio_or_zero(F.col("hits"), F.col("support")),
            "f1": ratio_or_zero(2 * F.col("hits"), F.col("support") + F.col("predicted")),
        }
    )


def macro_metrics(df: DataFrame, truth: str = "y", predicted: str = "prediction") -> DataFrame:
    """Unweighted class means; false alarm and detection rate are not defined here and stay 0."""
    return per_class(df, truth, predicted).agg(
        (F.sum("hits") / F.nullif(F.sum("support"), F.lit(0))).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.lit(0.0).alias("far"),
        F.lit(0.0).alias("dr"),
    )


def class_report(df: DataFrame, truth: str = "y", predicted: str = "prediction") -> DataFrame:
    """Per-class rows plus the macro and the support-weighted average."""
    classes = per_class(df, truth, predicted)
    measures = ("precision", "recall", "f1")
    rows = classes.select(F.col("class").cast("string").alias("class"), *measures, "support")
    weight = F.nullif(F.sum("support"), F.lit(0))
    macro = classes.agg(
        F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support")
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(m) * F.col("support")) / weight).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    return rows.unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, score: str, truth: str = "y", slice_rows: int = TOTAL_ROWS) -> DataFrame:
    """Exact area under the ROC curve; equal scores count half."""
    y = F.col(truth)
    totals = running_totals(df, score, {"pos": F.count_if(y == 1), "neg": F.count_if(y == 0)}, slice_rows)
    won = F.col("pos").cast("double") * (F.col("neg_before").cast("double") + F.col("neg").cast("double") / 2.0)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return totals.agg((F.sum(won) / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def class_balance(df: DataFrame, label: str = "y") -> DataFrame:
    """Count per class, the balanced weight n / (k * n_class) and the ratio of class 0 to class 1."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per class
    size = {
        "weight": F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n")),
        "neg_pos_ratio": F.max(F.when(F.col(label).cast("string") == "0", F.col("n"))).over(everything)
        / F.max(F.when(F.col(label).cast("string") == "1", F.col("n"))).over(everything),
    }
    return counts.withColumns(size)


def with_class_weight(df: DataFrame, label: str = "y", name: str = "weight") -> DataFrame:
    """Balanced weight as a column, for learners with ``weightCol``; 1 for rows without a class."""
    weights = few(class_balance(df, label).select(F.col(label).alias("__class"), F.col("weight").alias("__weight")))
    joined = df.join(weights, F.col(label) == F.col("__class"), "left")
    return joined.withColumn(name, F.coalesce("__weight", F.lit(1.0))).drop("__class", "__weight")


def soft_vote(df: DataFrame, probabilities: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Mean of the class-1 probabilities of several models and the binary verdict."""
    mean = sum((F.col(p) for p in probabilities[1:]), F.col(probabilities[0])) / F.lit(float(len(probabilities)))
    return df.withColumn("probability_mean", mean).withColumn(
        "prediction", (F.col("probability_mean") >= threshold).cast("int")
    )


def soft_vote_classes(df: DataFrame, probability_arrays: Sequence[str]) -> DataFrame:
    """Mean class probabilities (arrays of equal length); the first largest class wins."""
    total = F.col(probability_arrays[0])
    for p in probability_arrays[1:]:
        total = F.zip_with(total, F.col(p), lambda a, b: a + b)
    n = float(len(probability_arrays))
    return df.withColumn("probability_mean", F.transform(total, lambda x: x / F.lit(n))).withColumn(
        "prediction", (F.array_position("probability_mean", F.array_max("probability_mean")) - 1).cast("int")
    )


def percentile_threshold(df: DataFrame, score: str, percentile: float = 99.0) -> float | None:
    """Score that ``percentile`` percent of the rows exceed (the anomaly threshold on normal traffic)."""
    return exact_quantiles(df, {score: [(100.0 - percentile) / 100.0]})[score][0]


def sweep_percentiles() -> list[float]:
    step = (SWEEP_TO - SWEEP_FROM) / (SWEEP_STEPS - 1)
    return [SWEEP_FROM + i * step for i in range(SWEEP_STEPS - 1)] + [SWEEP_TO]


def threshold_sweep(df: DataFrame, score: str, truth: str = "y", exact_values: int = EXACT_VALUES) -> DataFrame:
    """Confusion counts and rates for each of the 200 candidate thresholds (lower score: more abnormal).

    The thresholds are quantiles, found without moving rows. One aggregate then counts the rows between neighbouring
    thresholds on the map side, so only counts per bin are shuffled; rows below a threshold are sums of bins. Rows
    without a score are left out. What the score is made from is computed once: the passes read two stored columns.
    """
    known = df.select(F.col(score).cast("double").alias(score), truth)
    known = settle(known.where(present(F.col(score))), "sweep")
    found, size = quantile_scan(
        known,
        {score: [p / 100.0 for p in sweep_percentiles()]},
        {"rows": F.count(F.lit(1)), "positives": F.count_if(F.col(truth) == 1)},
        exact_values,
    )
    thresholds = [t for t in found[score] if t is not None]
    if not thresholds:
        return with_rates(df.sparkSession.createDataFrame([], SWEEP))
    edges = sorted(set(thresholds))
    cut = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="__score", outputCol="__bin")
    binned = cut.transform(known.select(F.col(score).cast("double").alias("__score"), truth))
    counted = binned.groupBy("__bin").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == 1).alias("pos"))
    bins = {int(r["__bin"]): (r["n"], r["pos"]) for r in counted.collect()}  # at most one more than thresholds
    below, flagged, hits = {}, 0, 0
    for i, edge in enumerate(edges):
        n, pos = bins.get(i, (0, 0))
        flagged, hits = flagged + n, hits + pos
        below[edge] = flagged, hits
    rows, positives = size["rows"], size["positives"]
    steps = []
    for step, t in enumerate(thresholds):
        flagged, tp = below[t]
        steps.append((step, t, tp, flagged - tp, positives - tp, rows - positives - (flagged - tp)))
    return with_rates(df.sparkSession.createDataFrame(steps, SWEEP))


def best_threshold(df: DataFrame, score: str, truth: str = "y", exact_values: int = EXACT_VALUES) -> DataFrame:
    """The first threshold with the highest F1."""
    return threshold_sweep(df, score, truth, exact_values).orderBy(F.col("f1").desc(), "step").limit(1)


def flag_below(df: DataFrame, score: str, threshold: float, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, (F.col(score) < F.lit(threshold)).cast("int"))


def score_histogram(df: DataFrame, score: str, truth: str = "y", bins: int = 50) -> DataFrame:
    """Density histogram of the finite scores per class over a common range; NULL, NaN and infinities are left out."""
    as_double = F.col(score).cast("double")
    df = df.where(present(as_double) & (F.abs(as_double) < F.lit(float("inf"))))
    span = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    lo, hi = (float(x) if x is not None else 0.0 for x in span)
    width = (hi - lo) / bins
    index = F.least(F.floor((F.col(score) - lo) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
    counts = df.groupBy(truth, index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # at most `bins` rows per class
    total = F.sum("count").over(Window.partitionBy(truth))
    density = F.col("count") / (total * F.lit(width)) if width > 0 else F.lit(None).cast("double")
    return counts.withColumn("density", density)


def promotion_gate(
    challenger: DataFrame,
    champion: DataFrame,
    canary: DataFrame | None = None,
    min_f1_gain: float = MIN_F1_GAIN,
    max_far_increase: float = MAX_FAR_INCREASE,
    strict: bool = False,
    canary_min_f1: float = CANARY_MIN_F1,
) -> DataFrame:
    """Compare two one-row metric tables; ``strict`` demands more than the limits instead of at least.

    The rows are tagged, stacked and folded by one aggregate, so no join is needed. A missing champion passes, since
    there is nothing to lose; a missing challenger or a demanded canary without a row fails, for want of evidence.
    """
    tagged = [challenger.select(F.lit("new").alias("who"), "f1", "far"), champion.select(F.lit("old").alias("who"), "f1", "far")]
    if canary is not None:
        tagged.append(canary.select(F.lit("canary").alias("who"), "f1", "far"))
    stacked = tagged[0]
    for part in tagged[1:]:
        stacked = stacked.unionByName(part)

    def pick(who: str, measure: str) -> Column:
        return F.max(F.when(F.col("who") == who, F.col(measure)))

    folded = stacked.agg(
        pick("new", "f1").alias("new_f1"),
        pick("old", "f1").alias("old_f1"),
        pick("new", "far").alias("new_far"),
        pick("old", "far").alias("old_far"),
        pick("canary", "f1").alias("canary_f1"),
    )
    gain, increase = F.col("new_f1") - F.col("old_f1"), F.col("new_far") - F.col("old_far")
    unsafe = F.lit(canary is None)
    safe = F.coalesce(F.col("canary_f1") >= F.lit(canary_min_f1), unsafe)
    better = (
        (gain > min_f1_gain) & (increase < max_far_increase)
        if strict
        else (gain >= min_f1_gain) & (increase <= max_far_increase)
    )
    return folded.select(
        gain.alias("f1_gain"),
        increase.alias("far_increase"),
        safe.alias("canary_passed"),
        (F.coalesce(better, F.col("old_f1").isNull()) & F.col("new_f1").isNotNull() & safe).alias("promoted"),
    )


def canary_gate(metrics: DataFrame, min_f1: float = CANARY_MIN_F1) -> DataFrame:
    return metrics.withColumn("passed", F.col("f1") >= F.lit(min_f1))


def zero_day_recall(held_out: DataFrame, predicted: str = "prediction", warn_below: float = ZERO_DAY_MIN_RECALL) -> DataFrame:
    """Share of a held-out attack class that the model still flags as an attack."""
    rate = F.avg((F.col(predicted) == 1).cast("double"))
    return held_out.agg(F.count(F.lit(1)).alias("n"), F.coalesce(rate, F.lit(0.0)).alias("recall")).withColumn(
        "missed", F.col("recall") < F.lit(warn_below)
    )
