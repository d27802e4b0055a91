"""Feature attributions: linear closed form, sampled Shapley values, rankings and explanation documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.hashing import hash_uniform
from packetloom.operators.ordering import smallest

# Report sizes and texts.
BACKGROUND = 2000
TOP_REPORT = 10
TOP_LOCAL = 5
RISK_UP, RISK_DOWN = "Risk Increase", "Risk Decrease"


def take_by_hash(df: DataFrame, key: Sequence[str], rows: int, salt: str = "explain") -> DataFrame:
    """Repeatable selection of rows, for instance as background."""
    return smallest(df, hash_uniform([F.col(k) for k in key], salt), key, rows)


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return {f: float(row[f"m{i}"] or 0.0) for i, f in enumerate(features)}


def linear_attribution(
    df: DataFrame, key: str, weights: Mapping[str, float], means: Mapping[str, float]
) -> DataFrame:
    """Shapley values of a linear score: weight * (value - mean).

    One row per key with the array ``entries`` of (feature, value, attribution): ranking and documents are then
    computed inside the row, without a shuffle.
    """
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            (F.lit(w) * (F.col(f).cast("double") - F.lit(means[f]))).alias("attribution"),
        )
        for f, w in weights.items()
    ]
    return df.select(key, F.array(*cells).alias("entries"))


def unnest(nested: DataFrame, key: str) -> DataFrame:
    """Long form ``(key, feature, value, attribution)``."""
    return nested.select(key, F.inline("entries"))


def nest(attributions: DataFrame, key: str) -> DataFrame:
    """Array form of a long attribution table; an array has one entry per model feature."""
    return attributions.groupBy(key).agg(F.collect_list(F.struct("feature", "value", "attribution")).alias("entries"))


def linear_base(weights: Mapping[str, float], means: Mapping[str, float], intercept: float) -> float:
    return intercept + sum(w * means[f] for f, w in weights.items())


def sampled_shapley(
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    background: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    permutations: int = 16,
    salt: str = "shapley",
) -> DataFrame:
    """Shapley values of any model by sampled permutations (Strumbelj and Kononenko 2014).

    Returns the long form. For each explained row and permutation the features are switched one by one from a background row to the explained
    row. ``score`` adds the column ``score`` to all these mixed rows at once, so the model runs distributed. A mixed row
    counts for the feature switched last and against the feature switched next. Every given row is explained; its cost
    is ``permutations`` times the number of features. The background is a sample (``take_by_hash``), whose rows are
    numbered and looked up by number.
    """
    features = list(features)
    n_bg = background.count()
    if n_bg == 0:
        raise ValueError("the background is empty")
    numbered = background.select(
        (F.row_number().over(Window.orderBy(*features)) - 1).alias("__bg"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("__from"),
    )
    if n_bg <= BACKGROUND:
        numbered = F.broadcast(numbered)
    keyed = rows.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("__to"))
    draws = keyed.withColumn("__perm", F.explode(F.sequence(F.lit(1), F.lit(permutations)))).withColumn(
        "__bg", F.floor(hash_uniform([F.col(key), F.col("__perm")], f"{salt}-bg") * n_bg).cast("int")
    )
    # positions of the features in this permutation: rank of a per-feature hash
    lots = F.array(
        *[
            F.struct(hash_uniform([F.col(key), F.col("__perm"), F.lit(f)], salt).alias("u"), F.lit(i).alias("i"))
            for i, f in enumerate(features)
        ]
    )
    order = F.transform(F.array_sort(lots), lambda lot: lot["i"])
    steps = (
        draws.join(numbered, "__bg")
        .withColumn("__order", order)
        .withColumn("__step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    )
    taken = F.slice(F.col("__order"), F.lit(1), F.col("__step"))
    mixed = steps.withColumn("__taken", taken).withColumns(
        {
            f: F.when(F.array_contains("__taken", i), F.get("__to", F.lit(i))).otherwise(F.get("__from", F.lit(i)))
            for i, f in enumerate(features)
        }
    )
    scored = score(mixed)
    parts = F.array(
        F.struct(F.get("__order", F.col("__step") - 1).alias("i"), F.col("score").alias("part")),
        F.struct(F.get("__order", F.col("__step")).alias("i"), (-F.col("score")).alias("part")),
    )
    # out-of-range steps (before the first and after the last feature) give a NULL index
    contributions = scored.select(key, "__to", F.inline(parts)).where(F.col("i").isNotNull())
    names = F.array(*[F.lit(f) for f in features])
    return (
        contributions.groupBy(key, "i")
        .agg((F.sum("part") / F.lit(float(permutations))).alias("attribution"), F.first("__to").alias("__to"))
        .select(key, F.get(names, F.col("i")).alias("feature"), F.get("__to", F.col("i")).alias("value"), "attribution")
    )


def combine_classes(attributions: DataFrame, key: str, class_col: str = "class") -> DataFrame:
    """Several classes: the absolute attributions of the classes are added up per row and feature."""
    return attributions.groupBy(key, "feature").agg(
        F.first("value").alias("value"), F.sum(F.abs("attribution")).alias("attribution")
    )


def global_importance(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("attribution")).alias("mean_abs_shap"))
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )


def _top(n: int) -> Column:
    """The ``n`` entries with the largest absolute attribution, ties by feature name."""
    sortable = F.transform(
        "entries",
        lambda e: F.struct(
            (-F.abs(e["attribution"])).alias("order"),
            e["feature"].alias("feature"),
            e["value"].alias("value"),
            e["attribution"].alias("attribution"),
        ),
    )
    return F.slice(F.array_sort(sortable), 1, n)


def top_features(nested: DataFrame, key: str, n: int = TOP_LOCAL) -> DataFrame:
    """Long form of the ranking: one row per key and rank."""
    return nested.select(key, F.posexplode(_top(n)).alias("position", "entry")).select(
        key, (F.col("position") + 1).alias("rank"), "entry.feature", "entry.value", "entry.attribution"
    )


def explanation_documents(nested: DataFrame, key: str, n: int = TOP_REPORT) -> DataFrame:
    """Nested report rows: ``top_features`` array of (feature, value, shap_value, impact)."""
    report = F.transform(
        _top(n),
        lambda e: F.struct(
            e["feature"].alias("feature"),
            e["value"].alias("value"),
            e["attribution"].alias("shap_value"),
            F.when(e["attribution"] > 0, F.lit("Positive")).otherwise(F.lit("Negative")).alias("impact"),
        ),
    )
    return nested.select(key, report.alias("top_features"))


def local_explanations(nested: DataFrame, key: str, base: float | Column, n: int = TOP_LOCAL) -> DataFrame:
    """Per row: base value, nested top features with direction, and one sentence."""
    base = F.lit(base) if isinstance(base, (int, float)) else base

    def direction(entry: Column) -> Column:
        return F.when(entry["attribution"] > 0, F.lit(RISK_UP)).otherwise(F.lit(RISK_DOWN))

    details = F.transform(
        "top",
        lambda e: F.struct(
            e["feature"].alias("feature"),
            e["value"].alias("value"),
            e["attribution"].alias("impact_score"),
            direction(e).alias("impact_direction"),
            F.abs(e["attribution"]).alias("abs_impact"),
        ),
    )
    phrases = F.transform("top", lambda e: F.concat(e["feature"], F.lit(" ("), direction(e), F.lit(")")))
    sentence = F.concat(F.format_string("Base risk was %.2f. ", base), F.array_join(phrases, " "))
    return nested.select(key, _top(n).alias("top")).select(
        key, base.alias("base_value"), details.alias("top_features"), sentence.alias("explanation_text")
    )
