"""Drift between two tables and in the alert rate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.operators.ordering import exact_quantiles
from packetloom.schemas import SEVERE_LEVELS

# Monitored columns, weights and limits of the drift score.
MONITORED = ("duration", "orig_pkts", "id.resp_p", "proto")
BUCKETS = 10
EMPTY_SHARE = 1e-4
PSI_DRIFT = 0.2
PSI_FULL_SCORE = 0.4
MAX_RATE_CHANGE = 0.1
FEATURE_WEIGHT, PREDICTION_WEIGHT = 0.6, 0.4
WARNING_SCORE, RETRAIN_SCORE = 0.5, 0.8


def quantile_edges(reference: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> dict[str, list[float]]:
    grid = [i / buckets for i in range(buckets + 1)]
    found = exact_quantiles(reference, {c: grid for c in columns})
    return {c: edges for c, edges in found.items() if edges[0] is not None}


def equal_width_edges(reference: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> dict[str, list[float]]:
    """Edges of equal width between minimum and maximum."""
    row = reference.agg(
        *[F.min(_value(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(_value(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    spans = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns) if row[f"lo{i}"] is not None}
    return {c: [lo + (hi - lo) * b / buckets for b in range(buckets)] + [hi] for c, (lo, hi) in spans.items()}


def _value(name: str) -> Column:
    as_double = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(as_double), as_double)


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Half-open bins, the last one closed; NULL outside. Repeated edges leave empty bins."""
    passed = sum(((value >= F.lit(e)).cast("int") for e in edges[1:]), F.lit(1))
    inside = (value >= edges[0]) & (value <= edges[-1])
    return F.when(inside, F.least(F.lit(len(edges) - 2), passed - F.lit(1)))


def _cells(df: DataFrame, side: str, numeric: Mapping[str, Sequence[float]], text: Sequence[str]) -> DataFrame:
    """One small row per feature value: feature, bin as text, side. Added up map-side right after."""
    cells = [
        F.struct(
            F.lit(c).alias("feature"), bin_of(_value(c), edges).cast("string").alias("bin"), _value(c).isNotNull().alias("known")
        )
        for c, edges in numeric.items()
    ] + [
        F.struct(
            F.lit(c).alias("feature"), F.col(f"`{c}`").alias("bin"), F.col(f"`{c}`").isNotNull().alias("known")
        )
        for c in text
    ]
    return df.select(F.inline(F.array(*cells))).where("known").select("feature", "bin", F.lit(side).alias("side"))


def psi_bins(
    reference: DataFrame,
    current: DataFrame,
    edges: Mapping[str, Sequence[float]],
    text: Sequence[str] = (),
) -> DataFrame:
    """Counts per feature and bin for both tables. Values outside the reference range have the bin NULL."""
    both = _cells(reference, "reference", edges, text).unionByName(_cells(current, "current", edges, text))
    return both.groupBy("feature", "bin").agg(
        F.count_if(F.col("side") == "reference").alias("expected"), F.count_if(F.col("side") == "current").alias("actual")
    )


def psi_from_bins(bins: DataFrame) -> DataFrame:
    """Population stability index per feature; an empty share counts as 1e-4, features empty on one side are left out."""
    totals = bins.groupBy("feature").agg(F.sum("expected").alias("n_expected"), F.sum("actual").alias("n_actual"))
    share = lambda part, whole: F.when(F.col(part) == 0, F.lit(EMPTY_SHARE)).otherwise(F.col(part) / F.col(whole))
    # both inputs are aggregates: one row per feature and bin, one row per feature
    joined = bins.join(totals, "feature").where((F.col("n_expected") > 0) & (F.col("n_actual") > 0))
    e, a = share("expected", "n_expected"), share("actual", "n_actual")
    term = F.when(F.col("bin").isNotNull(), (e - a) * F.ln(e / a)).otherwise(F.lit(0.0))
    return joined.groupBy("feature").agg(F.sum(term).alias("psi"))


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = MONITORED,
    method: str = "quantiles",
    buckets: int = BUCKETS,
    numeric_only: bool = False,
) -> DataFrame:
    """``(feature, psi, drift)`` for the monitored columns both tables have.

    Text columns are compared by the shares of their values; ``numeric_only`` reports 0 for them instead.
    """
    common = [f for f in features if f in reference.columns and f in current.columns]
    text = [f for f in common if isinstance(reference.schema[f].dataType, T.StringType)]
    numeric = [f for f in common if f not in text]
    find_edges = quantile_edges if method == "quantiles" else equal_width_edges
    edges = find_edges(reference, numeric, buckets) if numeric else {}
    # every feature starts at 0; a sum instead of a join adds what was found
    zeros = reference.sparkSession.createDataFrame([(f, 0.0) for f in common], "feature string, psi double")
    compared = () if numeric_only else text
    parts = zeros
    if edges or compared:
        parts = zeros.unionByName(psi_from_bins(psi_bins(reference, current, edges, compared)))
    summed = parts.groupBy("feature").agg(F.sum("psi").alias("psi"))
    return summed.withColumn("drift", F.col("psi") > PSI_DRIFT)


def is_severe(level: Column) -> Column:
    return level.isin(*SEVERE_LEVELS)


def prediction_drift(
    alerts: DataFrame, time_col: str = "at", recent: str = "1 day", max_change: float = MAX_RATE_CHANGE
) -> DataFrame:
    """Change of the severe-alert rate in the last day against all time before, scaled to [0, 1].

    The newest time is read first (one column, one value), so the cutoff is a literal in the counting pass.
    """
    newest = F.lit(alerts.agg(F.max(time_col)).first()[0]).cast("timestamp")
    cutoff = newest - F.expr(f"INTERVAL {recent}")
    is_recent, is_before = F.col(time_col) >= cutoff, F.col(time_col) < cutoff
    severe = is_severe(F.col("alert_level"))
    counts = alerts.agg(
        F.count_if(is_recent).alias("recent"),
        F.count_if(is_recent & severe).alias("recent_severe"),
        F.count_if(is_before).alias("before"),
        F.count_if(is_before & severe).alias("before_severe"),
    )
    change = F.abs(
        F.col("recent_severe") / F.nullif(F.col("recent"), F.lit(0))
        - F.col("before_severe") / F.nullif(F.col("before"), F.lit(0))
    )
    return counts.select(
        "recent",
        "before",
        # least() would skip the NULL of an empty side
        F.when(change.isNotNull(), F.least(change / F.lit(max_change), F.lit(1.0))).otherwise(F.lit(0.0)).alias(
            "prediction_score"
        ),
    )


def drift_report(psi_rows: DataFrame, prediction: DataFrame) -> DataFrame:
    """One-row summary with the status. Both inputs are already aggregates, folded without a join."""
    stacked = psi_rows.select("psi", F.lit(None).cast("double").alias("prediction_score")).unionByName(
        prediction.select(F.lit(None).cast("double").alias("psi"), "prediction_score")
    )
    folded = stacked.agg(
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("avg_psi"),
        F.coalesce(F.max("prediction_score"), F.lit(0.0)).alias("prediction_score"),
    )
    scored = folded.withColumn("feature_score", F.least(F.col("avg_psi") / PSI_FULL_SCORE, F.lit(1.0))).withColumn(
        "final_score", F.col("feature_score") * FEATURE_WEIGHT + F.col("prediction_score") * PREDICTION_WEIGHT
    )
    return scored.withColumn("status", status_of(F.col("final_score")))


def status_of(score: Column) -> Column:
    return (
        F.when(score > RETRAIN_SCORE, F.lit("RETRAIN_NEEDED")).when(score > WARNING_SCORE, F.lit("WARNING")).otherwise(F.lit("STABLE"))
    )


def sliding_severe_rate(alerts: DataFrame, time_col: str = "at", span_hours: int = 24) -> DataFrame:
    """Severe share over the last ``span_hours`` hours, for every full hour.

    Alerts are counted per hour once; only those hourly rows are copied into the windows that contain them.
    """
    hourly = (
        alerts.where(F.col(time_col).isNotNull())
        .groupBy(F.date_trunc("hour", F.col(time_col)).alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_severe(F.col("alert_level"))).alias("severe"))
    )
    return rate_of_hours(hourly, span_hours)


def rate_of_hours(hourly: DataFrame, span_hours: int = 24) -> DataFrame:
    """Severe share of every window of ``span_hours`` hours that has alerts, from rows ``(hour, n, severe)``."""
    first = F.col("hour") - F.expr(f"INTERVAL {span_hours - 1} HOURS")
    return (
        hourly.withColumn("window_start", F.explode(F.sequence(first, F.col("hour"), F.expr("INTERVAL 1 HOUR"))))
        .groupBy("window_start")
        .agg(F.sum("n").alias("alerts"), F.sum("severe").alias("severe"))
        .withColumn("severe_rate", F.col("severe") / F.col("alerts"))
    )
