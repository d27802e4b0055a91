"""Feature, evaluation, drift and explanation queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.catalog import views as v
from packetloom.catalog.common import Catalog
from packetloom.operators import drift, evaluation, explain, features
from packetloom.operators.sketches import WIDTH, hourly_sketches, segment_psi
from packetloom.schemas import MODEL_FEATURES
from packetloom.session import shared_path

query = Catalog()


# features


def _flow_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with holes: a NULL and an infinite rate for the checks of cleaning and imputing."""
    flows = v.flows(spark, sf_dir)
    hole = F.col("pkts_total") % 3 == 0
    return flows.withColumns(
        {
            "duration": F.when(~hole, F.col("duration")),
            "bytes_per_sec": F.when(hole, F.lit(float("inf"))).otherwise(F.col("bytes_per_sec")),
            "service": F.when(~hole, F.col("service")),
        }
    )


_NUMBERS_SQL = (
    v.FLOWS_SQL
    + """,
numbers AS (SELECT * REPLACE (CASE WHEN pkts_total % 3 = 0 THEN NULL ELSE duration END AS duration,
  CASE WHEN pkts_total % 3 = 0 THEN 'Infinity'::DOUBLE ELSE bytes_per_sec END AS bytes_per_sec,
  CASE WHEN pkts_total % 3 = 0 THEN NULL ELSE service END AS service) FROM flows)"""
)


@query(f"""WITH {_NUMBERS_SQL} SELECT flow_id, round(coalesce(duration, 0), 5) AS duration,
  CASE WHEN isinf(bytes_per_sec) THEN 0 ELSE round(bytes_per_sec, 5) END AS bytes_per_sec FROM numbers""")
def numeric_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = features.clean_numeric(_flow_numbers(spark, sf_dir), ["duration", "bytes_per_sec"])
    return cleaned.select(
        "flow_id", F.round("duration", 5).alias("duration"), F.round("bytes_per_sec", 5).alias("bytes_per_sec")
    )


_ROUNDED = ("duration", "pkts_per_sec", "bytes_per_sec")
_ALIGNED = ", ".join(f"round({f}, 5) AS {f}" if f in _ROUNDED else f for f in MODEL_FEATURES)


@query(f"WITH {v.FLOWS_SQL} SELECT flow_id, 0.0::DOUBLE AS unseen_feature, {_ALIGNED} FROM flows")
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourteen model features and one the flows lack."""
    aligned = features.align_columns(v.flows(spark, sf_dir), ["unseen_feature", *MODEL_FEATURES], keep=["flow_id"])
    return _rounded(aligned, *_ROUNDED, digits=5)


@query(f"""WITH {v.FLOWS_SQL} SELECT flow_id, length, round(duration, 5) AS duration, orig_pkts, resp_pkts, pkts_total, orig_bytes, resp_bytes, bytes_total,
  round(pkts_per_sec, 5) AS pkts_per_sec, round(bytes_per_sec, 5) AS bytes_per_sec, iat_mean, iat_std, syn_count, ack_count, rst_count FROM flows""")
def model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = features.drop_leakage(v.flows(spark, sf_dir))
    names = features.numeric_feature_names(flows)
    rounded = [F.round(c, 5).alias(c) if c in ("duration", "pkts_per_sec", "bytes_per_sec") else F.col(c) for c in names]
    return flows.select("flow_id", *rounded)


@query(f"""WITH {_NUMBERS_SQL}, med AS (SELECT quantile_cont(duration, 0.5) AS d, quantile_cont(CAST(bytes_total AS DOUBLE), 0.5) AS b FROM numbers),
filled AS (SELECT flow_id, coalesce(duration, d) AS duration, coalesce(CAST(bytes_total AS DOUBLE), b) AS bytes_total FROM numbers, med),
stats AS (SELECT avg(duration) AS md, stddev_pop(duration) AS sd, avg(bytes_total) AS mb, stddev_pop(bytes_total) AS sb FROM filled)
SELECT flow_id, round((duration - md) / sd, 6) AS duration, round((bytes_total - mb) / sb, 6) AS bytes_total FROM filled, stats""")
def impute_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = _flow_numbers(spark, sf_dir).select("flow_id", "duration", "bytes_total")
    scaler = features.NumericScaler(inputCols=["duration", "bytes_total"]).fit(numbers)
    return scaler.transform(numbers).select(
        "flow_id", F.round("duration", 6).alias("duration"), F.round("bytes_total", 6).alias("bytes_total")
    )


@query(f"""WITH {_NUMBERS_SQL} SELECT flow_id, """ + ", ".join(
    [f"CAST(coalesce(service, 'missing') = '{s}' AS INTEGER)::DOUBLE AS service_{s}" for s in ("dns", "http", "missing")]
    + [f"CAST(protocol = '{p}' AS INTEGER)::DOUBLE AS protocol_{p}" for p in ("ICMP", "OTHER", "TCP", "UDP")]
) + " FROM numbers")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _flow_numbers(spark, sf_dir).select("flow_id", "service", "protocol")
    return features.CategoryEncoder(inputCols=["service", "protocol"]).fit(rows).transform(rows)


@query(f"""WITH {_NUMBERS_SQL} SELECT flow_id, 'service_' || coalesce(service, 'missing') AS feature, 1.0::DOUBLE AS value FROM numbers
UNION ALL SELECT flow_id, 'protocol_' || protocol, 1.0::DOUBLE FROM numbers""")
def one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.sparse_categories(_flow_numbers(spark, sf_dir), "flow_id", ["service", "protocol"])


@query(f"""WITH {v.PACKETS_SQL} SELECT packet_id, CASE WHEN lower(kind) IN ('normal', 'benign') THEN 0 ELSE 1 END AS y
FROM (SELECT packet_id, CASE protocol WHEN 'OTHER' THEN 'DoS' WHEN 'ICMP' THEN 'Benign' ELSE 'NORMAL' END AS kind FROM packets) q""")
def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("protocol") == "OTHER", "DoS").when(F.col("protocol") == "ICMP", "Benign").otherwise("NORMAL")
    typed = v.packets(spark, sf_dir).drop("label").withColumn("attack_type", kind)
    return features.with_binary_label(typed).select("packet_id", "y")


@query(f"""WITH {v.PACKETS_SQL}, classes AS (SELECT protocol, row_number() OVER (ORDER BY protocol) - 1 AS y FROM (SELECT DISTINCT protocol FROM packets) q)
SELECT packet_id, CAST(y AS INTEGER) AS y FROM packets JOIN classes USING (protocol)""")
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_label_index(v.packets(spark, sf_dir), "protocol").select("packet_id", "y")


# evaluation


def judged_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored flows with a truth: traffic of the protocol OTHER comes from error events."""
    return v.scored_flows(spark, sf_dir).select(
        "flow_id",
        "protocol",
        (F.col("protocol") == "OTHER").cast("int").alias("y"),
        F.col("xgb_label").alias("prediction"),
        F.col("xgb_prob").alias("probability"),
        "anomaly_score",
    )


_JUDGED_SQL = (
    v.SCORED_SQL
    + """,
judged AS (SELECT flow_id, protocol, CAST(protocol = 'OTHER' AS INTEGER) AS y, xgb_label AS prediction, xgb_prob AS probability, anomaly_score FROM scored)"""
)

_COUNTS = """count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp"""


def _rates(digits: int = 9) -> str:
    def share(name: str, top: str, base: str) -> str:
        return f"CASE WHEN {base} = 0 THEN 0 ELSE round(({top}) / CAST({base} AS DOUBLE), {digits}) END AS {name}"

    return ", ".join(
        [
            share("accuracy", "tp + tn", "(tp + tn + fp + fn)"),
            share("precision", "tp", "(tp + fp)"),
            share("recall", "tp", "(tp + fn)"),
            share("f1", "2 * tp", "(2 * tp + fp + fn)"),
            share("far", "fp", "(fp + tn)"),
            share("dr", "tp", "(tp + fn)"),
        ]
    )


_RATE_NAMES = ("accuracy", "precision", "recall", "f1", "far", "dr")


def _rounded(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(f"WITH {_JUDGED_SQL}, c AS (SELECT {_COUNTS} FROM (SELECT y, prediction AS p FROM judged) q) SELECT tn, fp, fn, tp, {_rates()} FROM c")
def confusion_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.binary_metrics(judged_flows(spark, sf_dir)), *_RATE_NAMES)


@query(f"""WITH {_JUDGED_SQL}, c AS (SELECT {_COUNTS} FROM (SELECT y, CAST(anomaly_score < -0.12 AS INTEGER) AS p FROM judged) q) SELECT tn, fp, fn, tp, {_rates()} FROM c""")
def anomaly_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = evaluation.flag_below(judged_flows(spark, sf_dir), "anomaly_score", -0.12)
    return _rounded(evaluation.binary_metrics(flagged), *_RATE_NAMES)


def _class_scores(part: Column) -> Column:
    """Ten class scores from any number of values: every tenth value adds to one class."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(9)),
        lambda c: F.aggregate(F.filter(part, lambda _, i: i % 10 == c), F.lit(0.0), lambda total, x: total + x),
    )


def classified_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with their class and two sets of ten class scores, from the first and the second half of the values."""
    rows = v.table(spark, sf_dir, "embeddings").withColumn("values", F.col("embedding").cast("array<double>"))
    half = F.floor(F.size("values") / 2).cast("int")
    first, second = F.slice("values", F.lit(1), half), F.slice("values", half + 1, F.size("values"))
    scored = rows.select("vec_id", F.col("label").alias("y"), _class_scores(first).alias("first"), _class_scores(second).alias("second"))
    return scored.withColumn("prediction", (F.array_position("first", F.array_max("first")) - 1).cast("int"))


_VECTORS_SQL = """
halves AS (SELECT vec_id, label AS y, embedding[1 : len(embedding) // 2]::DOUBLE[] AS f, embedding[len(embedding) // 2 + 1 :]::DOUBLE[] AS g FROM embeddings),
sums AS (SELECT vec_id, y, list_transform(range(10), lambda c: list_sum(list_filter(f, lambda x, i: (i - 1) % 10 = c))) AS a,
  list_transform(range(10), lambda c: list_sum(list_filter(g, lambda x, i: (i - 1) % 10 = c))) AS b FROM halves),
vectors AS (SELECT *, CAST(list_position(a, list_max(a)) - 1 AS INTEGER) AS prediction FROM sums),
cells AS (SELECT y AS class, 1 AS t, 0 AS p, 0 AS hit FROM vectors UNION ALL SELECT prediction, 0, 1, CAST(y = prediction AS INTEGER) FROM vectors),
classes AS (SELECT class, sum(t) AS support, sum(p) AS predicted, sum(hit) AS hits FROM cells GROUP BY class),
rated AS (SELECT class, support, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted::DOUBLE END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE hits / support::DOUBLE END AS recall, 2.0 * hits / (support + predicted)::DOUBLE AS f1 FROM classes)"""


@query(f"""WITH {_VECTORS_SQL} SELECT round(sum(hits) / sum(support)::DOUBLE, 9) AS accuracy, round(avg(precision), 9) AS precision,
  round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1, 0.0::DOUBLE AS far, 0.0::DOUBLE AS dr FROM rated""")
def metrics_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.macro_metrics(classified_vectors(spark, sf_dir)), "accuracy", "precision", "recall", "f1")


@query(f"""WITH {_VECTORS_SQL}, report AS (SELECT class::VARCHAR AS class, precision, recall, f1, support FROM rated
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rated
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM rated)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM report""")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.class_report(classified_vectors(spark, sf_dir)), "precision", "recall", "f1")


@query(f"""WITH {_JUDGED_SQL}, ranked AS (SELECT y, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS r FROM judged)
SELECT round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))::DOUBLE, 9) AS auc FROM ranked""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.roc_auc(judged_flows(spark, sf_dir), "probability"), "auc")


@query(f"""WITH {_JUDGED_SQL}, c AS (SELECT y, count(*) AS n FROM judged GROUP BY y)
SELECT y, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)::DOUBLE, 9) AS weight,
  round((SELECT n FROM c WHERE y = 0) / (SELECT n FROM c WHERE y = 1)::DOUBLE, 9) AS neg_pos_ratio FROM c""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.class_balance(judged_flows(spark, sf_dir)), "weight", "neg_pos_ratio")


@query(f"""WITH {_JUDGED_SQL}, t AS (SELECT quantile_cont(anomaly_score, 0.01) AS threshold FROM judged WHERE y = 0)
SELECT flow_id, round(threshold, 9) AS threshold FROM judged, t WHERE anomaly_score < threshold""")
def percentile_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows below the 99 percent threshold learned on normal traffic."""
    judged = judged_flows(spark, sf_dir)
    threshold = evaluation.percentile_threshold(judged.where("y = 0"), "anomaly_score")
    flagged = evaluation.flag_below(judged, "anomaly_score", threshold).where("prediction = 1")
    return flagged.select("flow_id", F.round(F.lit(threshold), 9).alias("threshold"))


_GRID = ", ".join(repr(p / 100.0) for p in evaluation.sweep_percentiles())
_SWEEP_SQL = (
    _JUDGED_SQL
    + f""",
grid AS (SELECT quantile_cont(anomaly_score, [{_GRID}]) AS ts FROM judged),
steps AS (SELECT i - 1 AS step, ts[i] AS threshold FROM grid, (SELECT unnest(range(1, 201)) AS i) r),
counted AS (SELECT step, threshold, {_COUNTS} FROM (SELECT step, threshold, y, CAST(anomaly_score < threshold AS INTEGER) AS p FROM judged, steps) q GROUP BY step, threshold),
swept AS (SELECT CAST(step AS INTEGER) AS step, round(threshold, 9) AS threshold, tn, fp, fn, tp, {_rates()} FROM counted)"""
)


@query(f"WITH {_SWEEP_SQL} SELECT * FROM swept")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.threshold_sweep(judged_flows(spark, sf_dir), "anomaly_score"), "threshold", *_RATE_NAMES)


@query(f"WITH {_SWEEP_SQL} SELECT * FROM swept ORDER BY f1 DESC, step LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.best_threshold(judged_flows(spark, sf_dir), "anomaly_score"), "threshold", *_RATE_NAMES)


@query(f"""WITH {_JUDGED_SQL}, span AS (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM judged),
c AS (SELECT y, CAST(least(floor((anomaly_score - lo) / ((hi - lo) / 50.0)), 49) AS INTEGER) AS bin, any_value((hi - lo) / 50.0) AS w, count(*) AS count FROM judged, span GROUP BY 1, 2)
SELECT y, bin, count, round(count / (sum(count) OVER (PARTITION BY y) * w), 6) AS density FROM c""")
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.score_histogram(judged_flows(spark, sf_dir), "anomaly_score"), "density", digits=6)


@query(f"""WITH {_JUDGED_SQL} SELECT flow_id, round((probability + (0.5 - anomaly_score)) / 2.0, 9) AS probability_mean,
  CAST((probability + (0.5 - anomaly_score)) / 2.0 >= 0.5 AS INTEGER) AS prediction FROM judged""")
def soft_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = judged_flows(spark, sf_dir).withColumn("second", F.lit(0.5) - F.col("anomaly_score"))
    voted = evaluation.soft_vote(two, ["probability", "second"])
    return voted.select("flow_id", F.round("probability_mean", 9).alias("probability_mean"), "prediction")


_PAIRS = ", ".join(f"(a[{i}] + b[{i}]) / 2.0" for i in range(1, 11))


@query(f"""WITH {_VECTORS_SQL}, m AS (SELECT vec_id, [{_PAIRS}] AS means FROM vectors)
SELECT vec_id, CAST(list_position(means, list_max(means)) - 1 AS INTEGER) AS prediction FROM m""")
def soft_vote_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = evaluation.soft_vote_classes(classified_vectors(spark, sf_dir), ["first", "second"])
    return voted.select("vec_id", "prediction")


_GATE_SQL = (
    _JUDGED_SQL
    + f""",
new_c AS (SELECT {_COUNTS} FROM (SELECT y, CAST(probability >= 0.4 AS INTEGER) AS p FROM judged) q),
old_c AS (SELECT {_COUNTS} FROM (SELECT y, prediction AS p FROM judged) q),
new_m AS (SELECT {_rates(15)} FROM new_c), old_m AS (SELECT {_rates(15)} FROM old_c)"""
)


@query(f"""WITH {_GATE_SQL} SELECT round(n.f1 - o.f1, 9) AS f1_gain, round(n.far - o.far, 9) AS far_increase, n.f1 >= 0.9 AS canary_passed,
  n.f1 >= o.f1 AND n.far - o.far <= 0.005 AND n.f1 >= 0.9 AS promoted FROM new_m n, old_m o""")
def champion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_flows(spark, sf_dir)
    champion = evaluation.binary_metrics(judged)
    lower = judged.withColumn("prediction", (F.col("probability") >= 0.4).cast("int"))
    challenger = evaluation.binary_metrics(lower)
    gate = evaluation.promotion_gate(challenger, champion, canary=challenger)
    return _rounded(gate, "f1_gain", "far_increase")


@query(f"WITH {_GATE_SQL} SELECT round(f1, 9) AS f1, f1 >= 0.9 AS passed FROM old_m")
def canary_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = evaluation.canary_gate(evaluation.binary_metrics(judged_flows(spark, sf_dir)))
    return gate.select(F.round("f1", 9).alias("f1"), "passed")


@query(f"""WITH {_JUDGED_SQL} SELECT count(*) AS n, round(avg(CAST(prediction = 1 AS DOUBLE)), 9) AS recall, avg(CAST(prediction = 1 AS DOUBLE)) < 0.1 AS missed
FROM judged WHERE y = 1""")
def zero_day_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.zero_day_recall(judged_flows(spark, sf_dir).where("y = 1")), "recall")


@query(f"WITH {_JUDGED_SQL}, c AS (SELECT protocol, {_COUNTS} FROM (SELECT protocol, y, prediction AS p FROM judged) q GROUP BY protocol) SELECT protocol, tn, fp, fn, tp, {_rates()} FROM c")
def metrics_by_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.binary_metrics(judged_flows(spark, sf_dir), by=["protocol"]), *_RATE_NAMES)


# drift

SPLIT_AT = "2024-01-16"
MONITORED = ("length", "src_port", "id.resp_p", "protocol")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First and second half of the month; the second half is shifted so that there is something to find."""
    rows = v.packets(spark, sf_dir).withColumn("id.resp_p", F.col("dst_port"))
    late = F.col("ts") >= F.lit(SPLIT_AT).cast("timestamp")
    return rows.where(~late), rows.where(late).withColumn("length", F.col("length") + F.col("length") / 4)


_HALVES_SQL = (
    v.PACKETS_SQL
    + f""",
sides AS (SELECT ts >= TIMESTAMP '{SPLIT_AT}' AS late, CASE WHEN ts >= TIMESTAMP '{SPLIT_AT}' THEN length + length / 4.0 ELSE length END::DOUBLE AS length,
  src_port::DOUBLE AS src_port, dst_port::DOUBLE AS resp, protocol FROM packets)"""
)


def _psi_sql(quantiles: bool) -> str:
    parts, names = [], []
    for i, (label, column) in enumerate((("length", "length"), ("src_port", "src_port"), ("id.resp_p", "resp"))):
        grid = ", ".join(str(b / 10) for b in range(11))
        if quantiles:
            edges = f"quantile_cont({column}, [{grid}])"
        else:
            inner = ", ".join(f"min({column}) + (max({column}) - min({column})) * {b} / 10" for b in range(10))
            edges = f"[{inner}, max({column})]"
        passed = " + ".join(f"CAST(ed[{k}] <= {column} AS INTEGER)" for k in range(1, 12))
        parts.append(
            f"e{i} AS (SELECT {edges} AS ed FROM sides WHERE NOT late), "
            f"b{i} AS (SELECT late, CASE WHEN {column} < ed[1] OR {column} > ed[11] THEN NULL ELSE least(9, {passed} - 1) END::VARCHAR AS bin FROM sides, e{i})"
        )
        names.append((label, f"b{i}"))
    parts.append("b3 AS (SELECT late, protocol AS bin FROM sides)")
    names.append(("protocol", "b3"))
    cells = " UNION ALL ".join(f"SELECT '{label}' AS feature, late, bin FROM {view}" for label, view in names)
    return (
        _HALVES_SQL
        + ", "
        + ", ".join(parts)
        + f""", cells AS ({cells}),
counts AS (SELECT feature, bin, count(*) FILTER (WHERE NOT late) AS e, count(*) FILTER (WHERE late) AS a FROM cells GROUP BY 1, 2),
totals AS (SELECT feature, sum(e) AS te, sum(a) AS ta FROM counts GROUP BY 1),
shares AS (SELECT feature, CASE WHEN e = 0 THEN 0.0001 ELSE e / te::DOUBLE END AS e, CASE WHEN a = 0 THEN 0.0001 ELSE a / ta::DOUBLE END AS a
  FROM counts JOIN totals USING (feature) WHERE bin IS NOT NULL),
psi AS (SELECT feature, sum((e - a) * ln(e / a)) AS psi FROM shares GROUP BY 1)"""
    )


@query(f"WITH {_psi_sql(True)} SELECT feature, round(psi, 9) AS psi, psi > 0.2 AS drift FROM psi")
def psi_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(drift.psi(*_halves(spark, sf_dir), MONITORED), "psi")


@query(f"WITH {_psi_sql(False)} SELECT feature, round(psi, 9) AS psi, psi > 0.2 AS drift FROM psi")
def psi_equal_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(drift.psi(*_halves(spark, sf_dir), MONITORED, method="bins"), "psi")


_PREDICTION_SQL = """newest AS (SELECT max("at") AS t FROM alerts),
sev AS (SELECT "at" >= t - INTERVAL 1 day AS recent, alert_level IN ('HIGH', 'CRITICAL') AS severe FROM alerts, newest),
pred AS (SELECT count(*) FILTER (WHERE recent) AS recent, count(*) FILTER (WHERE NOT recent) AS before,
  least(abs(count(*) FILTER (WHERE recent AND severe) / count(*) FILTER (WHERE recent)::DOUBLE
    - count(*) FILTER (WHERE NOT recent AND severe) / count(*) FILTER (WHERE NOT recent)::DOUBLE) / 0.1, 1.0) AS prediction_score FROM sev)"""


@query(f"WITH {v.ALERTS_SQL}, {_PREDICTION_SQL} SELECT recent, before, round(prediction_score, 9) AS prediction_score FROM pred")
def prediction_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(drift.prediction_drift(v.alerts(spark, sf_dir)), "prediction_score")


@query(f"""WITH {v.ALERTS_SQL}, {_PREDICTION_SQL}, {_psi_sql(True).removeprefix(v.PACKETS_SQL + ",")},
folded AS (SELECT (SELECT avg(psi) FROM psi) AS avg_psi, prediction_score FROM pred),
scored_report AS (SELECT *, least(avg_psi / 0.4, 1.0) AS feature_score, least(avg_psi / 0.4, 1.0) * 0.6 + prediction_score * 0.4 AS final_score FROM folded)
SELECT round(avg_psi, 9) AS avg_psi, round(prediction_score, 9) AS prediction_score, round(feature_score, 9) AS feature_score, round(final_score, 9) AS final_score,
  CASE WHEN final_score > 0.8 THEN 'RETRAIN_NEEDED' WHEN final_score > 0.5 THEN 'WARNING' ELSE 'STABLE' END AS status FROM scored_report""")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drift.psi(*_halves(spark, sf_dir), MONITORED)
    report = drift.drift_report(rows, drift.prediction_drift(v.alerts(spark, sf_dir)))
    return _rounded(report, "avg_psi", "prediction_score", "feature_score", "final_score")


@query(f"""WITH {v.ALERTS_SQL}, hourly AS (SELECT date_trunc('hour', "at") AS h, count(*) AS n, count(*) FILTER (WHERE alert_level IN ('HIGH', 'CRITICAL')) AS s FROM alerts GROUP BY 1),
spread AS (SELECT h - to_hours(i) AS w, n, s FROM hourly, (SELECT unnest(range(0, 24)) AS i) r)
SELECT epoch_us(w) AS window_us, CAST(sum(n) AS BIGINT) AS alerts, CAST(sum(s) AS BIGINT) AS severe, round(sum(s) / sum(n)::DOUBLE, 9) AS severe_rate FROM spread GROUP BY w""")
def alert_rate_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = drift.sliding_severe_rate(v.alerts(spark, sf_dir))
    return rates.select(
        F.unix_micros("window_start").alias("window_us"), "alerts", "severe", F.round("severe_rate", 9).alias("severe_rate")
    )


# explanations


def _attributions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float]:
    rows = v.scorer_features(v.flows(spark, sf_dir))
    means = explain.feature_means(rows, list(v.SCORER_WEIGHTS))
    return (
        explain.linear_attribution(rows, "flow_id", v.SCORER_WEIGHTS, means),
        explain.linear_base(v.SCORER_WEIGHTS, means, v.SCORER_INTERCEPT),
    )


def _attribution_sql() -> str:
    means = ", ".join(f"avg({f}) AS m_{f}" for f in v.SCORER_WEIGHTS)
    cells = " UNION ALL ".join(
        f"SELECT flow_id, '{f}' AS feature, {f}::DOUBLE AS value, {w} * ({f} - m_{f}) AS attribution FROM scored, means"
        for f, w in v.SCORER_WEIGHTS.items()
    )
    base = " + ".join(f"{w} * m_{f}" for f, w in v.SCORER_WEIGHTS.items())
    return (
        f"{v.SCORED_SQL}, means AS (SELECT {means} FROM scored), attributions AS ({cells}), "
        f"base AS (SELECT {v.SCORER_INTERCEPT} + {base} AS b FROM means), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY flow_id ORDER BY round(abs(attribution), 12) DESC, feature) AS rank FROM attributions)"
    )


@query(f"WITH {_attribution_sql()} SELECT flow_id, feature, round(value, 7) AS value, round(attribution, 7) AS attribution FROM attributions")
def linear_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested, _ = _attributions(spark, sf_dir)
    return _rounded(explain.unnest(nested, "flow_id"), "value", "attribution", digits=7)


@query(f"WITH {_attribution_sql()} SELECT feature, round(avg(abs(attribution)), 7) AS mean_abs_shap FROM attributions GROUP BY feature")
def global_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested, _ = _attributions(spark, sf_dir)
    return _rounded(explain.global_importance(explain.unnest(nested, "flow_id")), "mean_abs_shap", digits=7)


@query(f"WITH {_attribution_sql()} SELECT flow_id, CAST(rank AS INTEGER) AS rank, feature, round(attribution, 7) AS attribution FROM ranked WHERE rank <= 3")
def local_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested, _ = _attributions(spark, sf_dir)
    top = explain.top_features(nested, "flow_id", 3)
    return top.select("flow_id", "rank", "feature", F.round("attribution", 7).alias("attribution"))


@query(f"""WITH {_attribution_sql()} SELECT flow_id, printf('Base risk was %.2f. ', any_value(b)) ||
  string_agg(feature || ' (' || CASE WHEN attribution > 0 THEN 'Risk Increase' ELSE 'Risk Decrease' END || ')', ' ' ORDER BY rank) AS explanation_text
FROM ranked, base GROUP BY flow_id""")
def explanation_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested, base = _attributions(spark, sf_dir)
    return explain.local_explanations(nested, "flow_id", base).select("flow_id", "explanation_text")


@query(f"""WITH {_attribution_sql()} SELECT flow_id, feature, round(value, 7) AS value, round(attribution, 7) AS shap_value,
  CASE WHEN attribution > 0 THEN 'Positive' ELSE 'Negative' END AS impact FROM ranked WHERE rank <= 10""")
def explanation_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents, taken apart again as the alert drill-down does."""
    from packetloom.operators.analytics import explanation_rows

    nested, _ = _attributions(spark, sf_dir)
    documents = explain.explanation_documents(nested, "flow_id")
    return _rounded(explanation_rows(documents, "flow_id", "top_features"), "value", "shap_value", digits=7)


_SKETCHED = ("length", "ttl", "src_port")
_DRIFT_CUT = "2024-01-16 00:00:00"


@query(f"""WITH {v.PACKETS_SQL},
cells AS (SELECT protocol AS segment, ts >= TIMESTAMP '{_DRIFT_CUT}' AS late, unnest(['length', 'ttl', 'src_port']) AS feature,
  unnest([length::DOUBLE, ttl::DOUBLE, src_port::DOUBLE]) AS x FROM packets),
counts AS (SELECT segment, feature, CASE WHEN abs(x) < 1e-9 THEN 0 ELSE sign(x) * (floor(ln(abs(x)) / {math.log1p(WIDTH)!r}) + 100000) END AS bucket,
  count(*) FILTER (WHERE NOT late) AS r, count(*) FILTER (WHERE late) AS c FROM cells GROUP BY 1, 2, 3),
ranked AS (SELECT *, sum(r) OVER w AS n_reference, sum(c) OVER w AS n_current,
    coalesce(sum(r) OVER (PARTITION BY segment, feature ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed
  FROM counts WINDOW w AS (PARTITION BY segment, feature)),
binned AS (SELECT segment, feature, n_reference, n_current,
    len(list_filter(range(1, 10), lambda i: passed >= ceil(round(i / 10.0::DOUBLE * n_reference, 6)))) AS bin, sum(r) AS r, sum(c) AS c
  FROM ranked WHERE n_reference > 0 AND n_current > 0 GROUP BY ALL),
shares AS (SELECT *, CASE WHEN r > 0 THEN r / n_reference::DOUBLE ELSE 0.0001 END AS e, CASE WHEN c > 0 THEN c / n_current::DOUBLE ELSE 0.0001 END AS a FROM binned)
SELECT segment, feature, n_reference::BIGINT AS n_reference, n_current::BIGINT AS n_current, round(sum((e - a) * ln(e / a)), 7) AS psi
FROM shares GROUP BY ALL""")
def psi_by_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of every protocol from stored hourly sketches."""
    path = shared_path(spark, "sketches")
    hourly_sketches(v.packets(spark, sf_dir), _SKETCHED, "protocol").write.parquet(path)
    stored = spark.read.parquet(path)
    late = F.col("hour") >= F.lit(_DRIFT_CUT).cast("timestamp")
    found = segment_psi(stored.where(~late), stored.where(late))
    return found.select("segment", "feature", "n_reference", "n_current", F.round("psi", 7).alias("psi"))
