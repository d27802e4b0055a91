"""Plan shapes that keep the jobs scalable."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from packetloom.catalog import views
from packetloom.operators import analytics
from packetloom.sources import writers

BATCH = [n for n in contract.queries() if not n.startswith(("stream", "ml_", "sampled_shapley", "pcap"))]
#: Rows are scored by a vectorised function.
FOREST = {"isolation_forest", "anomaly_training", "anomaly_retraining", "tree_shapley_values"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python_rows(name, spark, tiny):
    plan = plan_of(contract.queries()[name](spark, tiny))
    python = ("BatchEvalPython",) if name in FOREST else ("BatchEvalPython", "ArrowEvalPython")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", *python):
        assert operator not in plan


def test_scans_read_only_needed_columns(spark, tiny):
    plan = plan_of(analytics.top_sources(views.alerts(spark, tiny)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "event_id" not in schema and "value" not in schema


def test_unused_reason_text_is_not_computed(spark, tiny):
    assert "Statistical Anomaly" not in plan_of(analytics.frequency(views.alerts(spark, tiny), "alert_level"))


def test_date_filter_prunes_alert_folders(spark, tiny, tmp_path):
    path = str(tmp_path / "alerts")
    writers.append_alerts(views.alerts(spark, tiny), path)
    stored = spark.read.parquet(path)
    plan = plan_of(analytics.explore(stored.where(F.col("dt") == "2024-01-05"), levels=["HIGH"]))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#", plan)
    assert re.search(r"PushedFilters: \[[^\]]*alert_level", plan)


def test_time_filter_reaches_the_scan(spark, tiny, tmp_path):
    path = str(tmp_path / "alerts")
    views.alerts(spark, tiny).write.parquet(path)
    plan = plan_of(analytics.filter_dates_levels(spark.read.parquet(path), "2024-01-05", "2024-01-06", ["HIGH"]))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(at", plan)


def test_flow_rollup_has_one_shuffle_with_partial_sums(spark, tiny):
    plan = plan_of(views.flows(spark, tiny))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
