"""Physical plans of the batch queries."""

import pytest

from workload.queries import registry

BATCH = [
    "kpi_window_batch", "kpi_window_summary", "kpi_ci95", "kpi_compare", "tip_rate_by_borough", "borough_stats",
    "quality_flagged", "quality_dashboard", "anomaly_distribution", "quarantine_repair", "gold_with_outliers",
    "anomaly_rate_sliding", "anomaly_rate_rolling", "score_lookup", "score_validation", "latest_batch_dist", "point_lookup_trips",
    "drift_monitor", "drift_psi", "drift_alerts", "watermark_loss_whatif", "trip_features", "schema_diff",
]


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_rows(spark, small, name):
    text = plan(registry()[name](spark, small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups"):
        assert bad not in text


def test_lookups_are_broadcast_and_columns_pruned(spark, small):
    text = plan(registry()["quality_flagged"](spark, small))
    assert "SortMergeJoin" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line and "events.parquet" in line]
    assert scans and all("props" not in s and "event_type" not in s for s in scans)


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "CAST(id AS INT) AS PULocationID").write.parquet(f"{tmp_path}/t")
    text = plan(spark.read.parquet(f"{tmp_path}/t").where("PULocationID = 4"))
    assert "EqualTo(PULocationID,4)" in text


def test_newest_batch_is_read_alone(spark, small):
    df = registry()["latest_batch_dist"](spark, small)
    df.collect()
    plan_of = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan_of.toString():
        plan_of = plan_of.executedPlan()
    text = plan_of.toString()
    filters = [part.split("]")[0] for part in text.split("PartitionFilters: [")[1:]]
    assert any("sim_batch_id" in f and "subquery" in f.lower() for f in filters), filters


def test_one_training_serves_four_queries(spark, small, monkeypatch):
    from tidemark.operators import clustering as cl

    names = ["kmeans_lloyd", "kmeans_distribution", "kmeans_centroids", "kmeans_inertia"]
    registry()[names[0]](spark, small)
    monkeypatch.setattr(cl, "lloyd", None)
    assert all(registry()[n](spark, small).count() > 0 for n in names)
