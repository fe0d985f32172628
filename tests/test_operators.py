"""Small hand-made logs, empty input and skew."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from usageloom.operators import activity, adoption, features, funnel, quality, retention, rollups
from usageloom.plans.suite import KPI_SUITE, run_suite, suite_row_counts
from usageloom.sources.clickstream import raw_events

LOG = [
    (1, "a", "2024-01-01 00:00:10", "signup", "free", None, "US"),
    (2, "a", "2024-01-01 00:00:50", "feature_used", "free", "bulk_import", "US"),
    (3, "a", "2024-02-01 00:01:00", "purchase", "pro", None, "DE"),
    (4, "b", "2024-02-01 00:40:00", "feature_used", "free", "bulk_import", "FR"),
    (5, "b", "2024-02-01 00:50:00", "logout", "basic", None, "FR"),
    (6, "c", "2024-02-01 03:00:00", "feature_used", "free", "export_report", None),
]


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_activity(events):
    log = events(LOG)
    assert [r[1] for r in rows(activity.daily_active_users(log))] == [1, 3]
    assert [r[1] for r in rows(activity.monthly_active_users(log))] == [1, 3]
    assert rows(activity.stickiness(log)) == [(3, 3, 1.0)]


def test_adoption(events):
    log = events(LOG)
    assert rows(adoption.feature_usage_share(log)) == [("bulk_import", 2, 66.67), ("export_report", 1, 33.33)]
    assert rows(adoption.feature_adoption(log)) == [("bulk_import", 2, 2, 1.0), ("export_report", 1, 1, 1.0)]


def test_funnel_and_tiers(events):
    log = events(LOG)
    assert rows(funnel.conversion_funnel(log)) == [(1, 3, 1, 300.0, 33.33)]
    assert rows(funnel.conversion_by_tier(log)) == [
        ("pro", 1, 1, 100.0), ("basic", 1, 0, 0.0), ("free", 1, 0, 0.0),
    ]


def test_funnel_stages_are_parameters(events):
    result = funnel.conversion_funnel(
        events(LOG), stages=(("in", ("signup",)), ("out", ("logout",))), steps=(("pct", "out", "in"),)
    )
    assert result.columns == ["in", "out", "pct"]
    assert rows(result) == [(1, 1, 100.0)]


def test_retention(events):
    log = events(LOG)
    idle = rows(retention.idle_users(log, top=2))
    assert [(r[0], r[2]) for r in idle] == [("a", 179.0), ("b", 130.0)]
    assert dict(rows(retention.recency_segments(log))) == {"churned (> 120 min)": 2, "active (< 30 min)": 1}
    assert dict(rows(retention.recency_segments(log, ((150, "near"), (None, "far"))))) == {"near": 2, "far": 1}
    assert rows(retention.last_action(log)) == [(1,)]


def test_newest_event_is_searched_in_one_scan(events, spark, tmp_path):
    events(LOG).write.parquet(str(tmp_path / "log"))
    result = retention.recency_segments(spark.read.parquet(str(tmp_path / "log")))
    result.collect()
    assert "ReusedExchange" in result._jdf.queryExecution().executedPlan().toString()


def test_features_and_label(events):
    got = {r["user_id"]: r for r in features.user_features(events(LOG)).collect()}
    a = got["a"]
    assert (a["total_events"], a["distinct_features"], a["plan_tier"], a["country"], a["upgraded"]) == (
        3, 1, "pro", "DE", 1,
    )
    assert got["c"]["country"] is None
    free = {r["user_id"]: r["total_events"] for r in features.user_features(events(LOG), leak_free=True).collect()}
    assert free == {"a": 2, "b": 2, "c": 1}


def test_rollups_and_health(events):
    log = events(LOG)
    metrics = rollups.aggregated_metrics(log)
    total, last, mean = rows(rollups.kpi_overview(metrics))[0]
    assert (total, last, mean) == (6, 1, 6 / 5)
    closed = rollups.kpi_overview(metrics, watermark=F.lit("2024-02-01 03:00:30").cast("timestamp_ntz"))
    assert closed.first()["is_complete"] is False
    at = F.lit("2024-02-01 03:01:30").cast("timestamp")
    assert rows(rollups.heartbeat(metrics, at)) == [(90.0,)]
    assert rows(rollups.stalled(metrics, at)) == [(False,)]
    assert rows(rollups.stalled(metrics, at, threshold_seconds=60)) == [(True,)]
    # the first minute got a second event: only updated_at moves
    assert rows(rollups.heartbeat(metrics.filter("window_start < '2024-01-02'"),
                                  F.lit("2024-01-01 00:01:00").cast("timestamp"))) == [(50.0,)]
    assert rows(rollups.heartbeat(metrics.filter("window_start < '2024-01-02'"),
                                  F.lit("2024-01-01 00:01:00").cast("timestamp"), "updated_at")) == [(10.0,)]


def test_empty_log(events):
    log = events(LOG).filter("false")
    assert rows(activity.stickiness(log)) == [(0, 0, None)]
    assert rows(funnel.conversion_funnel(log)) == [(0, 0, 0, None, None)]
    assert rows(rollups.kpi_overview(rollups.aggregated_metrics(log))) == [(0, None, None)]
    assert rows(retention.last_action(log)) == [(0,)]
    assert rows(rollups.stalled(rollups.aggregated_metrics(log))) == [(True,)]
    assert rows(rollups.heartbeat(rollups.aggregated_metrics(log))) == [(None,)]
    assert rows(features.stratified_split(features.user_features(log))) == []
    for name, statement, _ in KPI_SUITE:
        statement(log).collect()


def test_suite_runs_in_order_and_writes(events, spark, tmp_path):
    results = run_suite(events(LOG), str(tmp_path))
    assert list(results) == [name for name, _, _ in KPI_SUITE] and len(results) == 12
    assert rows(spark.read.parquet(str(tmp_path / "stickiness"))) == [(3, 3, 1.0)]
    assert all(r["result_rows"] > 0 for r in suite_row_counts(events(LOG)).collect())


def test_suite_reductions_change_no_result(spark):
    log = raw_events(spark, SMALL)
    results = run_suite(log)
    for name, statement, _ in KPI_SUITE:
        assert rows(results[name]) == rows(statement(log)), name


def test_one_user_with_a_third_of_all_rows(spark):
    """A hot user changes no result and no task gets more than one row of them per input task."""
    log = spark.range(0, 60000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 1000)).alias("user_id"),
        F.lit("s").alias("session_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("event_timestamp"),
        F.when(F.col("id") % 2 == 0, "feature_used").otherwise("login").alias("event_type"),
        F.lit("free").alias("plan_tier"),
        F.when(F.col("id") % 2 == 0, "bulk_import").alias("feature_name"),
        F.lit("US").alias("country"),
    )
    users = {r["user_id"]: r for r in rollups.user_metrics(log).collect()}
    assert users["hot"]["total_events"] == 20000
    assert sum(r["total_events"] for r in users.values()) == 60000
    counted = features.user_features(log).filter("user_id = 'hot'").first()
    assert counted["feature_used_count"] == 10000 and counted["distinct_features"] == 1


@pytest.mark.parametrize("column,mix", [("event_type", quality.EVENT_TYPE_MIX)])
def test_distribution_lists_missing_and_unexpected(events, column, mix):
    log = events(LOG + [(7, "d", "2024-02-01 00:00:00", "refund", "free", None, "US")])
    got = {r["category"]: r for r in quality.category_distribution(log, {column: mix}).collect()}
    assert got["upgrade"]["n"] == 0 and got["upgrade"]["expected_pct"] == 5.0
    assert got["refund"]["n"] == 1 and got["refund"]["expected_pct"] == 0.0
    assert sum(r["n"] for r in got.values()) == 7
