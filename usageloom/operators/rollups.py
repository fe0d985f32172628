"""Rollup tables and the figures shown on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageloom.functions import timeparts
from usageloom.functions.latest import latest
from usageloom.schemas import EVENTS_PER_MINUTE


def user_metrics(events: DataFrame) -> DataFrame:
    """One row per user: newest tier and country, event count, first and last seen."""
    return (
        events.groupBy("user_id")
        .agg(
            latest("plan_tier", "country").alias("newest"),
            F.count("*").alias("total_events"),
            F.min("event_timestamp").alias("first_seen"),
            F.max("event_timestamp").alias("last_seen"),
        )
        .select(
            "user_id",
            F.col("newest.plan_tier").alias("plan_tier"),
            F.col("newest.country").alias("country"),
            "total_events",
            "first_seen",
            "last_seen",
        )
    )


def aggregated_metrics(
    events: DataFrame, *more: Column, metric_name: str = EVENTS_PER_MINUTE, width: str = "1 minute"
) -> DataFrame:
    """Event count per window in the long metric format, with ``more`` aggregates behind it.

    ``created_at`` is when the window's first event arrived, ``updated_at``
    when its last did, as a live upsert of the same events would leave them.
    """
    return (
        events.groupBy(timeparts.tumbling("event_timestamp", width))
        .agg(
            F.count("*").cast("double").alias("metric_value"),
            F.min("ingested_at").alias("created_at"),
            F.max("ingested_at").alias("updated_at"),
            *more,
        )
        .select(
            *timeparts.window_bounds(),
            F.lit(metric_name).alias("metric_name"),
            "*",
        )
        .drop("window")
    )


def metric_series(metrics: DataFrame, metric_name: str = EVENTS_PER_MINUTE) -> DataFrame:
    """The windows of one metric in time order."""
    return (
        metrics.filter(F.col("metric_name") == F.lit(metric_name))
        .select("window_start", "window_end", "metric_name", "metric_value")
        .orderBy("window_start")
    )


def kpi_overview(
    metrics: DataFrame, metric_name: str = EVENTS_PER_MINUTE, watermark: Column | None = None
) -> DataFrame:
    """Total over all windows, value of the latest window, mean per window.

    The latest window may still be filling. With the stream's ``watermark``
    the result says so in ``is_complete``.
    """
    chosen = metrics.filter(F.col("metric_name") == F.lit(metric_name))
    figures = chosen.agg(
        F.coalesce(F.sum("metric_value"), F.lit(0.0)).cast("bigint").alias("total_events"),
        F.max_by("metric_value", "window_start").cast("bigint").alias("latest_window_events"),
        F.avg("metric_value").alias("avg_events_per_minute"),
        F.max("window_end").alias("latest_window_end"),
    )
    if watermark is not None:
        figures = figures.withColumn("is_complete", F.col("latest_window_end") <= watermark)
    return figures.drop("latest_window_end")


def heartbeat(
    metrics: DataFrame, as_of: Column | None = None, column: str = "created_at"
) -> DataFrame:
    """Seconds since the newest metric row.

    ``created_at`` moves only when a new window appears; ``updated_at`` moves
    with every write. ``as_of`` may be a column of ``metrics``: its newest value counts.
    """
    now = F.current_timestamp() if as_of is None else as_of
    return metrics.agg(F.max(column).alias("newest"), F.max(now).alias("now")).select(
        timeparts.seconds_between(F.col("newest"), F.col("now")).alias("seconds_since_update")
    )


def stalled(
    metrics: DataFrame,
    as_of: Column | None = None,
    threshold_seconds: float = 120,
    column: str = "created_at",
) -> DataFrame:
    """Whether the heartbeat exceeds the threshold; a table without rows counts as stalled."""
    return heartbeat(metrics, as_of, column).select(
        F.coalesce(F.col("seconds_since_update") > F.lit(threshold_seconds), F.lit(True)).alias(
            "is_stalled"
        )
    )
