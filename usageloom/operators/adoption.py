"""How much, how widely and by whom each feature is used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageloom.functions import numeric, timeparts
from usageloom.schemas import FEATURE_EVENT


def feature_events(events: DataFrame) -> DataFrame:
    return events.filter(
        (F.col("event_type") == F.lit(FEATURE_EVENT)) & F.col("feature_name").isNotNull()
    )


def feature_usage_share(events: DataFrame) -> DataFrame:
    """Uses per feature and their share of all uses.

    The total is a scalar subquery over the per-feature counts, whose shuffle
    is reused: one scan, and no window that gathers all features in one task.
    """
    counts = feature_events(events).groupBy("feature_name").agg(F.count("*").alias("usage_count"))
    total = counts.select(F.sum("usage_count")).scalar()
    return counts.select(
        "feature_name",
        "usage_count",
        numeric.percent(F.col("usage_count"), total).alias("pct_of_all_feature_events"),
    ).orderBy(F.desc("usage_count"), "feature_name")


def feature_usage_by_tier(events: DataFrame) -> DataFrame:
    """Uses per feature and the plan tier carried by the event itself."""
    return (
        feature_events(events)
        .groupBy("plan_tier", "feature_name")
        .agg(F.count("*").alias("usage_count"))
        .orderBy("plan_tier", F.desc("usage_count"), "feature_name")
    )


def feature_adoption(events: DataFrame) -> DataFrame:
    """Distinct users, uses and uses per user of each feature."""
    return (
        feature_events(events)
        .groupBy("feature_name")
        .agg(F.count_distinct("user_id").alias("unique_users"), F.count("*").alias("total_uses"))
        .select(
            "feature_name",
            "unique_users",
            "total_uses",
            numeric.ratio(F.col("total_uses"), F.col("unique_users")).alias("avg_uses_per_user"),
        )
        .orderBy(F.desc("unique_users"), "feature_name")
    )


def feature_usage_windows(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """Uses per feature and time window."""
    return (
        feature_events(events)
        .groupBy(timeparts.tumbling("event_timestamp", width), "feature_name")
        .agg(F.count("*").alias("usage_count"))
        .select(*timeparts.window_bounds(), "feature_name", "usage_count")
    )
