"""Recency of users, measured from the newest event in the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageloom.functions import timeparts
from usageloom.functions.latest import latest

# fixed values: (upper bound in minutes, label); the last label has no bound
SEGMENTS: tuple[tuple[float | None, str], ...] = (
    (30, "active (< 30 min)"),
    (120, "cooling (30-120 min)"),
    (None, "churned (> 120 min)"),
)


def last_seen(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.max("event_timestamp").alias("last_event_at"))


def _with_idle_minutes(users: DataFrame) -> DataFrame:
    # "now" is the newest of the per-user maxima: the subquery repeats the
    # per-user aggregation, whose shuffle is reused, so the log is read once.
    now = users.select(F.max("last_event_at")).scalar()
    return users.withColumn(
        "minutes_since_last_seen", timeparts.minutes_between(F.col("last_event_at"), now)
    )


def idle_users(events: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` users unseen for longest."""
    return (
        _with_idle_minutes(last_seen(events))
        .orderBy(F.desc("minutes_since_last_seen"), "user_id")
        .limit(top)
    )


def recency_segments(
    events: DataFrame, segments: Sequence[tuple[float | None, str]] = SEGMENTS
) -> DataFrame:
    """Users per recency bucket; buckets nobody is in are absent."""
    minutes = F.col("minutes_since_last_seen")
    bucket = F
    for bound, label in segments:
        bucket = bucket.otherwise(label) if bound is None else bucket.when(minutes < bound, label)
    return (
        _with_idle_minutes(last_seen(events))
        .groupBy(bucket.alias("recency_segment"))
        .agg(F.count("*").alias("user_count"))
        .orderBy(F.desc("user_count"), "recency_segment")
    )


def last_action(events: DataFrame, event_type: str = "logout") -> DataFrame:
    """Users whose newest event is ``event_type``."""
    return (
        events.groupBy("user_id")
        .agg(latest("event_type").alias("event_type"))
        .filter(F.col("event_type") == F.lit(event_type))
        .agg(F.count("*").alias(f"users_whose_last_action_was_{event_type}"))
    )
