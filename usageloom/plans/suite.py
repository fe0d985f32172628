"""The twelve KPI statements as one ordered suite over few scans of the log."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageloom.functions import timeparts
from usageloom.functions.latest import latest_rows
from usageloom.functions.lineage import written
from usageloom.operators import activity, adoption, funnel, retention

# (name, statement, which reduction of the log it is true for)
KPI_SUITE: tuple[tuple[str, Callable[[DataFrame], DataFrame], str], ...] = (
    ("dau", activity.daily_active_users, "user_days"),
    ("wau", activity.weekly_active_users, "user_days"),
    ("mau", activity.monthly_active_users, "user_days"),
    ("stickiness", activity.stickiness, "user_days"),
    ("feature_usage_share", adoption.feature_usage_share, "log"),
    ("feature_usage_by_tier", adoption.feature_usage_by_tier, "log"),
    ("feature_adoption", adoption.feature_adoption, "log"),
    ("conversion_funnel", funnel.conversion_funnel, "newest_by_type"),
    ("conversion_by_tier", funnel.conversion_by_tier, "newest_by_type"),
    ("idle_users_top20", retention.idle_users, "newest_by_type"),
    ("recency_segments", retention.recency_segments, "newest_by_type"),
    ("last_action_logout", retention.last_action, "newest_by_type"),
)


def user_days(events: DataFrame) -> DataFrame:
    """One row per user and day: all that active-user figures depend on."""
    day = timeparts.event_day(events)
    return events.select(
        "user_id",
        day.alias("event_date"),
        day.cast(events.schema["event_timestamp"].dataType).alias("event_timestamp"),
    ).distinct()


def newest_by_type(events: DataFrame) -> DataFrame:
    """The newest event of each user and type: it tells which types a user had, their newest event, and when."""
    needed = events.select("user_id", "event_type", "plan_tier", "event_timestamp", "id")
    return latest_rows(needed, ["user_id", "event_type"])


def run_suite(events: DataFrame, output: str | None = None) -> dict[str, DataFrame]:
    """All KPI results by name, in order; with ``output`` each is also written below that folder.

    The statements run unchanged on reductions of the log that leave their
    results as they are. Both reductions are written once, so nine statements
    cost two scans of the log.
    """
    inputs = {
        "log": events,
        "user_days": written(user_days(events), "user-days"),
        "newest_by_type": written(newest_by_type(events), "newest-by-type"),
    }
    results = {name: statement(inputs[source]) for name, statement, source in KPI_SUITE}
    if output:
        for name, result in results.items():
            result.write.mode("overwrite").parquet(f"{output}/{name}")
    return results


def suite_row_counts(events: DataFrame) -> DataFrame:
    """Rows each statement returns; 0 means a statement found nothing."""
    counts = [
        result.agg(F.count("*").alias("result_rows")).select(
            F.lit(position).alias("position"), F.lit(name).alias("statement"), "result_rows"
        )
        for position, (name, result) in enumerate(run_suite(events).items(), start=1)
    ]
    return reduce(DataFrame.unionByName, counts)
