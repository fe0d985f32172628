"""Active users per day, week, month and minute, and stickiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageloom.functions import numeric, timeparts


def _active(events: DataFrame, bucket: Column, bucket_name: str, count_name: str) -> DataFrame:
    # One distinct aggregate: Spark first reduces to (bucket, user) pairs and
    # spreads those by both columns, so neither a busy day nor a busy user is hot.
    return (
        events.groupBy(bucket.alias(bucket_name))
        .agg(F.count_distinct("user_id").alias(count_name))
        .orderBy(bucket_name)
    )


def daily_active_users(events: DataFrame) -> DataFrame:
    return _active(events, timeparts.event_day(events), "activity_date", "dau")


def weekly_active_users(events: DataFrame) -> DataFrame:
    return _active(events, timeparts.week_start(F.col("event_timestamp")), "week_start", "wau")


def monthly_active_users(events: DataFrame) -> DataFrame:
    return _active(events, timeparts.month_start(F.col("event_timestamp")), "month_start", "mau")


def stickiness(events: DataFrame) -> DataFrame:
    """Users of the last day with data over users of that day's month.

    The last day is a scalar subquery, so the month becomes a plain time range
    that prunes files. The month is read once: a user is flagged when seen on
    the last day, then flags and users are counted.
    """
    last_day = events.select(F.max(timeparts.event_day(events))).scalar()
    in_month = timeparts.within(
        events,
        F.date_trunc("month", last_day).cast("date"),
        F.add_months(F.date_trunc("month", last_day), 1),
    )
    per_user = in_month.groupBy("user_id").agg(
        F.max(F.when(F.col("event_timestamp") >= last_day, 1).otherwise(0)).alias("on_last_day")
    )
    return per_user.agg(
        F.coalesce(F.sum("on_last_day"), F.lit(0)).cast("bigint").alias("dau_count"),
        F.count("user_id").alias("mau_count"),
    ).select(
        "dau_count",
        "mau_count",
        numeric.ratio(F.col("dau_count"), F.col("mau_count"), 3).alias("dau_mau_ratio"),
    )


def active_users_per_window(events: DataFrame, width: str = "1 minute") -> DataFrame:
    return (
        events.groupBy(timeparts.tumbling("event_timestamp", width))
        .agg(F.count_distinct("user_id").alias("active_users"))
        .select(*timeparts.window_bounds(), "active_users")
    )


#: accuracy of the sketches: 2 ** 12 registers, a standard error of 1.6 percent
SKETCH_BITS = 12
#: an estimate is within this share of the exact figure, three standard errors
SKETCH_BOUND = 0.05


def user_sketches(events: DataFrame, time: str = "event_timestamp", width: str = "1 minute") -> DataFrame:
    """Per window a sketch of its users, of bounded size, that can be merged with those of other windows."""
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy(timeparts.tumbling(time, width))
        .agg(F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("sketch"))
        .select(*timeparts.window_bounds(), "sketch")
    )


def active_users_estimated(sketches: DataFrame, grain: str) -> DataFrame:
    """Estimated users per day, week or month from the sketches of shorter windows; the log is not read again."""
    return (
        sketches.groupBy(F.date_trunc(grain, "window_start").cast("date").alias("period_start"))
        .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    )
