"""How far users get, overall and by plan tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageloom.functions import numeric
from usageloom.functions.latest import latest
from usageloom.schemas import CONVERSION_EVENTS, FEATURE_EVENTS, SIGNUP_EVENTS

# (output column, event types that reach the stage)
STAGES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("stage_1_signups", SIGNUP_EVENTS),
    ("stage_2_used_feature", FEATURE_EVENTS),
    ("stage_3_converted", CONVERSION_EVENTS),
)
# (output column, reached stage, stage it is measured against)
STEPS: tuple[tuple[str, str, str], ...] = (
    ("pct_signup_to_feature_use", "stage_2_used_feature", "stage_1_signups"),
    ("pct_feature_use_to_conversion", "stage_3_converted", "stage_2_used_feature"),
)


def _seen(types: Sequence[str]) -> Column:
    return F.max(F.when(F.col("event_type").isin(*types), 1).otherwise(0))


def conversion_funnel(
    events: DataFrame,
    stages: Sequence[tuple[str, Sequence[str]]] = STAGES,
    steps: Sequence[tuple[str, str, str]] = STEPS,
) -> DataFrame:
    """Distinct users per stage and the percentages between stages.

    Stages are independent sets of users, so a step can exceed 100 percent.
    Each user is flagged per stage in one pass; the flags are then summed.
    """
    wanted = [t for _, types in stages for t in types]
    flags = (
        events.filter(F.col("event_type").isin(*wanted))
        .groupBy("user_id")
        .agg(*[_seen(types).alias(name) for name, types in stages])
    )
    totals = flags.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name, _ in stages]
    )
    return totals.select(
        *[name for name, _ in stages],
        *[numeric.percent(F.col(reached), F.col(of)).alias(name) for name, reached, of in steps],
    )


def conversion_by_tier(
    events: DataFrame, conversions: Sequence[str] = CONVERSION_EVENTS
) -> DataFrame:
    """Share of users with a conversion, by the plan tier of each user's newest event.

    Tier and conversion flag come from the same per-user aggregation, so there
    is one scan, one shuffle of users and no join.
    """
    users = events.groupBy("user_id").agg(
        latest("plan_tier").alias("plan_tier"), _seen(conversions).alias("converted")
    )
    return (
        users.groupBy("plan_tier")
        .agg(
            F.count("*").alias("total_users"),
            F.sum("converted").cast("bigint").alias("converted_users"),
        )
        .select(
            "plan_tier",
            "total_users",
            "converted_users",
            numeric.percent(F.col("converted_users"), F.col("total_users")).alias(
                "conversion_rate_pct"
            ),
        )
        .orderBy(F.desc("conversion_rate_pct"), "plan_tier")
    )
