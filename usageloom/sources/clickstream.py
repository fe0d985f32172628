"""Shapes the generic ``events`` table (event_id, ts, user_id, event_type, value, props) as ``raw_events``.

The mapping is deterministic and column-wise, so it prunes and fuses into any
query over it. Its DuckDB twin is in ``plans.twins``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom.schemas import COUNTRIES, FEATURE_NAMES


def _pick(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(n) for n in names]), (F.pmod(index, F.lit(len(names))) + 1).cast("int")
    )


def to_raw_events(clicks: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    digest = F.md5(F.col("event_id").cast("string"))
    kind, value = F.col("event_type"), F.col("value")
    prepared = clicks.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws(
            "-",
            F.substring(digest, 1, 8),
            F.substring(digest, 9, 4),
            F.substring(digest, 13, 4),
            F.substring(digest, 17, 4),
            F.substring(digest, 21, 12),
        ).alias("session_id"),
        F.col("ts").alias("event_timestamp"),
        F.when(kind == "click", "feature_used")
        .when(kind == "view", "login")
        .when(kind == "error", "logout")
        .when(kind == "signup", F.when(k < 10, "signup").otherwise("login"))
        .when(
            kind == "purchase",
            F.when(value >= 190, "upgrade").when(value >= 150, "purchase").otherwise("feature_used"),
        )
        .alias("event_type"),
        F.when(k < 60, "free")
        .when(k < 80, "basic")
        .when(k < 95, "pro")
        .otherwise("enterprise")
        .alias("plan_tier"),
    )
    return prepared.select(
        "id",
        "user_id",
        "session_id",
        "event_timestamp",
        "event_type",
        "plan_tier",
        F.when(F.col("event_type") == "feature_used", _pick(FEATURE_NAMES, F.col("id"))).alias(
            "feature_name"
        ),
        _pick(COUNTRIES, F.col("id")).alias("country"),
        F.col("event_timestamp").alias("ingested_at"),
    )


def read_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw_events(read_clicks(spark, sf_dir))
