"""The single statement of every table, value list and constraint of the engine.

Everything else (decoding, validation, sinks, DDL text) reads from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values (must equal the event contract) -------------------------
EVENT_TYPES = ("signup", "login", "feature_used", "upgrade", "purchase", "logout")
EVENT_TYPE_WEIGHTS = (2, 25, 50, 5, 8, 10)
PLAN_TIERS = ("free", "basic", "pro", "enterprise")
PLAN_TIER_WEIGHTS = (60, 20, 15, 5)
FEATURE_NAMES = (
    "dashboard_view",
    "export_report",
    "create_project",
    "invite_teammate",
    "api_integration",
    "advanced_filters",
    "custom_branding",
    "bulk_import",
)
COUNTRIES = ("US", "GB", "IN", "DE", "CA", "AU", "BR", "FR", "JP", "MX")
SIGNUP_EVENTS = ("signup",)
FEATURE_EVENT = "feature_used"
FEATURE_EVENTS = ("feature_used",)
CONVERSION_EVENTS = ("purchase", "upgrade")
EVENTS_PER_MINUTE = "events_per_minute"
# --- end of fixed values --------------------------------------------------

# What a message carries. Every field is nullable: a malformed message decodes
# to NULLs and is sorted out by the storage rules, not by a failing job.
EVENT_MESSAGE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("plan_tier", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)
MESSAGE_FIELDS = tuple(EVENT_MESSAGE.fieldNames())


@dataclass(frozen=True)
class Table:
    """Column types plus the rules a database would enforce on them."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    max_length: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)  # SQL expressions

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


RAW_EVENTS = Table(
    "raw_events",
    T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("user_id", T.StringType(), False),
            T.StructField("session_id", T.StringType(), False),
            T.StructField("event_timestamp", T.TimestampType(), False),
            T.StructField("event_type", T.StringType(), False),
            T.StructField("plan_tier", T.StringType(), False),
            T.StructField("feature_name", T.StringType(), True),
            T.StructField("country", T.StringType(), True),
            T.StructField("ingested_at", T.TimestampType(), False),
        ]
    ),
    key=("id",),
    max_length={
        "user_id": 36,
        "session_id": 36,
        "event_type": 50,
        "plan_tier": 20,
        "feature_name": 100,
        "country": 10,
    },
    defaults={"ingested_at": "current_timestamp()"},
)

USER_METRICS = Table(
    "user_metrics",
    T.StructType(
        [
            T.StructField("user_id", T.StringType(), False),
            T.StructField("plan_tier", T.StringType(), False),
            T.StructField("country", T.StringType(), True),
            T.StructField("total_events", T.LongType(), False),
            T.StructField("first_seen", T.TimestampType(), False),
            T.StructField("last_seen", T.TimestampType(), False),
            T.StructField("updated_at", T.TimestampType(), False),
        ]
    ),
    key=("user_id",),
    max_length={"plan_tier": 20, "country": 10},
    defaults={"total_events": "0", "updated_at": "current_timestamp()"},
)

AGGREGATED_METRICS = Table(
    "aggregated_metrics",
    T.StructType(
        [
            T.StructField("window_start", T.TimestampType(), False),
            T.StructField("window_end", T.TimestampType(), False),
            T.StructField("metric_name", T.StringType(), False),
            T.StructField("metric_value", T.DoubleType(), False),
            T.StructField("created_at", T.TimestampType(), False),
        ]
    ),
    key=("window_start", "window_end", "metric_name"),
    max_length={"metric_name": 100},
    defaults={"created_at": "current_timestamp()"},
)

FEATURE_USAGE = Table(
    "feature_usage",
    T.StructType(
        [
            T.StructField("window_start", T.TimestampType(), False),
            T.StructField("window_end", T.TimestampType(), False),
            T.StructField("feature_name", T.StringType(), False),
            T.StructField("usage_count", T.LongType(), False),
            T.StructField("created_at", T.TimestampType(), False),
        ]
    ),
    key=("window_start", "window_end", "feature_name"),
    max_length={"feature_name": 100},
    defaults={"created_at": "current_timestamp()"},
)

TABLES = {t.name: t for t in (RAW_EVENTS, USER_METRICS, AGGREGATED_METRICS, FEATURE_USAGE)}


def create_table_sql(table: Table, location: str, partitioned_by: tuple[str, ...] = (), database: str | None = None) -> str:
    """``CREATE TABLE`` text for an external parquet table in a Spark catalog, with the columns' defaults."""
    columns = ",\n  ".join(
        f"{f.name} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        + (f" DEFAULT {table.defaults[f.name]}" if f.name in table.defaults else "")
        for f in table.schema.fields
    )
    partitions = f"\nPARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {f'{database}.' if database else ''}{table.name} (\n  {columns}\n)"
        f" USING parquet{partitions}\nLOCATION '{location}'"
    )
