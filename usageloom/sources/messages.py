"""Events as keyed JSON messages, and back.

A message is ``key`` (the user, so one user stays in one topic partition) and
``value`` (JSON with all seven fields, NULLs written out, UTC offset and
microseconds kept).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageloom import schemas
from usageloom.functions.session import require_utc

JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
    "timeZone": "UTC",
    "ignoreNullFields": "false",
}
# Where a message sat in its topic; kept when the source provides it.
POSITION = ("partition", "offset")


def kafka_source_options(
    brokers: str, topic: str, starting_offsets: str = "latest", **more: str
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **more,
    }


def kafka_sink_options(brokers: str, topic: str, **more: str) -> dict[str, str]:
    """Strongest delivery the broker offers, with retries."""
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
        **more,
    }


def read_event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: T.StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """An unbounded frame of messages: Kafka, or a folder that receives files."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def encode_events(events: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``raw_events`` rows as ``key`` and ``value`` bytes, behind the ``carried`` columns."""
    require_utc(events.sparkSession)
    payload = F.struct(
        F.col("user_id").alias("user_id"),
        F.col("session_id").alias("session_id"),
        F.col("event_timestamp").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("event_type"),
        F.col("plan_tier").alias("plan_tier"),
        F.col("feature_name").alias("feature_name"),
        F.col("country").alias("country"),
    )
    return events.select(
        *carried,
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(payload, JSON_OPTIONS).cast("binary").alias("value"),
    )


def publish(events: DataFrame, brokers: str, topic: str, **more: str) -> None:
    """Writes a batch of events to a topic, each user's events to one partition."""
    encode_events(events).write.format("kafka").options(
        **kafka_sink_options(brokers, topic, **more)
    ).save()


def decode_events(messages: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The seven fields, plus the untouched text, the topic position if there is one, and ``carried`` columns.

    Unreadable text becomes NULL fields, a wrong field only that field.
    """
    require_utc(messages.sparkSession)
    text = F.col("value").cast("string")
    carried = [*(c for c in POSITION if c in messages.columns), *carried]
    return messages.select(
        *carried,
        text.alias("raw_value"),
        F.from_json(text, schemas.EVENT_MESSAGE, {"timeZone": "UTC"}).alias("data"),
    ).select(*carried, "raw_value", "data.*")


def has_position(columns: list[str]) -> bool:
    return all(c in columns for c in POSITION)


def event_id(columns: list[str]) -> Column:
    """A key that stays the same when a batch is retried.

    The topic position is unique. Other sources have none, so there the key is
    a 64-bit hash of the fields; two events can then share one, and identical
    redeliveries always do. Sinks that keep one row per key refuse those sources.
    """
    if has_position(columns):
        return F.shiftleft(F.col("partition").cast("bigint"), 48) + F.col("offset").cast("bigint")
    return F.xxhash64(*[F.col(c) for c in schemas.MESSAGE_FIELDS])


def as_raw_events(decoded: DataFrame) -> DataFrame:
    """Decoded messages in the columns of ``raw_events``, with ``raw_value`` behind them."""
    return decoded.select(
        event_id(decoded.columns).alias("id"),
        "user_id",
        "session_id",
        F.col("timestamp").alias("event_timestamp"),
        "event_type",
        "plan_tier",
        "feature_name",
        "country",
        F.current_timestamp().alias("ingested_at"),
        *[c for c in ("raw_value",) if c in decoded.columns],
    )
