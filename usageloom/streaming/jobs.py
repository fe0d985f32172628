"""The streaming queries over decoded messages, and starting and watching them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usageloom.functions import timeparts
from usageloom.operators.activity import user_sketches
from usageloom.operators.rollups import user_metrics
from usageloom.schemas import EVENTS_PER_MINUTE, FEATURE_EVENT
from usageloom.sources.messages import as_raw_events, decode_events
from usageloom.streaming.sinks import ChangelogSink, RawEventSink

WATERMARK = "1 minute"
WINDOW = "1 minute"
TRIGGER = {"processingTime": "10 seconds"}


def window_counts(
    decoded: DataFrame,
    metric_name: str = EVENTS_PER_MINUTE,
    watermark: str = WATERMARK,
    width: str = WINDOW,
) -> DataFrame:
    """Event count per window in the long metric format.

    Messages without a readable time fall out of the window, late ones count
    as long as the watermark has not passed their window.
    """
    return (
        decoded.withWatermark("timestamp", watermark)
        .groupBy(timeparts.tumbling("timestamp", width))
        .agg(F.count("*").cast("double").alias("metric_value"))
        .select(*timeparts.window_bounds(), F.lit(metric_name).alias("metric_name"), "metric_value")
    )


def feature_window_counts(
    decoded: DataFrame, watermark: str = WATERMARK, width: str = WINDOW
) -> DataFrame:
    return (
        decoded.withWatermark("timestamp", watermark)
        .filter((F.col("event_type") == F.lit(FEATURE_EVENT)) & F.col("feature_name").isNotNull())
        .groupBy(timeparts.tumbling("timestamp", width), "feature_name")
        .agg(F.count("*").alias("usage_count"))
        .select(*timeparts.window_bounds(), "feature_name", "usage_count")
    )


def window_users(
    decoded: DataFrame, watermark: str = WATERMARK, width: str = WINDOW
) -> DataFrame:
    """One row per window and user with its events so far; for update mode, open windows included.

    A grouped count is combined before the shuffle, so a user with most of a
    batch sends one row per task and window. Readers count the users of a window.
    """
    return (
        decoded.withWatermark("timestamp", watermark)
        .filter(F.col("user_id").isNotNull())
        .groupBy(timeparts.tumbling("timestamp", width), "user_id")
        .agg(F.count("*").alias("events"))
        .select(*timeparts.window_bounds(), "user_id", "events")
    )


def active_users_exact(
    decoded: DataFrame, watermark: str = WATERMARK, width: str = WINDOW
) -> DataFrame:
    """Distinct users per closed window, the newest ones withheld until the watermark passes; for append mode.

    The pairs of window and user are the state, spread by both, and are
    dropped when the watermark closes the window.
    """
    return (
        decoded.withWatermark("timestamp", watermark)
        .filter(F.col("user_id").isNotNull())
        .select(timeparts.tumbling("timestamp", width), "user_id")
        .dropDuplicates(["window", "user_id"])
        .groupBy("window")
        .agg(F.count("*").alias("active_users"))
        .select(*timeparts.window_bounds(), "active_users")
    )


def window_sketches(decoded: DataFrame, watermark: str = WATERMARK, width: str = WINDOW) -> DataFrame:
    """A mergeable sketch of each window's users, open windows included; for update mode, with constant state per window."""
    return user_sketches(decoded.withWatermark("timestamp", watermark), "timestamp", width)


def user_rollup(decoded: DataFrame) -> DataFrame:
    """``user_metrics`` kept up to date; its state is one row per user ever seen (use the RocksDB store)."""
    events = as_raw_events(decoded).filter(
        F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull()
    )
    return user_metrics(events)


def start(
    frame: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
    output_mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """One restartable query. The checkpoint holds its position and state, so it is not optional."""
    if not checkpoint:
        raise ValueError("a streaming query needs a checkpoint folder")
    writer = (
        frame.writeStream.outputMode(output_mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_ingest(
    messages: DataFrame,
    output: str,
    checkpoints: str,
    trigger: dict | None = None,
    epoch: int = 0,
    watermark: str = WATERMARK,
    width: str = WINDOW,
) -> list[StreamingQuery]:
    """The two standing queries over one stream of messages: windowed counts and raw events."""
    decoded = decode_events(messages)
    counts = start(
        window_counts(decoded, watermark=watermark, width=width),
        ChangelogSink(f"{output}/aggregated_metrics", epoch),
        f"{checkpoints}/aggregated_metrics",
        output_mode="update",
        trigger=trigger,
    )
    raw = start(
        decoded,
        RawEventSink(f"{output}/raw_events", epoch),
        f"{checkpoints}/raw_events",
        output_mode="append",
        trigger=trigger,
    )
    return [counts, raw]


def supervise(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Returns when all queries have ended by themselves; a failure of any one stops the others and is raised.

    Other queries of the session, failed ones too, are none of its business.
    """

    def raise_own() -> None:
        for query in queries:
            if not query.isActive and query.exception() is not None:
                raise query.exception()

    try:
        # forget what has ended, then look: what ends from here on is told by the wait
        spark.streams.resetTerminated()
        raise_own()
        while any(q.isActive for q in queries):
            try:
                spark.streams.awaitAnyTermination()
            except StreamingQueryException:
                raise_own()
            spark.streams.resetTerminated()
            raise_own()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def drain(queries: list[StreamingQuery]) -> None:
    """Lets standing queries finish what has arrived, on their own triggers, and stops them; a failure is raised."""
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()


def watermark_of(query: StreamingQuery) -> Column | None:
    """The event time up to which windows are closed, once the query has one."""
    progress = query.lastProgress
    stamp = progress and progress["eventTime"].get("watermark")
    return F.lit(stamp).cast("timestamp") if stamp else None


def run_once(
    frame: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
) -> None:
    """Processes everything that is there now and ends."""
    start(frame, sink, checkpoint, output_mode=output_mode, trigger={"availableNow": True}).awaitTermination()
