"""A feed replayed in arrivals: the standing queries meet it batch by batch, late messages included.

Each arrival is put into a folder the stream watches; both queries then take all
that is new as one batch and end, so a restart lies between any two arrivals:
position, state and watermark come from the checkpoints. What the engine reports
about its batches (watermark, rows, updates dropped as too late) is kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usageloom.functions import timeparts
from usageloom.sources.messages import decode_events, read_event_stream
from usageloom.streaming import jobs

#: messages as a topic would give them
MESSAGE = "partition int, offset bigint, key binary, value binary"
BATCHES = "arrival int, watermark string, messages bigint, dropped_updates bigint"


@dataclass
class Replay:
    """Where the outputs are, and one row per arrival of what the counting query reported."""

    feed: DataFrame
    output: str
    batches: list[tuple[int, str, int, int]] = field(default_factory=list)

    def progress(self, spark: SparkSession) -> DataFrame:
        """arrival, watermark its batch was judged by (NULL for none yet), messages, dropped_updates."""
        rows = spark.createDataFrame(self.batches, BATCHES)
        stamp = F.col("watermark").cast("timestamp")
        return rows.withColumn("watermark", F.when(stamp > F.timestamp_seconds(F.lit(0)), stamp))


def by_arrival(messages: DataFrame, path: str) -> DataFrame:
    """The messages stored apart per ``arrival``, so that each is delivered without reading the others."""
    messages.write.partitionBy("arrival").parquet(path)
    return messages.sparkSession.read.schema(f"{MESSAGE}, arrival int").parquet(path)


def reported(query: StreamingQuery) -> tuple[str, int, int]:
    """Watermark of the batch that had data, its messages, and the updates all batches dropped as too late."""
    batches = query.recentProgress
    busy = next((b for b in batches if b["numInputRows"]), batches[0] if batches else None)
    dropped = sum(s["numRowsDroppedByWatermark"] for b in batches for s in b["stateOperators"])
    return ("", 0, 0) if busy is None else (busy["eventTime"].get("watermark", ""), busy["numInputRows"], dropped)


def replay(feed: DataFrame, arrivals: int, folder: str, watermark: str, width: str) -> Replay:
    """Runs the standing queries over ``feed`` (see :func:`by_arrival`), one arrival after the other."""
    spark = feed.sparkSession
    result = Replay(feed, f"{folder}/out")
    for arrival in range(arrivals):
        part = feed.filter(F.col("arrival") == arrival).drop("arrival")
        part.write.mode("append").parquet(f"{folder}/inbox")
        stream = read_event_stream(spark, "parquet", f"{folder}/inbox", MESSAGE)
        queries = jobs.start_ingest(
            stream, result.output, f"{folder}/checkpoints", trigger={"availableNow": True}, watermark=watermark, width=width
        )
        jobs.supervise(spark, queries)
        result.batches.append((arrival, *reported(queries[0])))
    return result


def lateness(replayed: Replay, counted: DataFrame, width: str) -> DataFrame:
    """Per window the messages in time, those behind the watermark that still counted, and those dropped.

    ``counted``: the windows as the stream wrote them. A message is late where its time lies before the
    watermark its batch was judged by; whether it counted, the windows tell.
    """
    spark = replayed.feed.sparkSession
    batches = replayed.progress(spark).select("arrival", "watermark")  # one row per arrival
    sent = decode_events(replayed.feed, carried=("arrival",)).filter(F.col("timestamp").isNotNull())
    judged = sent.join(F.broadcast(batches), "arrival")
    late = F.coalesce(F.col("timestamp") < F.col("watermark"), F.lit(False))
    per_window = (
        judged.groupBy(timeparts.tumbling("timestamp", width))
        .agg(F.count_if(~late).alias("on_time"), F.count_if(late).alias("late"))
        .select(*timeparts.window_bounds(), "on_time", "late")
    )
    kept = counted.select("window_start", F.col("metric_value").cast("bigint").alias("counted"))
    missing = F.col("on_time") + F.col("late") - F.coalesce("counted", F.lit(0))
    return (
        per_window.join(kept, "window_start", "left")
        .withColumn("dropped", missing)
        .withColumn("late_kept", F.col("late") - missing)
        .select("window_start", "window_end", "on_time", "late_kept", "dropped")
    )
