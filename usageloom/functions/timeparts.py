"""Calendar buckets, elapsed time and tumbling windows.

Days, weeks and months are those of the session time zone, which the engine
expects to be UTC. Weeks start on Monday.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    return F.to_date(ts)


def event_day(events: DataFrame) -> Column:
    """Day of the event: the partition column where the log has one, which costs no reading."""
    return F.col("event_date") if "event_date" in events.columns else day(F.col("event_timestamp"))


def week_start(ts: Column) -> Column:
    return F.date_trunc("week", ts).cast("date")


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("date")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; accepts both timestamp types."""
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(earlier: Column, later: Column) -> Column:
    return (micros(later) - micros(earlier)).cast("double") / F.lit(60000000.0)


def seconds_between(earlier: Column, later: Column) -> Column:
    return (micros(later) - micros(earlier)).cast("double") / F.lit(1000000.0)


def tumbling(ts: str, width: str = "1 minute") -> Column:
    return F.window(F.col(ts), width).alias("window")


def window_bounds() -> list[Column]:
    """The ``window`` struct as two plain columns."""
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def within(events: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Events with ``start <= event_timestamp < end``.

    Literal bounds reach the parquet scan. Bounds that are only known at run
    time (scalar subqueries) do so through ``event_date``: a log partitioned by
    it drops whole days before reading.
    """
    ts = F.col("event_timestamp")
    kept = events.filter(ts >= start)
    if end is not None:
        kept = kept.filter(ts < end)
    if "event_date" in events.columns:
        kept = kept.filter(F.col("event_date") >= start.cast("date"))
        if end is not None:
            kept = kept.filter(F.col("event_date") <= end.cast("date"))
    return kept
