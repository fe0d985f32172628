"""Newest row per key.

``max_by`` aggregates on the map side, so a key that holds a third of the log
still sends one row per task; a ranking window would ship and sort every event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EVENT_ORDER = ("event_timestamp", "id")


def latest(*columns: str, order: Sequence[str] = EVENT_ORDER) -> Column:
    """Aggregate giving ``columns`` of the newest row: the value for one column, a struct for several."""
    newest = F.struct(*[F.col(c).alias(c) for c in order])
    if len(columns) == 1:
        return F.max_by(F.col(columns[0]), newest)
    return F.max_by(F.struct(*[F.col(c).alias(c) for c in columns]), newest)


def latest_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """One whole row per key, the newest by ``order``."""
    others = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(c).alias(c) for c in others]),
                      F.struct(*[F.col(c).alias(c) for c in order])).alias("newest"))
        .select(*keys, "newest.*")
        .select(*rows.columns)
    )


def latest_rows_ranked(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """The same by ranking; for inputs that are already partitioned and sorted by the key."""
    ranking = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")
    )
