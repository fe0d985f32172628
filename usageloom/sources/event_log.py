"""The event log as a batch table."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom import schemas


def read_event_log(
    spark: SparkSession, path: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """Good events of a log written by the raw sink; the ``valid`` partition is pruned to ``true``.

    ``event_date`` stays in the frame so that time ranges drop whole partitions. With ``since`` or
    ``until`` (both included) only the folders of those dates are listed at all, which matters once the
    log has years of small batches.
    """
    reader = spark.read.schema(_log_schema()).option("basePath", path)
    if since is None and until is None:
        log = reader.parquet(path)
    else:
        folders = _dated_folders(spark, f"{path}/valid=true", since or date.min, until or date.max)
        log = reader.parquet(*folders) if folders else spark.createDataFrame([], _log_schema())
    return log.filter(F.col("valid")).select(*schemas.RAW_EVENTS.schema.names, "event_date")


def _dated_folders(spark: SparkSession, path: str, since: date, until: date) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = (f.getPath().getName() for f in files.listStatus(place))
    dated = sorted(n for n in found if re.fullmatch(r"event_date=\d{4}-\d{2}-\d{2}", n))
    return [f"{path}/{n}" for n in dated if since <= date.fromisoformat(n.partition("=")[2]) <= until]


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages the storage rules refused, with their reasons and the untouched text."""
    log = spark.read.schema(_log_schema()).parquet(path)
    return log.filter(~F.col("valid")).select(
        *schemas.RAW_EVENTS.schema.names, "reasons", "raw_value"
    )


def _log_schema():
    schema = "`reasons` array<string>, `raw_value` string, `valid` boolean, `event_date` date"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW_EVENTS.schema.fields
    )
    return f"{columns}, {schema}, `epoch` bigint, `batch_id` bigint"


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with ``partition_column`` and ``bounds`` it is read by many tasks at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Read-only names for SQL texts."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
