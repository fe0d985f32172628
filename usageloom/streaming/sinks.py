"""``foreachBatch`` sinks that can be retried: the same batch written twice leaves one copy.

Files carry the batch they came from as partition columns and a batch replaces
exactly its own partitions. Batch ids restart at 0 when a query starts from a
new checkpoint, so they are ordered within an ``epoch``: raise it by one
whenever a checkpoint is abandoned. An epoch belongs to the query that first
wrote to it, known by the identity in its checkpoint; any other is refused
before it can replace a batch. Rows go from executors to storage; the driver
sees counts only.

Batches lie in segments of ``SEGMENT`` batch ids. Readers list the names of
segments and of the batches in those not folded yet, and hand Spark the folders
of live batches alone, so what was folded into a snapshot is neither listed nor opened.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageloom import schemas
from usageloom.functions import timeparts
from usageloom.operators.quality import storage_violations
from usageloom.sources.messages import as_raw_events

log = logging.getLogger(__name__)

EPOCH_SHIFT = 40  # batch ids stay below 2^40
SEGMENT = 1000
QUERY_ID = "sql.streaming.queryId"  # set by Spark on the thread that runs a batch


class ForeignWriter(RuntimeError):
    """The epoch is written by another query."""


def version() -> Column:
    """One orderable number per (epoch, batch_id)."""
    return F.shiftleft(F.col("epoch").cast("bigint"), EPOCH_SHIFT) + F.col("batch_id")


def _replace_batch(
    rows: DataFrame, path: str, epoch: int, batch_id: int, partition_by: Sequence[str] = ()
) -> None:
    (
        rows.withColumn("epoch", F.lit(epoch).cast("bigint"))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*[c for c in partition_by if c != "segment"], "epoch", *[c for c in partition_by if c == "segment"], "batch_id")
        .parquet(path)
    )


def _seen(counts: Observation, name: str) -> int:
    """A counter of the write just done; a batch known to be empty is optimised away, counters included."""
    try:
        return counts.get[name]
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getName() != "java.util.NoSuchElementException":
            raise
        return 0


def _storage(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def claim(spark: SparkSession, path: str, epoch: int, writer: str) -> None:
    """Makes ``writer`` the one that may write to the epoch, unless another is.

    The file that names the writer is created only if there is none, which the storage decides for one
    of two that try at the same time. A file without a name is of a writer that died while claiming.
    """
    files, make = _storage(spark, path)
    place = make(f"{path}/_writers/epoch={epoch}")
    try:
        out = files.create(place, False)
        out.write(bytearray(writer.encode()))
        out.close()
        return
    except Py4JJavaError as problem:
        if "FileAlreadyExists" not in problem.java_exception.getClass().getName():
            raise
    found = files.open(place)
    owner = bytes(found.readAllBytes()).decode()
    found.close()
    if owner != writer:
        raise ForeignWriter(
            f"epoch {epoch} of {path} is written by {owner or 'an unfinished claim'}, not by {writer}: raise the epoch"
        )


@dataclass(kw_only=True)
class _Fenced:
    """Claims its epoch before the first batch."""

    _claimed: str | None = field(default=None, repr=False, compare=False)

    def _claim(self, batch: DataFrame) -> None:
        spark = batch.sparkSession
        writer = spark.sparkContext.getLocalProperty(QUERY_ID) or "direct calls"
        if self._claimed != writer:
            claim(spark, self.path, self.epoch, writer)
            self._claimed = writer


@dataclass
class RawEventSink(_Fenced):
    """Appends decoded messages to the event log, good and refused ones apart.

    Layout: ``valid`` / ``event_date`` / ``epoch`` / ``batch_id``. A live batch
    spans few dates and is written as it comes. For backfills over many dates
    set ``files_per_date``: each date is then spread over that many tasks, so
    neither small files nor one hot date become the bottleneck.
    """

    path: str
    epoch: int = 0
    files_per_date: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._claim(batch)
        rows = as_raw_events(batch)
        rows = (
            rows.withColumn("reasons", storage_violations(rows.columns))
            .withColumn("valid", F.size("reasons") == 0)
            .withColumn("event_date", timeparts.day(F.col("event_timestamp")))
        )
        counts = Observation()
        rows = rows.observe(
            counts, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("valid")).alias("refused")
        )
        # the untouched text is kept only where it is the sole evidence
        rows = rows.withColumn("raw_value", F.when(~F.col("valid"), F.col("raw_value")))
        if self.files_per_date:
            slot = F.pmod(F.xxhash64("id"), F.lit(self.files_per_date))
            rows = rows.repartition("event_date", slot)
        _replace_batch(rows, self.path, self.epoch, batch_id, ("valid", "event_date"))
        log.info(
            "batch %d: %d raw event(s), %d refused",
            batch_id, _seen(counts, "rows"), _seen(counts, "refused"),
        )


@dataclass
class ChangelogSink(_Fenced):
    """Keeps every emitted version of keyed rows; the newest version of a key counts.

    Update mode emits the full value of a key each time it changes, so
    versions replace one another and are never added up. Each task of the
    stateful stage writes what it emitted, and none where that is nothing.
    """

    path: str
    epoch: int = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._claim(batch)
        counts = Observation()
        rows = batch.withColumn("written_at", F.current_timestamp()).observe(
            counts, F.count(F.lit(1)).alias("rows")
        )
        rows = rows.withColumn("segment", F.lit(batch_id // SEGMENT).cast("bigint"))
        _replace_batch(rows, f"{self.path}/changelog", self.epoch, batch_id, ("segment",))
        log.info("batch %d: upserted %d row(s)", batch_id, _seen(counts, "rows"))


def _table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def snapshot_version(spark: SparkSession, path: str) -> int | None:
    done = _table(spark, f"{path}/snapshot_log", "upto bigint")
    return None if done is None else done.agg(F.max("upto")).first()[0]


def _numbered(files, place, column: str) -> list[int]:
    """The values of partition ``column`` right below a folder, by name alone."""
    if not files.exists(place):
        return []
    names = (f.getPath().getName() for f in files.listStatus(place))
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{column}="))


def live_batches(
    spark: SparkSession, path: str, after: int | None = None, upto: int | None = None
) -> dict[int, str]:
    """Version to folder of the batches after one version, up to another. Segments outside are not looked into."""
    files, make = _storage(spark, path)
    log_path = f"{path}/changelog"
    low = -1 if after is None else after
    found = {}
    for epoch in _numbered(files, make(log_path), "epoch"):
        first = epoch << EPOCH_SHIFT
        for segment in _numbered(files, make(f"{log_path}/epoch={epoch}"), "segment"):
            if first + (segment + 1) * SEGMENT - 1 <= low or (upto is not None and first + segment * SEGMENT > upto):
                continue
            folder = f"{log_path}/epoch={epoch}/segment={segment}"
            for batch_id in _numbered(files, make(folder), "batch_id"):
                if low < first + batch_id and (upto is None or first + batch_id <= upto):
                    found[first + batch_id] = f"{folder}/batch_id={batch_id}"
    return found


def versions(
    spark: SparkSession, path: str, row_schema: T.StructType, upto: int | None = None
) -> DataFrame:
    """All live versions: the newest snapshot, then the batches after it."""
    columns = [f.name for f in row_schema.fields]
    schema = f"{_ddl(row_schema)}, `written_at` timestamp, `epoch` bigint, `segment` bigint, `batch_id` bigint"
    base = snapshot_version(spark, path)
    folders = list(live_batches(spark, path, base, upto).values())
    changes = (
        spark.read.schema(schema).option("basePath", f"{path}/changelog").parquet(*folders)
        if folders
        else spark.createDataFrame([], schema)
    )
    rows = changes.select(
        *columns,
        version().alias("version"),
        F.col("written_at").alias("created_at"),
        F.col("written_at").alias("updated_at"),
    )
    if base is None:
        return rows
    snapshot = _table(
        spark,
        f"{path}/snapshots/upto={base}",
        f"{_ddl(row_schema)}, `version` bigint, `created_at` timestamp, `updated_at` timestamp",
    )
    return rows.unionByName(snapshot)


def latest_versions(
    spark: SparkSession,
    path: str,
    row_schema: T.StructType,
    keys: Sequence[str],
    upto: int | None = None,
) -> DataFrame:
    """The current row of every key with first and last write time and its version."""
    values = [f.name for f in row_schema.fields if f.name not in keys]
    newest = (
        F.max_by(values[0], "version").alias("_newest")
        if len(values) == 1  # a number stays in the hash aggregate
        else F.max_by(F.struct(*[F.col(v).alias(v) for v in values]), "version").alias("_newest")
    )
    chosen = (
        versions(spark, path, row_schema, upto)
        .groupBy(*keys)
        .agg(
            newest,
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
            F.max("version").alias("version"),
        )
    )
    value_columns = (
        [F.col("_newest").alias(values[0])]
        if len(values) == 1
        else [F.col(f"_newest.{v}").alias(v) for v in values]
    )
    return chosen.select(*keys, *value_columns, "created_at", "updated_at", "version")


def compact(
    spark: SparkSession,
    path: str,
    row_schema: T.StructType,
    keys: Sequence[str],
    upto: int | None = None,
) -> int | None:
    """Folds all versions up to ``upto`` into one snapshot that readers use from then on.

    By default the last batch is left out, since a restarted query may write it
    again. Nothing is deleted: folded batches can be expired by the storage
    once no reader started before the snapshot.
    """
    if upto is None:
        base = snapshot_version(spark, path)
        newest = sorted(live_batches(spark, path, base))
        if len(newest) < 2:
            return None
        upto = newest[-2]
    current = latest_versions(spark, path, row_schema, keys, upto)
    (
        current.withColumn("upto", F.lit(upto).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("upto")
        .parquet(f"{path}/snapshots")
    )
    # readers look here, so a snapshot counts only once it is complete
    spark.range(1).select(F.lit(upto).cast("bigint").alias("upto")).write.mode("append").parquet(
        f"{path}/snapshot_log"
    )
    return upto


METRIC_ROW = T.StructType([f for f in schemas.AGGREGATED_METRICS.schema.fields if f.name != "created_at"])
FEATURE_USAGE_ROW = T.StructType([f for f in schemas.FEATURE_USAGE.schema.fields if f.name != "created_at"])
USER_METRICS_ROW = T.StructType([f for f in schemas.USER_METRICS.schema.fields if f.name != "updated_at"])
ACTIVE_USERS_ROW = T.StructType(
    [
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("window_end", T.TimestampType(), False),
        T.StructField("active_users", T.LongType(), False),
    ]
)


def metrics_latest(spark: SparkSession, path: str) -> DataFrame:
    """``aggregated_metrics`` as a reader sees it, with the time of the last write besides the first."""
    return latest_versions(spark, path, METRIC_ROW, schemas.AGGREGATED_METRICS.key).drop("version")


def feature_usage_latest(spark: SparkSession, path: str) -> DataFrame:
    return latest_versions(spark, path, FEATURE_USAGE_ROW, schemas.FEATURE_USAGE.key).drop("version")


def user_metrics_latest(spark: SparkSession, path: str) -> DataFrame:
    return latest_versions(spark, path, USER_METRICS_ROW, schemas.USER_METRICS.key).drop(
        "version", "created_at"
    )


WINDOW_USERS_ROW = T.StructType([
    *ACTIVE_USERS_ROW.fields[:2], T.StructField("user_id", T.StringType(), False), T.StructField("events", T.LongType(), False),
])


def window_users_counted(spark: SparkSession, path: str) -> DataFrame:
    """Users per window from the written (window, user) rows."""
    keys = ("window_start", "window_end", "user_id")
    rows = latest_versions(spark, path, WINDOW_USERS_ROW, keys)
    return rows.groupBy("window_start", "window_end").agg(F.count("*").alias("active_users"))


def active_users_latest(spark: SparkSession, path: str) -> DataFrame:
    return latest_versions(spark, path, ACTIVE_USERS_ROW, ("window_start", "window_end")).drop("version")


SKETCH_ROW = T.StructType([*ACTIVE_USERS_ROW.fields[:2], T.StructField("sketch", T.BinaryType(), False)])


def window_sketches_latest(spark: SparkSession, path: str) -> DataFrame:
    return latest_versions(spark, path, SKETCH_ROW, ("window_start", "window_end")).drop("version")
