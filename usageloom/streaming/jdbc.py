"""The same two sinks for a database: executors fill a staging table, one statement moves it over.

The statement runs on the driver but no row passes through it. A retried batch
refills the staging table and repeats the statement, which changes nothing the
second time: events are inserted where their id is new, metrics are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom import schemas
from usageloom.operators.quality import storage_violations
from usageloom.sources.messages import as_raw_events, has_position


def insert_missing_sql(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    names = ", ".join(columns)
    return (
        f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging} s"
        f" WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {match})"
    )


def merge_sql(
    table: str, staging: str, keys: Sequence[str], values: Sequence[str], touched: str | None = None
) -> str:
    """``touched``: a column of the target that takes the time of the write."""
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    updates = ", ".join([f"{v} = s.{v}" for v in values] + ([f"{touched} = CURRENT_TIMESTAMP"] if touched else []))
    names = [*keys, *values, *([touched] if touched else [])]
    given = [f"s.{n}" for n in (*keys, *values)] + (["CURRENT_TIMESTAMP"] if touched else [])
    return (
        f"MERGE INTO {table} t USING {staging} s ON {match}"
        f" WHEN MATCHED THEN UPDATE SET {updates}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(names)})"
        f" VALUES ({', '.join(given)})"
    )


def run_statement(spark: SparkSession, url: str, properties: dict[str, str], sql: str) -> None:
    """One statement on a connection of the driver's JVM."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        if key != "driver":
            settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        statement = connection.createStatement()
        statement.execute(sql)
        statement.close()
    finally:
        connection.close()


@dataclass
class _Staged:
    url: str
    properties: dict[str, str] = field(repr=False)
    table: str
    # at most this many connections write at once
    connections: int = 8
    execute: Callable[[SparkSession, str, dict[str, str], str], None] = run_statement

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    def _move(self, rows: DataFrame, sql: str) -> None:
        (
            rows.write.format("jdbc")
            .option("url", self.url)
            .option("dbtable", self.staging)
            .option("truncate", "true")
            .option("numPartitions", str(self.connections))
            .options(**self.properties)
            .mode("overwrite")
            .save()
        )
        self.execute(rows.sparkSession, self.url, self.properties, sql)


@dataclass
class JdbcRawEventSink(_Staged):
    """Good events only; keep the file sink beside it for the refused ones.

    The table has one row per id, so ids must be unique: messages need their topic position.
    """

    table: str = schemas.RAW_EVENTS.name

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if not has_position(batch.columns):
            raise ValueError("events without partition and offset have no unique id: two alike would become one")
        columns = schemas.RAW_EVENTS.schema.names
        rows = as_raw_events(batch)
        good = rows.filter(F.size(storage_violations(rows.columns)) == 0).select(*columns)
        self._move(good, insert_missing_sql(self.table, self.staging, columns, schemas.RAW_EVENTS.key))


@dataclass
class JdbcMetricSink(_Staged):
    """Upserts emitted windows; ``created_at`` keeps the database's default of the first insert."""

    table: str = schemas.AGGREGATED_METRICS.name

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        keys = schemas.AGGREGATED_METRICS.key
        self._move(
            batch.select(*keys, "metric_value"),
            merge_sql(self.table, self.staging, keys, ("metric_value",), touched="updated_at"),
        )
