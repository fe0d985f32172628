"""Tables of a Spark catalog, made from the one statement of their columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from usageloom import schemas
from usageloom.functions.lineage import shared_folder


@contextmanager
def scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database of its own in the shared folder; its names go at the end, its files stay."""
    name = f"usageloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark, name)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def create_tables(spark: SparkSession, database: str, folder: str) -> None:
    for table in schemas.TABLES.values():
        spark.sql(schemas.create_table_sql(table, f"{folder}/{table.name}", database=database))


def insert(frame: DataFrame, table: schemas.Table, database: str) -> None:
    """Appends the columns ``frame`` has; the others take the table's defaults."""
    spark = frame.sparkSession
    names = [c for c in table.schema.names if c in frame.columns]
    missing = [c for c in table.required if c not in names and c not in table.defaults]
    if missing:
        raise ValueError(f"{table.name} needs {', '.join(missing)}")
    view = f"usageloom_rows_{uuid.uuid4().hex}"
    frame.select(*names).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {database}.{table.name} ({', '.join(names)}) SELECT {', '.join(names)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
