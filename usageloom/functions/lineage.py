"""Shared folders for streams, models and intermediate tables.

On a cluster the session names a shared folder in ``spark.checkpoint.dir``.
Only where that is unset and the master is local (tests, a single machine) is a
local folder used; on any other master that is an error, because each executor
would write to its own disk and readers would miss what the others wrote.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def is_local(master: str) -> bool:
    """Whether driver and executors are one process, and so share their folders."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach; it is not created here."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="usageloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str = "table") -> DataFrame:
    """``df`` as a parquet table in the shared folder.

    Later jobs read it instead of recomputing, only the columns they need, and
    a lost executor takes nothing with it.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder in any storage Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
