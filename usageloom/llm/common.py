"""What the corpus operators share: table access, written tables and shipping code to executors.

Every operator picks the columns it needs by name first, so extra columns never
clash with the names it makes.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom.functions.lineage import shared_folder, written

__all__ = ["read_table", "shared_folder", "written", "ship_code", "text_or_empty", "utf8_bytes", "shuffle_width"]

#: white space of the word contracts: space and the ASCII controls 9 to 13
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def utf8_bytes(column: Column) -> Column:
    return F.octet_length(column).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_code(spark: SparkSession) -> None:
    """Gives this package to the executors' Python workers, once per context."""
    context = spark.sparkContext
    if getattr(context, "_usageloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="usageloom-code-")
    archive = os.path.join(folder, "usageloom_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._usageloom_shipped = True

