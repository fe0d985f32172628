"""Exact deduplication as a stateful stream.

Texts are equal when identical after each run of white space is one space. The
stream's state is keyed by the digest of that text and lies on disk (RocksDB);
it never expires. It keeps, per digest, how many rows came, the stable
identifier of the row that stays and the locator of its content (file and row
number). Memory holds no digest table: a later batch meets all earlier ones.

A hit, a row whose digest is known, is not yet a copy: its full text is
compared with the text at the locator. Rows that differ (a digest collision)
are grouped by their whole text instead.

Everything is DataFrame and Structured Streaming code, without Python on the
executors. Digests are computed once, by the one scan of all texts; later only
the rows of hits and of their targets are read again.

Defined cases: a null text counts as empty. Of equal texts the smallest doc_id
stays, null ones last; of rows that repeat a doc_id the first by locator stays.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom.llm.common import SPACE, shared_folder, text_or_empty, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: RocksDB on disk; without preallocated logs, as each of many partitions has a small store of its own
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 1000


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """The documents with ``file`` and ``row``, which name a row's place for good.

    A frame that does not come from files is written to the shared folder first.
    """
    wanted = ("doc_id", "text")
    try:
        hidden = docs.metadataColumn("_metadata")
        return docs.select(*wanted, hidden["file_path"].alias("file"), hidden["row_index"].alias("row"))
    except AnalysisException:
        return located(written(docs.select(*wanted), "dedup-input"))


@contextlib.contextmanager
def disk_backed_state(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def keyed_state(digests: DataFrame) -> DataFrame:
    """Per digest the rows seen and the first of them; on a stream this is the state.

    The aggregate is combined before the shuffle, so a digest with a third of all
    rows sends one row per task.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row")
    return digests.groupBy("digest").agg(F.count(F.lit(1)).alias("seen"), F.min(first).alias("first"))


def run_stream(spark: SparkSession, folder: str, schema, checkpoint: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Takes what is new in ``folder`` into the state under ``checkpoint``, then stops.

    Calling it again with the same two folders continues where it ended, also after a failure.
    """
    with disk_backed_state(spark):
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
        (keyed_state(arriving).writeStream.format("noop").outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The whole state as a table: digest, seen, keep_id, keep_file, keep_row."""
    with disk_backed_state(spark):
        stored = spark.read.format("statestore").load(checkpoint)
    return stored.select(
        F.col("key.digest").alias("digest"), F.col("value.count").alias("seen"),
        F.col("value.min.doc_id").alias("keep_id"), F.col("value.min.file").alias("keep_file"),
        F.col("value.min.row").alias("keep_row"),
    )


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, and its locator."""
    spark = docs.sparkSession
    rows = located(docs)
    base = shared_folder(spark, "exact-dedup")
    rows.select("doc_id", digest(normalised()).alias("digest"), "file", "row").write.parquet(f"{base}/digests")
    digests = spark.read.parquet(f"{base}/digests")
    run_stream(spark, f"{base}/digests", digests.schema, f"{base}/stream")
    state = read_state(spark, f"{base}/stream") if not digests.isEmpty() else empty_state(spark)

    judged = written(
        digests.join(state, "digest").withColumn(
            "kept", (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))), "dedup-judged")
    differing = written(differing_rows(rows, judged), "dedup-differing")
    if differing.isEmpty():
        return judged.select("doc_id", "keep_id", F.col("seen").alias("group_size"), "kept", "digest", "file", "row")
    return with_collisions(rows, judged, differing)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "digest string, seen long, keep_id long, keep_file string, keep_row long")


def differing_rows(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """Hits whose full text is not the one at the locator of their group: the locators of these rows.

    Only hits and the first rows of groups with hits move. A large group meets
    one row, which Spark's skew join copies to the parts of the group.
    """
    texts = rows.select("file", "row", normalised().alias("body"))
    hits = judged.filter(~F.col("kept")).select("file", "row", "keep_file", "keep_row")
    targets = judged.filter(F.col("kept") & (F.col("seen") > 1)).select("file", "row")
    hit_texts = texts.join(hits, ["file", "row"])
    target_texts = texts.join(targets, ["file", "row"]).select(
        F.col("file").alias("keep_file"), F.col("row").alias("keep_row"), F.col("body").alias("keep_body"))
    return (hit_texts.join(target_texts, ["keep_file", "keep_row"])
            .filter(F.col("body") != F.col("keep_body")).select("file", "row"))


def with_collisions(rows: DataFrame, judged: DataFrame, differing: DataFrame) -> DataFrame:
    """The result where some digests stand for several texts: those rows form groups by their whole text."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "file", "row")
    bodies = rows.select("file", "row", normalised().alias("body"))
    other = judged.join(differing, ["file", "row"], "left_semi").join(bodies, ["file", "row"])
    groups = other.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("head"))
    regrouped = other.join(groups, ["digest", "body"]).select(
        "doc_id", F.col("head.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        ((F.col("file") == F.col("head.file")) & (F.col("row") == F.col("head.row"))).alias("kept"),
        "digest", "file", "row")
    less = other.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
    same = (judged.join(differing, ["file", "row"], "left_anti").join(less, "digest", "left")
            .select("doc_id", "keep_id", (F.col("seen") - F.coalesce("less", F.lit(0))).alias("group_size"),
                    "kept", "digest", "file", "row"))
    return same.unionByName(regrouped)


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, whole, in their own columns.

    Read from files, rows are named by file and row number. Copies are the
    fewer rows, so they are what is looked up.
    """
    try:
        hidden = docs.metadataColumn("_metadata")
        placed = docs.withColumns({"_usageloom_file": hidden["file_path"], "_usageloom_row": hidden["row_index"]})
    except AnalysisException:
        return without_copies(written(docs, "dedup-input"))
    copies = exact_duplicates(docs).filter(~F.col("kept")).select(
        F.col("file").alias("_usageloom_file"), F.col("row").alias("_usageloom_row"))
    kept = placed.join(copies, ["_usageloom_file", "_usageloom_row"], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
