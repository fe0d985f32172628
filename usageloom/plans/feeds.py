"""Message feeds and query texts derived from the given tables, faults and redeliveries included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageloom.sources.clickstream import raw_events, to_raw_events
from usageloom.sources.messages import encode_events

CLICKS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def stream_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pattern, because a stream source takes a single file only through one
    return spark.readStream.schema(CLICKS).parquet(f"{sf_dir}/events.{{parquet}}")


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_events(to_raw_events(stream_clicks(spark, sf_dir)))


def with_faults(events: DataFrame) -> DataFrame:
    """One message per event, most of them damaged in one of fourteen ways, some delivered twice.

    ``partition`` and ``offset`` stand where a topic would put them; a
    redelivery repeats the offset.
    """
    kind = F.pmod("id", F.lit(16))
    stamp = F.date_format(F.col("event_timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = {
        "user_id": F.when(kind == 11, "").otherwise(F.col("user_id")),
        "session_id": F.when(kind == 7, F.upper("session_id")).otherwise(F.col("session_id")),
        "timestamp": F.when(kind == 2, "yesterday")
        .when(kind == 9, stamp)
        .otherwise(F.concat(stamp, F.lit("+00:00"))),
        "event_type": F.when(kind == 3, "refund").otherwise(F.col("event_type")),
        "plan_tier": F.when(kind == 4, "gold").otherwise(F.col("plan_tier")),
        "feature_name": F.when(kind == 5, "dashboard_view")
        .when(kind == 6, F.lit(None).cast("string"))
        .otherwise(F.col("feature_name")),
        "country": F.when(kind == 10, "far-away-country").otherwise(F.col("country")),
    }
    keep_nulls = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), keep_nulls)
    short = F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items() if n != "country"]), keep_nulls
    )
    def with_value(field: str, value: Column) -> Column:
        return F.to_json(F.struct(*[(value if n == field else c).alias(n) for n, c in fields.items()]), keep_nulls)

    value = (
        F.when(kind == 13, with_value("user_id", F.col("user_id").cast("bigint")))
        .when(kind == 14, with_value("country", F.struct(F.col("country").alias("code"))))
        .when(kind == 0, F.concat(F.lit("not json "), F.col("user_id")))
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 8, short)
        .otherwise(whole)
    )
    deliveries = F.when(kind == 12, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return events.select(
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.col("user_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.explode(deliveries).alias("delivery"),
    ).drop("delivery")


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_faults(raw_events(spark, sf_dir))


#: arrivals the delayed feed comes in, each a part of the time the log spans
ARRIVALS = 4


def delayed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with the ``arrival`` of each: that of its time, but one in ten comes an arrival later, some even two."""
    events = raw_events(spark, sf_dir)
    micros = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    first, last = (events.agg(f(micros).alias("at")).scalar() for f in (F.min, F.max))
    own = F.call_function("div", (micros - first) * ARRIVALS, last - first + 1)
    delay = F.when(F.col("id") % 50 == 7, 2).when(F.col("id") % 10 == 3, 1).otherwise(0)
    placed = events.withColumn("arrival", F.least(own + delay, F.lit(ARRIVALS - 1)).cast("int"))
    encoded = encode_events(placed, carried=("id", "arrival"))
    return encoded.select(F.lit(0).alias("partition"), F.col("id").alias("offset"), "key", "value", "arrival")


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query text per event, and one holding each document as a string literal."""
    user = F.col("user_id")
    quote = F.lit("'")
    kind = F.pmod("id", F.lit(8))
    per_event = raw_events(spark, sf_dir).select(
        F.concat(F.lit("event-"), F.col("id").cast("string")).alias("query_id"),
        F.when(kind == 0, F.concat(F.lit("SELECT * FROM raw_events WHERE user_id = '"), user, quote))
        .when(
            kind == 1,
            F.concat(
                F.lit(" \n\twith u AS (SELECT user_id FROM raw_events) SELECT * FROM u WHERE user_id = '"),
                user,
                F.lit("' ;; "),
            ),
        )
        .when(kind == 2, F.concat(F.lit("DELETE FROM raw_events WHERE user_id = '"), user, quote))
        .when(kind == 3, F.concat(F.lit("select updated_at from user_metrics -- "), user))
        .when(kind == 4, F.concat(F.lit("EXPLAIN SELECT "), user))
        .when(kind == 5, F.concat(F.lit("SELECT * INTO t"), user, F.lit(" FROM raw_events;")))
        .when(kind == 6, F.concat(F.lit("SELECT("), user, F.lit(")")))
        .otherwise(
            F.concat(F.lit("SELECT "), user, F.lit(" FROM raw_events WHERE event_type = 'Update'"))
        )
        .alias("sql"),
    )
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    per_document = documents.select(
        F.concat(F.lit("document-"), F.col("doc_id").cast("string")).alias("query_id"),
        F.concat(F.lit("SELECT '"), F.replace(F.col("text"), quote, F.lit("''")), F.lit("' AS t;")).alias("sql"),
    )
    return per_event.unionByName(per_document)


def gated_texts(sf_dir: str) -> dict[str, str]:
    """Texts a user might send, by name: some to run over the views, some to refuse for their words or what they read."""
    return {
        "users_per_tier": "SELECT plan_tier, count(DISTINCT user_id) AS users FROM raw_events GROUP BY plan_tier;",
        "with_and_subquery": "WITH busy AS (SELECT user_id, count(*) AS n FROM raw_events GROUP BY user_id)"
        " SELECT user_id FROM busy WHERE n > (SELECT avg(n) FROM busy) ;; ",
        "join_of_views": "select m.user_id from user_metrics m join raw_events e on m.user_id = e.user_id"
        " where e.event_type = 'upgrade' and m.plan_tier = 'pro'",
        "literal_rows": "SELECT v FROM VALUES (1), (2), (3) AS t(v)",
        "word_in_text": "SELECT count(*) AS n FROM raw_events WHERE event_type = 'update'",
        "change": "DELETE FROM raw_events",
        "files": f"SELECT * FROM parquet.`{sf_dir}/customer.parquet`",
        "files_beneath": f"SELECT user_id FROM raw_events WHERE user_id IN (SELECT name FROM text.`{sf_dir}/nation.parquet` AS t(name))",
        "table_function": "SELECT id FROM range(5)",
        "outside_code": "SELECT reflect('java.lang.System', 'getProperty', 'user.dir') AS d FROM raw_events",
    }
