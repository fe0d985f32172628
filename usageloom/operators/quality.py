"""What a good event is, which tables keep their rules, and whether the mix of values is as expected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom import schemas
from usageloom.functions import numeric

# fixed values: text forms of a canonical UUID and of an ISO 8601 time with offset
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ISO_TIME_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})$"
)


def _reasons(rules: Mapping[str, Column]) -> Column:
    """Names of the rules whose condition holds, as an array; NULL conditions count as not broken.

    Joining skips NULLs inside generated code. Filtering an array of names
    would be interpreted, and every rule in it with it.
    """
    joined = F.concat_ws("|", *[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return F.when(joined != "", F.split(joined, r"\|")).otherwise(F.array().cast("array<string>"))


def _too_long(table: schemas.Table, columns: Sequence[str]) -> dict[str, Column]:
    return {
        f"{c}_too_long": F.length(c) > limit
        for c, limit in table.max_length.items()
        if c in columns
    }


def storage_violations(
    columns: Sequence[str], table: schemas.Table = schemas.RAW_EVENTS
) -> Column:
    """Reasons a database would refuse the row: a required value missing, a text too long."""
    missing = {f"{c}_missing": F.col(c).isNull() for c in table.required if c in columns}
    return _reasons({**missing, **_too_long(table, columns)})


def validate_messages(messages: DataFrame) -> DataFrame:
    """Every message with the contract rules it breaks, ``reasons`` empty for a good one.

    A field must be JSON text or null; a number or an object in its place is a broken
    rule of its own and is judged further by its text. The form of the time, offset
    included, is judged as sent. Other columns of ``messages`` are carried along.
    """
    text = F.col("value").cast("string")
    carried = [c for c in messages.columns if c not in ("key", "value")]
    # one parse gives the values, their JSON kinds, and tells which keys were there
    parsed = messages.select(
        *carried, text.alias("raw_value"), F.from_json(text, "map<string, variant>").alias("m")
    ).select(
        *carried,
        "raw_value",
        F.map_keys("m").alias("_keys"),
        *[F.col("m").getItem(name).alias(f"_{name}_sent") for name in schemas.MESSAGE_FIELDS],
    ).withColumns({f"_{name}": F.col(f"_{name}_sent").cast("string") for name in schemas.MESSAGE_FIELDS})

    def field(name: str) -> Column:
        return F.col(f"_{name}")

    def not_in(name: str, values: Sequence[str]) -> Column:
        return ~F.coalesce(field(name).isin(*values), F.lit(False))

    expected = F.array(*[F.lit(name) for name in schemas.MESSAGE_FIELDS])
    is_feature_use = F.coalesce(field("event_type") == F.lit(schemas.FEATURE_EVENT), F.lit(False))
    def not_text(name: str) -> Column:
        return ~F.schema_of_variant(F.col(f"_{name}_sent")).isin("STRING", "VOID")

    broken = {
        "keys_missing": F.size(F.array_except(expected, F.col("_keys"))) > 0,
        **{f"{name}_not_text": not_text(name) for name in schemas.MESSAGE_FIELDS},
        "user_id_missing": F.coalesce(F.length(field("user_id")), F.lit(0)) == 0,
        "session_id_not_uuid": ~F.coalesce(field("session_id").rlike(UUID_PATTERN), F.lit(False)),
        "timestamp_not_iso": ~F.coalesce(
            field("timestamp").rlike(ISO_TIME_PATTERN), F.lit(False)
        )
        | F.try_to_timestamp(field("timestamp")).isNull(),
        "event_type_unknown": not_in("event_type", schemas.EVENT_TYPES),
        "plan_tier_unknown": not_in("plan_tier", schemas.PLAN_TIERS),
        "country_unknown": not_in("country", schemas.COUNTRIES),
        "feature_name_unexpected": ~is_feature_use & field("feature_name").isNotNull(),
        "feature_name_unknown": is_feature_use & not_in("feature_name", schemas.FEATURE_NAMES),
        **{
            f"{c}_too_long": F.length(field(c)) > limit
            for c, limit in schemas.RAW_EVENTS.max_length.items()
        },
    }
    # no object at all: one reason instead of one per field
    readable = F.col("_keys").isNotNull()
    return parsed.select(
        *carried,
        "raw_value",
        F.when(readable, _reasons(broken))
        .otherwise(F.array(F.lit("payload_unreadable")))
        .alias("reasons"),
    ).withColumn("is_valid", F.size("reasons") == 0)


def check_constraints(frame: DataFrame, table: schemas.Table) -> DataFrame:
    """Violations per table rule: rows for NOT NULL and lengths, repeated keys for UNIQUE.

    The frame is read once: rows are grouped by key with a counter per row rule, then the
    counters are added up and repeated keys counted. Both steps combine before they
    shuffle, so a key repeated a billion times is still one row per task. A key with a
    missing part is never a repeated one.
    """
    rules = {
        **{f"not_null({c})": F.col(c).isNull() for c in table.required if c in frame.columns},
        **{
            f"max_length({c})": F.length(c) > limit
            for c, limit in table.max_length.items()
            if c in frame.columns
        },
    }
    counters = {rule: f"_rule_{i}" for i, rule in enumerate(rules)}
    per_key = frame.groupBy(*table.key).agg(
        F.count("*").alias("_copies"), *[F.count_if(rules[r]).alias(c) for r, c in counters.items()]
    )
    whole_key = F.lit(True)
    for c in table.key:
        whole_key = whole_key & F.col(c).isNotNull()
    found = [
        F.struct(F.lit(rule).alias("rule"), F.coalesce(F.sum(c), F.lit(0)).alias("violations"))
        for rule, c in counters.items()
    ]
    repeated = F.struct(
        F.lit(f"unique({','.join(table.key)})").alias("rule"),
        F.count_if((F.col("_copies") > 1) & whole_key).alias("violations"),
    )
    return (
        per_key.agg(F.array(*found, repeated).alias("found"))
        .select(F.explode("found").alias("f"))
        .select(F.lit(table.name).alias("table_name"), "f.rule", "f.violations")
    )


def category_distribution(events: DataFrame, mixes: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Per column count, share and expected share of each category; expected ones nobody used have count 0.

    ``mixes``: column to the expected weight of its categories. The events are read once and
    reduced to the combinations of categories that occur.
    """
    spark = events.sparkSession
    columns = list(mixes)
    counts = events.groupBy(*columns).agg(F.count("*").alias("n"))
    sides = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("category")) for c in columns])
    used = counts.select(F.explode(sides).alias("s"), "n").select(
        "s.column_name", "s.category", "n", F.lit(0).cast("bigint").alias("weight"))
    # one row per declared category
    expected = spark.createDataFrame(
        [(c, name, 0, int(weight)) for c, mix in mixes.items() for name, weight in mix.items()],
        "column_name string, category string, n bigint, weight bigint",
    )
    both = used.unionByName(expected).groupBy("column_name", "category").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
    totals = W.partitionBy("column_name")  # over one row per category
    return both.select(
        "column_name",
        "category",
        "n",
        numeric.percent(F.col("n"), F.sum("n").over(totals)).alias("share_pct"),
        numeric.percent(F.col("weight"), F.sum("weight").over(totals)).alias("expected_pct"),
    ).withColumn("diff_pct", F.col("share_pct") - F.col("expected_pct"))


EVENT_TYPE_MIX = dict(zip(schemas.EVENT_TYPES, schemas.EVENT_TYPE_WEIGHTS))
PLAN_TIER_MIX = dict(zip(schemas.PLAN_TIERS, schemas.PLAN_TIER_WEIGHTS))
