import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from usageloom import schemas
from usageloom.functions import lineage, numeric, timeparts
from usageloom.functions.latest import latest, latest_rows, latest_rows_ranked


def exact(parts, whole, scale, digits):
    if whole == 0:
        return None
    step = Decimal(1).scaleb(-digits)
    return float((Decimal(scale) * parts / Decimal(whole)).quantize(step, ROUND_HALF_UP))


def test_rounding_equals_exact_half_up(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(0, 3000), rng.randrange(0, 2000)) for _ in range(3000)]
    pairs += [(201, 20000), (1, 8), (3, 8), (0, 0), (5, 0), (10**14, 3 * 10**13)]
    rows = (
        spark.createDataFrame(pairs, "n bigint, t bigint")
        .select(
            "n",
            "t",
            numeric.percent(F.col("n"), F.col("t")).alias("pct"),
            numeric.ratio(F.col("n"), F.col("t")).alias("two"),
            numeric.ratio(F.col("n"), F.col("t"), 3).alias("three"),
        )
        .collect()
    )
    for r in rows:
        assert r["pct"] == exact(r["n"], r["t"], 100, 2)
        assert r["two"] == exact(r["n"], r["t"], 1, 2)
        assert r["three"] == exact(r["n"], r["t"], 1, 3)


def test_latest_breaks_ties_by_id(events):
    log = events(
        [
            (1, "a", "2024-01-01 00:00:00", "login", "free", None, "US"),
            (3, "a", "2024-01-02 00:00:00", "logout", "pro", None, "DE"),
            (2, "a", "2024-01-02 00:00:00", "login", "basic", None, "FR"),
            (4, "b", "2024-01-01 00:00:00", "login", "free", None, None),
        ]
    )
    got = log.groupBy("user_id").agg(latest("plan_tier", "country").alias("l")).collect()
    assert {r["user_id"]: tuple(r["l"]) for r in got} == {"a": ("pro", "DE"), "b": ("free", None)}
    by_group = latest_rows(log, ["user_id"]).collect()
    by_rank = latest_rows_ranked(log, ["user_id"]).collect()
    assert sorted(by_group) == sorted(by_rank)
    assert {r["id"] for r in by_group} == {3, 4}


def test_latest_combines_before_the_shuffle(events):
    log = events([(1, "a", "2024-01-01 00:00:00", "login", "free", None, "US")])
    plan = log.groupBy("user_id").agg(latest("plan_tier"))._jdf.queryExecution().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_week_starts_on_monday(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-07 23:59:59' AS t").select(
        timeparts.week_start(F.col("t")).alias("w"), timeparts.month_start(F.col("t")).alias("m")
    ).first()
    assert str(row["w"]) == "2024-01-01" and str(row["m"]) == "2024-01-01"


def test_range_prunes_day_partitions(spark, events, tmp_path):
    log = events(
        [(i, "a", f"2024-01-0{i} 10:00:00", "login", "free", None, "US") for i in range(1, 6)]
    ).withColumn("event_date", timeparts.day(F.col("event_timestamp")))
    log.write.partitionBy("event_date").parquet(str(tmp_path / "log"))
    read = spark.read.parquet(str(tmp_path / "log"))
    part = timeparts.within(
        read, F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date")
    )
    assert [r["id"] for r in part.collect()] == [2]
    plan = part._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "event_date" in partition_filters
    assert "GreaterThanOrEqual(event_timestamp" in plan


def test_written_tables_cut_the_lineage(spark):
    frame = lineage.written(spark.range(10).withColumn("x", F.col("id") * 2))
    assert frame.agg(F.sum("x")).first()[0] == 90
    plan = frame.select("x")._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "ReadSchema: struct<x:bigint>" in plan


def test_table_text_names_every_column(spark):
    for table in schemas.TABLES.values():
        text = schemas.create_table_sql(table, "/somewhere")
        for field in table.schema.fields:
            assert field.name in text
            assert (f"{field.name} {field.dataType.simpleString()} NOT NULL" in text) != field.nullable
        assert set(table.key) <= set(table.schema.names)
        assert set(table.max_length) <= set(table.schema.names)
