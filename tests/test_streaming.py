"""Late data, retries, restarts, quarantine, compaction and supervision."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from usageloom import schemas
from usageloom.operators import activity, rollups
from usageloom.sources import event_log, messages
from usageloom.streaming import jobs, sinks

SESSION = "9b2d8f5e-1111-4222-8333-0123456789ab"


def message(at, user="u", kind="login", feature=None, tier="free", country="US"):
    return json.dumps(
        {
            "user_id": user,
            "session_id": SESSION,
            "timestamp": at,
            "event_type": kind,
            "plan_tier": tier,
            "feature_name": feature,
            "country": country,
        }
    )


def at(clock):
    return f"2024-01-01T{clock}.000000+00:00"


def drop(folder, name, texts, when):
    """One file per batch; modification times fix the order."""
    path = folder / name
    path.write_text("\n".join(texts) + "\n")
    os.utime(path, (when, when))


def text_stream(spark, folder, per_batch=1):
    return messages.read_event_stream(
        spark, "text", str(folder), options={"maxFilesPerTrigger": str(per_batch)}
    )


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


class Recorder:
    """Keeps what each batch emitted."""

    def __init__(self):
        self.batches = {}

    def __call__(self, batch, batch_id):
        rows = batch.select(F.date_format("window_start", "HH:mm").alias("w"), "metric_value")
        self.batches[batch_id] = sorted((r["w"], int(r["metric_value"])) for r in rows.collect())


def test_late_events_count_until_the_watermark_passes(spark, inbox, tmp_path):
    sequence = [["00:00:10", "00:00:50"], ["00:05:00"], ["00:00:30"], ["00:00:40"], ["00:05:10"], ["00:09:00"]]
    for i, clocks in enumerate(sequence):
        drop(inbox, f"{i}.txt", [message(at(c)) for c in clocks], 1_700_000_000 + i)
    recorder = Recorder()
    counts = jobs.window_counts(messages.decode_events(text_stream(spark, inbox)))
    query = jobs.start(counts, recorder, str(tmp_path / "cp"), trigger={"availableNow": True})
    query.awaitTermination()
    emitted = [recorder.batches[i] for i in range(6)]
    assert emitted == [
        [("00:00", 2)],
        [("00:05", 1)],
        [("00:00", 3)],  # the late filter still uses the watermark of the batch before
        [],
        [("00:05", 2)],
        [("00:09", 1)],
    ]


def test_update_mode_upserts_and_restart_continues(spark, inbox, tmp_path):
    path, cp = str(tmp_path / "metrics"), str(tmp_path / "cp")

    def run():
        counts = jobs.window_counts(messages.decode_events(text_stream(spark, inbox)))
        jobs.run_once(counts, sinks.ChangelogSink(path), cp)

    drop(inbox, "0.txt", [message(at("00:00:10")), message(at("00:00:20"))], 1_700_000_000)
    run()
    drop(inbox, "1.txt", [message(at("00:00:30")), message(at("00:01:00"))], 1_700_000_100)
    run()  # state and position come from the checkpoint
    got = {r["window_start"].minute: r for r in sinks.metrics_latest(spark, path).collect()}
    assert {m: r["metric_value"] for m, r in got.items()} == {0: 3.0, 1: 1.0}
    assert got[0]["created_at"] < got[0]["updated_at"]
    assert got[1]["created_at"] == got[1]["updated_at"]
    assert rollups.kpi_overview(sinks.metrics_latest(spark, path)).first()["total_events"] == 4


def test_watermark_marks_the_open_window(spark, inbox, tmp_path):
    path = str(tmp_path / "metrics")
    drop(inbox, "0.txt", [message(at("00:00:10")), message(at("00:05:30"))], 1_700_000_000)
    counts = jobs.window_counts(messages.decode_events(text_stream(spark, inbox)))
    query = jobs.start(counts, sinks.ChangelogSink(path), str(tmp_path / "cp"), trigger={"availableNow": True})
    query.awaitTermination()
    kpi = rollups.kpi_overview(sinks.metrics_latest(spark, path), watermark=jobs.watermark_of(query))
    assert tuple(kpi.first()) == (2, 1, 1.0, False)


def metric_rows(spark, values, minute="2024-01-01 00:00:00"):
    return spark.createDataFrame([(float(v),) for v in values], "metric_value double").select(
        F.lit(minute).cast("timestamp").alias("window_start"),
        (F.lit(minute).cast("timestamp") + F.expr("interval 1 minute")).alias("window_end"),
        F.lit("events_per_minute").alias("metric_name"),
        "metric_value",
    )


def test_a_batch_written_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "metrics")
    sink = sinks.ChangelogSink(path)
    for batch_id, value in enumerate((1, 4, 9)):
        sink(metric_rows(spark, [value]), batch_id)
        sink(metric_rows(spark, [value]), batch_id)
    assert sinks.versions(spark, path, sinks.METRIC_ROW).count() == 3
    assert [r["metric_value"] for r in sinks.metrics_latest(spark, path).collect()] == [9.0]


def test_empty_batches_write_nothing(spark, tmp_path):
    path = str(tmp_path / "metrics")
    sinks.ChangelogSink(path)(metric_rows(spark, []), 0)
    assert sinks.metrics_latest(spark, path).count() == 0
    assert sinks.metrics_latest(spark, str(tmp_path / "never written")).count() == 0


def test_a_new_epoch_outranks_older_batches(spark, tmp_path):
    path = str(tmp_path / "metrics")
    old, new = sinks.ChangelogSink(path), sinks.ChangelogSink(path, epoch=1)
    old(metric_rows(spark, [5]), 700)
    new(metric_rows(spark, [2]), 0)
    assert sinks.versions(spark, path, sinks.METRIC_ROW).count() == 2
    assert sinks.metrics_latest(spark, path).first()["metric_value"] == 2.0


def test_compaction_keeps_the_readers_view(spark, tmp_path):
    path = str(tmp_path / "metrics")
    sink = sinks.ChangelogSink(path)
    keys = schemas.AGGREGATED_METRICS.key
    assert sinks.compact(spark, path, sinks.METRIC_ROW, keys) is None
    for batch_id in range(4):
        sink(metric_rows(spark, [batch_id]), batch_id)
        sink(metric_rows(spark, [1], f"2024-01-01 00:1{batch_id}:00").unionByName(
            metric_rows(spark, [batch_id])), batch_id)
    before = sorted(map(tuple, sinks.metrics_latest(spark, path).collect()))
    assert sinks.compact(spark, path, sinks.METRIC_ROW, keys) == 2
    assert sorted(map(tuple, sinks.metrics_latest(spark, path).collect())) == before
    # the last batch stays replaceable, and later ones win
    sink(metric_rows(spark, [33]), 3)
    sink(metric_rows(spark, [44]), 4)
    assert sinks.compact(spark, path, sinks.METRIC_ROW, keys) == 3
    latest = {r["window_start"].minute: r["metric_value"] for r in sinks.metrics_latest(spark, path).collect()}
    assert latest[0] == 44.0 and len(latest) == 4
    # folded batches are not opened any more
    rows = sinks.versions(spark, path, sinks.METRIC_ROW)
    assert rows.count() == 4 + 1
    opened = rows.inputFiles()
    assert opened and all("/batch_id=4/" in f or "/upto=3/" in f for f in opened)


def test_folded_segments_are_not_looked_into(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "SEGMENT", 2)
    path = str(tmp_path / "metrics")
    sink = sinks.ChangelogSink(path)
    for batch_id in range(6):
        sink(metric_rows(spark, [batch_id], f"2024-01-01 00:0{batch_id}:00"), batch_id)
    sinks.ChangelogSink(path, epoch=1)(metric_rows(spark, [9]), 0)
    assert len(sinks.live_batches(spark, path)) == 7
    assert sinks.compact(spark, path, sinks.METRIC_ROW, schemas.AGGREGATED_METRICS.key) == 5
    seen, numbered = [], sinks._numbered

    def listed(files, place, column):
        seen.append(place.toString())
        return numbered(files, place, column)

    monkeypatch.setattr(sinks, "_numbered", listed)
    assert list(sinks.live_batches(spark, path, 5)) == [1 << sinks.EPOCH_SHIFT]
    assert not [f for f in seen if "epoch=0/segment=" in f]
    latest = {r["window_start"].minute: r["metric_value"] for r in sinks.metrics_latest(spark, path).collect()}
    assert latest == {0: 9.0, 1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 5.0}


def test_a_second_checkpoint_cannot_overwrite(spark, inbox, tmp_path):
    path = str(tmp_path / "metrics")

    def run(checkpoint, epoch=0):
        counts = jobs.window_counts(messages.decode_events(text_stream(spark, inbox)))
        jobs.run_once(counts, sinks.ChangelogSink(path, epoch), str(tmp_path / checkpoint))

    drop(inbox, "0.txt", [message(at("00:00:10")), message(at("00:00:20"))], 1_700_000_000)
    run("first")
    (inbox / "0.txt").unlink()
    drop(inbox, "1.txt", [message(at("00:00:30"))], 1_700_000_100)
    with pytest.raises(Exception, match="raise the epoch"):
        run("second")
    assert [r["metric_value"] for r in sinks.metrics_latest(spark, path).collect()] == [2.0]
    with pytest.raises(sinks.ForeignWriter):
        sinks.ChangelogSink(path)(metric_rows(spark, [7]), 0)
    run("third", epoch=1)
    assert [r["metric_value"] for r in sinks.metrics_latest(spark, path).collect()] == [1.0]
    drop(inbox, "2.txt", [message(at("00:00:40"))], 1_700_000_200)
    run("third", epoch=1)  # the same query goes on
    assert [r["metric_value"] for r in sinks.metrics_latest(spark, path).collect()] == [2.0]


def test_event_log_has_one_writer_as_well(spark, tmp_path):
    batch = messages.decode_events(spark.createDataFrame([(message(at("00:00:10")),)], "value string"))
    sinks.claim(spark, str(tmp_path / "raw"), 0, "a query")
    with pytest.raises(sinks.ForeignWriter, match="a query"):
        sinks.RawEventSink(str(tmp_path / "raw"))(batch, 0)
    sinks.RawEventSink(str(tmp_path / "raw"), epoch=1)(batch, 0)
    assert event_log.read_event_log(spark, str(tmp_path / "raw")).count() == 1


def test_bad_messages_go_to_quarantine_and_the_stream_lives(spark, inbox, tmp_path, caplog):
    caplog.set_level("INFO", "usageloom")
    texts = [
        message(at("00:00:10"), kind="feature_used", feature="bulk_import"),
        "not json",
        message("yesterday"),
        message(at("00:00:20"), user="x" * 40),
        message(at("00:00:30"), kind="refund"),  # unknown, yet a table row like any other
    ]
    drop(inbox, "0.txt", texts, 1_700_000_000)
    drop(inbox, "1.txt", [message(at("00:01:00"))], 1_700_000_100)
    table = str(tmp_path / "raw")
    decoded = messages.decode_events(text_stream(spark, inbox))
    jobs.run_once(decoded, sinks.RawEventSink(table), str(tmp_path / "cp"), "append")
    assert "batch 0: 5 raw event(s), 3 refused" in caplog.text
    good = event_log.read_event_log(spark, table)
    assert sorted(r["event_type"] for r in good.collect()) == ["feature_used", "login", "refund"]
    bad = {r["raw_value"]: set(r["reasons"]) for r in event_log.read_quarantine(spark, table).collect()}
    assert set(bad) == set(texts[1:4])
    assert bad[texts[2]] == {"event_timestamp_missing"}
    assert bad[texts[3]] == {"user_id_too_long"}
    assert {"user_id_missing", "event_type_missing"} <= bad["not json"]
    assert [r["dau"] for r in activity.daily_active_users(good).collect()] == [1]


@pytest.mark.parametrize("files_per_date", [None, 3])
def test_raw_batches_are_idempotent(spark, tmp_path, files_per_date):
    table = str(tmp_path / "raw")
    texts = [(message(at("00:00:10"), user=f"u{i}"),) for i in range(50)] + [("not json",)]
    batch = messages.decode_events(spark.createDataFrame(texts, "value string"))
    sink = sinks.RawEventSink(table, files_per_date=files_per_date)
    sink(batch, 0)
    sink(batch, 0)
    assert event_log.read_event_log(spark, table).count() == 50
    assert event_log.read_quarantine(spark, table).count() == 1
    sink(batch, 1)
    assert event_log.read_event_log(spark, table).count() == 100
    if files_per_date:
        folder = tmp_path / "raw" / "valid=true" / "event_date=2024-01-01" / "epoch=0" / "batch_id=1"
        assert len(list(folder.glob("*.parquet"))) <= files_per_date


def test_rollup_streams_equal_batch(spark, inbox, tmp_path):
    lines = []
    for i in range(200):
        kind = "feature_used" if i % 2 else "login"
        feature = schemas.FEATURE_NAMES[i % 8] if i % 2 else None
        lines.append(message(at(f"00:0{i // 40}:{i % 40:02d}"), f"u{i % 7}", kind, feature,
                             schemas.PLAN_TIERS[i % 4], schemas.COUNTRIES[i % 10]))
    for part in range(4):
        drop(inbox, f"{part}.txt", lines[part * 50:(part + 1) * 50], 1_700_000_000 + part)
    decoded = messages.decode_events(text_stream(spark, inbox))
    batch = messages.as_raw_events(messages.decode_events(spark.read.text(str(inbox))))

    jobs.run_once(jobs.user_rollup(decoded), sinks.ChangelogSink(str(tmp_path / "users")), str(tmp_path / "c1"))
    users = sinks.user_metrics_latest(spark, str(tmp_path / "users")).drop("updated_at")
    assert sorted(map(str, users.collect())) == sorted(map(str, rollups.user_metrics(batch).collect()))

    exact = activity.active_users_per_window(batch)
    jobs.run_once(jobs.window_sketches(decoded), sinks.ChangelogSink(str(tmp_path / "active")), str(tmp_path / "c2"))
    sketches = sinks.window_sketches_latest(spark, str(tmp_path / "active"))
    estimates = sketches.select("window_start", F.hll_sketch_estimate("sketch").alias("n"))
    assert sorted(map(tuple, estimates.collect())) == sorted((r["window_start"], r["active_users"]) for r in exact.collect())
    assert [r["estimate"] for r in activity.active_users_estimated(sketches, "month").collect()] == [7]

    jobs.run_once(jobs.active_users_exact(decoded), sinks.ChangelogSink(str(tmp_path / "exact")),
                  str(tmp_path / "c3"), "append")
    closed = sinks.active_users_latest(spark, str(tmp_path / "exact")).count()
    assert closed == exact.filter("window_end <= timestamp'2024-01-01 00:03:39'").count()


def test_two_queries_over_one_stream(spark, inbox, tmp_path):
    drop(inbox, "0.txt", [message(at("00:00:10")), "not json", message(at("00:02:00"))], 1_700_000_000)
    queries = jobs.start_ingest(
        text_stream(spark, inbox), str(tmp_path / "out"), str(tmp_path / "cp"), trigger={"availableNow": True}
    )
    jobs.supervise(spark, queries)
    assert rollups.kpi_overview(
        sinks.metrics_latest(spark, str(tmp_path / "out" / "aggregated_metrics"))
    ).first()["total_events"] == 2
    assert event_log.read_event_log(spark, str(tmp_path / "out" / "raw_events")).count() == 2


def test_failure_of_one_query_stops_the_others(spark, inbox, tmp_path):
    drop(inbox, "0.txt", [message(at("00:00:10"))], 1_700_000_000)
    decoded = messages.decode_events(text_stream(spark, inbox))

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")

    healthy = jobs.start(decoded, sinks.RawEventSink(str(tmp_path / "raw")), str(tmp_path / "c1"),
                         output_mode="append", trigger={"processingTime": "1 second"})
    failing = jobs.start(decoded, broken, str(tmp_path / "c2"), output_mode="append",
                         trigger={"processingTime": "1 second"})
    with pytest.raises(Exception, match="sink is down"):
        jobs.supervise(spark, [healthy, failing])
    for _ in range(50):
        if not healthy.isActive:
            break
        time.sleep(0.1)
    assert not healthy.isActive and not failing.isActive


def test_checkpoint_is_not_optional(spark, inbox):
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.start(text_stream(spark, inbox), print, "")


def test_database_statements():
    from usageloom.streaming import jdbc

    insert = jdbc.insert_missing_sql("raw_events", "s1", ["id", "user_id"], ["id"])
    assert insert == (
        "INSERT INTO raw_events (id, user_id) SELECT DISTINCT id, user_id FROM s1 s"
        " WHERE NOT EXISTS (SELECT 1 FROM raw_events t WHERE t.id = s.id)"
    )
    merge = jdbc.merge_sql("m", "s1", ("a", "b"), ("v",))
    assert "ON t.a = s.a AND t.b = s.b" in merge
    assert "WHEN MATCHED THEN UPDATE SET v = s.v" in merge
    assert "INSERT (a, b, v) VALUES (s.a, s.b, s.v)" in merge
    sink = jdbc.JdbcMetricSink("jdbc:x", {"password": "secret"})
    assert sink.staging == "aggregated_metrics_staging" and "secret" not in repr(sink)


def test_metric_merge_sets_the_time_of_the_write():
    from usageloom.streaming import jdbc

    merge = jdbc.merge_sql("m", "s1", ("a",), ("v",), touched="updated_at")
    assert "UPDATE SET v = s.v, updated_at = CURRENT_TIMESTAMP" in merge
    assert "INSERT (a, v, updated_at) VALUES (s.a, s.v, CURRENT_TIMESTAMP)" in merge


def test_upserts_hold_events_of_any_year(spark, tmp_path):
    """Running counts lose nothing, whenever the events happened."""
    from conftest import SMALL

    from usageloom.plans.registry import QUERIES

    late = spark.read.parquet(f"{SMALL}/events.parquet").withColumn(
        "ts", F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("ts")))
    late.write.parquet(str(tmp_path / "events.parquet"))
    total = F.sum("metric_value")
    folder = str(tmp_path)
    assert (QUERIES["upsert_metrics"](spark, folder).agg(total).first()
            == QUERIES["events_per_minute"](spark, folder).agg(total).first())


def test_folders_off_a_single_machine_must_be_named():
    from usageloom.functions import lineage

    assert lineage.is_local("local[8]") and lineage.is_local("local")
    assert not lineage.is_local("local-cluster[3,2,1024]") and not lineage.is_local("yarn")

    class Far:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_folder(Far, "x")


def test_window_users_are_combined_before_the_shuffle(spark):
    from conftest import SMALL

    from usageloom.plans import feeds
    from usageloom.sources.messages import decode_events

    events = feeds.to_raw_events(spark.read.parquet(f"{SMALL}/events.parquet"))
    plan = jobs.window_users(decode_events(feeds.encode_events(events)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("partial_count")


def test_database_sink_refuses_events_without_a_unique_id(spark):
    from usageloom.streaming import jdbc

    ran = []
    sink = jdbc.JdbcRawEventSink("jdbc:x", {}, execute=lambda *a: ran.append(a))
    texts = spark.createDataFrame([(message(at("00:00:10")),)] * 2, "value string")
    with pytest.raises(ValueError, match="unique id"):
        sink(messages.decode_events(texts), 0)
    assert ran == []


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/London", "+01:00", "EST"])
def test_a_session_in_another_zone_is_refused(spark, events, zone):
    log = events([(1, "a", "2024-01-01 00:00:00", "login", "free", None, "US")])
    texts = spark.createDataFrame([(message(at("00:00:10")),)], "value string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for send in (lambda: messages.encode_events(log), lambda: messages.decode_events(texts)):
            with pytest.raises(ValueError, match="time zone"):
                send()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "Etc/UTC", "GMT", "Z", "+00:00", "Zulu"])
def test_names_of_utc_are_one_zone(spark, zone):
    from usageloom.functions.session import require_utc

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_range_of_dates_lists_only_its_folders(spark, tmp_path):
    from datetime import date

    table = str(tmp_path / "raw")
    texts = [(message(f"2024-01-0{d}T00:00:10.000000+00:00", user=f"u{d}"),) for d in range(1, 6)]
    sinks.RawEventSink(table)(messages.decode_events(spark.createDataFrame([*texts, ("not json",)], "value string")), 0)

    def users(**bounds):
        log = event_log.read_event_log(spark, table, **bounds)
        return sorted(r["user_id"] for r in log.collect()), log.inputFiles()

    found, opened = users(since=date(2024, 1, 2), until=date(2024, 1, 3))
    assert found == ["u2", "u3"] and all("event_date=2024-01-02" in f or "event_date=2024-01-03" in f for f in opened)
    assert users(since=date(2024, 1, 5))[0] == ["u5"] and users(until=date(2023, 1, 1))[0] == []
    assert users()[0] == ["u1", "u2", "u3", "u4", "u5"]


def test_merged_sketches_stay_within_their_bound(spark):
    log = spark.range(0, 400_000, 1, 8).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 6)").alias("event_timestamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 60_000).cast("string")).alias("user_id"),
    )
    sketches = activity.user_sketches(log, width="1 hour")
    for grain, exact in (("day", activity.daily_active_users), ("week", activity.weekly_active_users), ("month", activity.monthly_active_users)):
        figures = {r[0]: r[1] for r in exact(log).collect()}
        estimates = {r["period_start"]: r["estimate"] for r in activity.active_users_estimated(sketches, grain).collect()}
        assert set(figures) == set(estimates)
        assert all(abs(estimates[p] - n) <= activity.SKETCH_BOUND * n for p, n in figures.items())


def test_inserts_need_what_has_no_default(spark):
    from usageloom.sources import tables

    with tables.scratch_database(spark) as database, pytest.raises(ValueError, match="plan_tier"):
        tables.insert(spark.range(1).select(F.lit("u").alias("user_id")), schemas.USER_METRICS, database)
    assert database not in [d.name for d in spark.catalog.listDatabases()]
