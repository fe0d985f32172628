"""Messages, the event contract, and table constraints."""

import json
import uuid
from datetime import datetime, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from usageloom import schemas
from usageloom.operators import quality
from usageloom.sources import messages

GOOD = {
    "user_id": "3f0d8f5e-0000-4000-8000-0123456789ab",
    "session_id": "9b2d8f5e-1111-4222-8333-0123456789ab",
    "timestamp": "2024-01-01T10:00:00.123456+00:00",
    "event_type": "feature_used",
    "plan_tier": "free",
    "feature_name": "bulk_import",
    "country": "US",
}


def framed(spark, texts):
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "n int, value string"
    ).withColumn("value", F.col("value").cast("binary"))


def judge(spark, texts):
    got = quality.validate_messages(framed(spark, texts)).orderBy("n").collect()
    return [list(r["reasons"]) for r in got]


def altered(**changes):
    return json.dumps({**GOOD, **changes})


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


def test_contract(spark):
    cases = [
        (json.dumps(GOOD), []),
        (altered(event_type="login", feature_name=None), []),
        (altered(timestamp="2024-01-01T10:00:00+00:00"), []),
        (altered(timestamp="2024-01-01T10:00:00.5Z"), []),
        (json.dumps({**GOOD, "extra": 1}), []),
        ("not json", ["payload_unreadable"]),
        (None, ["payload_unreadable"]),
        ("", ["payload_unreadable"]),
        ("[1, 2]", ["payload_unreadable"]),
        (altered(timestamp="yesterday"), ["timestamp_not_iso"]),
        (altered(timestamp="2024-01-01T10:00:00"), ["timestamp_not_iso"]),
        (altered(timestamp="2024-13-01T10:00:00+00:00"), ["timestamp_not_iso"]),
        (altered(timestamp=1704103200), ["timestamp_not_text", "timestamp_not_iso"]),
        (altered(user_id=123), ["user_id_not_text"]),
        (altered(user_id=12.5), ["user_id_not_text"]),
        (altered(user_id=True), ["user_id_not_text"]),
        (altered(user_id={"a": 1}), ["user_id_not_text"]),
        (altered(user_id=[1, "a"]), ["user_id_not_text"]),
        (altered(user_id=None), ["user_id_missing"]),
        (altered(user_id='{"a": 1}'), []),
        (altered(country={"code": "US"}), ["country_not_text", "country_unknown", "country_too_long"]),
        (altered(event_type="refund", feature_name=None), ["event_type_unknown"]),
        (altered(event_type=None, feature_name=None), ["event_type_unknown"]),
        (altered(plan_tier="gold"), ["plan_tier_unknown"]),
        (altered(plan_tier=5), ["plan_tier_not_text", "plan_tier_unknown"]),
        (altered(country=None), ["country_unknown"]),
        (altered(session_id=GOOD["session_id"].upper()), ["session_id_not_uuid"]),
        (altered(user_id=""), ["user_id_missing"]),
        (altered(event_type="login"), ["feature_name_unexpected"]),
        (altered(feature_name=None), ["feature_name_unknown"]),
        (altered(feature_name="teleport"), ["feature_name_unknown"]),
        (altered(user_id="x" * 37), ["user_id_too_long"]),
        (without("feature_name"), ["keys_missing", "feature_name_unknown"]),
        (without("country"), ["keys_missing", "country_unknown"]),
    ]
    got = judge(spark, [text for text, _ in cases])
    for (text, expected), found in zip(cases, got):
        assert found == expected, text


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "event_type": st.sampled_from(schemas.EVENT_TYPES),
                "plan_tier": st.sampled_from(schemas.PLAN_TIERS),
                "feature_name": st.none() | st.sampled_from(schemas.FEATURE_NAMES),
                "country": st.sampled_from(schemas.COUNTRIES),
                "session_id": st.uuids().map(str),
                "timestamp": st.datetimes(
                    datetime(1990, 1, 1), datetime(2090, 1, 1), timezones=st.just(timezone.utc)
                ).map(lambda t: t.isoformat()),
            }
        ),
        min_size=1,
        max_size=30,
    )
)
def test_feature_name_belongs_to_feature_events_only(spark, drawn):
    texts = [json.dumps({**GOOD, **d, "user_id": str(uuid.UUID(int=i))}) for i, d in enumerate(drawn)]
    for d, reasons in zip(drawn, judge(spark, texts)):
        fits = (d["event_type"] == "feature_used") == (d["feature_name"] is not None)
        assert (reasons == []) == fits


def test_round_trip_keeps_every_field(spark, events):
    log = events(
        [
            (1, "a", "2024-01-01 00:00:10.123456", "feature_used", "free", "bulk_import", "US"),
            (2, 'quote " and \\ and ü', "2024-01-01 00:00:00", "login", "pro", None, None),
        ]
    )
    encoded = messages.encode_events(log)
    assert dict(encoded.dtypes) == {"key": "binary", "value": "binary"}
    texts = sorted(json.loads(bytes(r["value"])) ["timestamp"] for r in encoded.collect())
    assert texts == ["2024-01-01T00:00:00.000000+00:00", "2024-01-01T00:00:10.123456+00:00"]
    for r in encoded.collect():
        assert set(json.loads(bytes(r["value"]))) == set(schemas.MESSAGE_FIELDS)
        assert json.loads(bytes(r["value"]))["user_id"] == bytes(r["key"]).decode()
    back = messages.decode_events(encoded).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    sent = log.withColumnRenamed("event_timestamp", "timestamp").select(*schemas.MESSAGE_FIELDS)
    assert sorted(map(str, back.select(*schemas.MESSAGE_FIELDS).collect())) == sorted(map(str, sent.collect()))


def test_decoding_never_fails(spark):
    texts = ["not json", None, altered(timestamp="yesterday"), '{"user_id": {"a": 1}}', "{", "[]"]
    got = messages.decode_events(framed(spark, texts)).collect()
    assert len(got) == len(texts)
    assert got[2]["timestamp"] is None and got[2]["user_id"] == GOOD["user_id"]
    assert all(got[i]["event_type"] is None for i in (0, 1, 4, 5))


def test_event_ids_survive_a_retry(spark):
    frame = framed(spark, [json.dumps(GOOD), json.dumps(GOOD), altered(country="DE")])
    first = [r["id"] for r in messages.as_raw_events(messages.decode_events(frame)).collect()]
    again = [r["id"] for r in messages.as_raw_events(messages.decode_events(frame)).collect()]
    assert first == again and first[0] == first[1] != first[2]
    placed = frame.withColumn("partition", F.lit(3)).withColumn("offset", F.col("n").cast("bigint"))
    ids = [r["id"] for r in messages.as_raw_events(messages.decode_events(placed)).collect()]
    assert ids == [(3 << 48) + n for n in range(3)]


def test_kafka_options():
    source = messages.kafka_source_options("b:9092", "user-events")
    assert source == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "user-events", "startingOffsets": "latest",
    }
    assert messages.kafka_source_options("b", "t", "earliest")["startingOffsets"] == "earliest"
    sink = messages.kafka_sink_options("b:9092", "user-events")
    assert sink["kafka.acks"] == "all" and sink["kafka.retries"] == "5" and sink["topic"] == "user-events"


def test_constraints_count_violations(spark):
    frame = spark.createDataFrame(
        [
            ("2024-01-01 00:00:00", "2024-01-01 00:01:00", "m", 1.0, "2024-01-01 00:00:00"),
            ("2024-01-01 00:00:00", "2024-01-01 00:01:00", "m", 2.0, "2024-01-01 00:00:00"),
            ("2024-01-01 00:01:00", "2024-01-01 00:02:00", "x" * 101, None, "2024-01-01 00:00:00"),
            ("2024-01-01 00:02:00", None, "m", 1.0, None),
        ],
        "window_start string, window_end string, metric_name string, metric_value double, created_at string",
    )
    got = {r["rule"]: r["violations"] for r in
           quality.check_constraints(frame, schemas.AGGREGATED_METRICS).collect()}
    assert got["unique(window_start,window_end,metric_name)"] == 1
    assert got["not_null(metric_value)"] == 1 and got["not_null(window_end)"] == 1
    assert got["not_null(created_at)"] == 1 and got["not_null(window_start)"] == 0
    assert got["max_length(metric_name)"] == 1


def test_constraints_read_the_frame_once(spark, events):
    log = events([(1, "a", "2024-01-01 00:00:00", "login", "free", None, "US")])
    plan = quality.check_constraints(log, schemas.RAW_EVENTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1, plan


def test_every_table_of_the_constraint_query_is_one_scan(spark):
    from usageloom.plans.registry import QUERIES

    plan = QUERIES["check_constraints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(schemas.TABLES)
    assert plan.count("from_json") + plan.count("jsontostructs") <= 1
