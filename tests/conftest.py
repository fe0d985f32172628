import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from usageloom.functions.session import build_session

    session = build_session(
        "usageloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture
def events(spark):
    """Builds a small raw_events frame from (id, user, time, type, tier, feature, country) tuples."""
    from pyspark.sql import functions as F

    def build(rows):
        frame = spark.createDataFrame(
            [tuple(r) for r in rows],
            "id bigint, user_id string, at string, event_type string, plan_tier string,"
            " feature_name string, country string",
        )
        at = F.col("at").cast("timestamp_ntz")
        return frame.select(
            "id",
            "user_id",
            F.lit("s").alias("session_id"),
            at.alias("event_timestamp"),
            "event_type",
            "plan_tier",
            "feature_name",
            "country",
            at.alias("ingested_at"),
        )

    return build
