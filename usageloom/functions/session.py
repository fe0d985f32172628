"""Session settings the engine relies on, as plain options to merge into a deployment's own."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # calendar days and JSON timestamps are UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # per-user streaming rollups keep state that grows with the user base
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "usageloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Refuses a session whose zone would shift times between their stored and their sent form."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    time = spark._jvm.java.time
    rules = time.ZoneId.of(zone, time.ZoneId.SHORT_IDS).getRules()
    if not rules.isFixedOffset() or rules.getOffset(time.Instant.EPOCH).getTotalSeconds():
        raise ValueError(f"the session's time zone is {zone}; set spark.sql.session.timeZone to UTC")
