"""Every named query: ``(spark, sf_dir) -> DataFrame`` over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom import schemas
from usageloom.functions.latest import latest_rows_ranked
from usageloom.functions.lineage import shared_folder, stored_bytes, written
from usageloom.operators import (
    activity,
    adoption,
    features,
    funnel,
    quality,
    readonly,
    retention,
    rollups,
    trees,
    upgrade_model,
)
from usageloom.plans import feeds
from usageloom.plans.suite import suite_row_counts
from usageloom.sources import tables
from usageloom.sources.clickstream import raw_events
from usageloom.sources.event_log import read_event_log, read_quarantine, register_views
from usageloom.sources.messages import as_raw_events, decode_events, encode_events, read_event_stream
from usageloom.streaming import jobs, replay, sinks

Query = Callable[[SparkSession, str], DataFrame]

#: health figures are taken this long after the newest event
DELAY = "INTERVAL 1 HOUR"
#: dates a backfill is expected to span at least, and bytes of input for a file
DATES, FILE_BYTES = 28, 128 << 20


def _on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(raw_events(spark, sf_dir))


def _on_metrics(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(rollups.aggregated_metrics(raw_events(spark, sf_dir)))


def _on_labels(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """For what depends on counts and label only; unused counts are pruned."""
    return lambda spark, sf_dir: operator(features.user_counts(raw_events(spark, sf_dir)))


def _ingest_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """The metric rows, and ``DELAY`` after the newest event, of which each row knows its window's: one pass of the log."""
    metrics = rollups.aggregated_metrics(raw_events(spark, sf_dir), F.max("event_timestamp").alias("newest_event"))
    return metrics, (F.col("newest_event") + F.expr(DELAY)).cast("timestamp")


def ingest_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.heartbeat(*_ingest_state(spark, sf_dir))


def ingest_stalled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.stalled(*_ingest_state(spark, sf_dir))


def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted without the columns that have defaults, read back from the catalog's tables."""
    events = raw_events(spark, sf_dir)
    frames = [
        (schemas.RAW_EVENTS, events),
        (schemas.USER_METRICS, rollups.user_metrics(events)),
        (schemas.AGGREGATED_METRICS, rollups.aggregated_metrics(events)),
        (schemas.FEATURE_USAGE, adoption.feature_usage_windows(events)),
    ]
    counts = None
    with tables.scratch_database(spark) as database:
        tables.create_tables(spark, database, shared_folder(spark, "tables"))
        for table, frame in frames:
            tables.insert(frame.drop(*table.defaults), table, database)
            stored = spark.table(f"{database}.{table.name}")
            filled = [F.count(c) for c in table.defaults]
            total = F.sum("total_events") if "total_events" in table.defaults else F.lit(None).cast("bigint")
            count = stored.agg(
                F.lit(table.name).alias("table_name"), F.count("*").alias("n"),
                F.least(*filled, F.count("*")).alias("defaulted"), total.alias("default_total"),
            )
            counts = count if counts is None else counts.unionByName(count)
        # read before the names go
        return written(counts, "default-values")


# --- messages and data quality ---------------------------------------------


def events_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_events(raw_events(spark, sf_dir))
    return encoded.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def events_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_events(feeds.faulty_messages(spark, sf_dir))
    return decoded.select(
        F.col("offset").alias("id"),
        *[
            F.col(c).cast("timestamp_ntz").alias("event_timestamp") if c == "timestamp" else F.col(c)
            for c in schemas.MESSAGE_FIELDS
        ],
    )


def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.validate_messages(feeds.faulty_messages(spark, sf_dir))
    return checked.select(
        F.col("offset").alias("id"), "is_valid", F.array_join("reasons", "|").alias("reasons")
    )


def check_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = raw_events(spark, sf_dir)
    landed = as_raw_events(decode_events(feeds.faulty_messages(spark, sf_dir)))
    checks = [
        quality.check_constraints(landed, schemas.RAW_EVENTS),
        quality.check_constraints(rollups.user_metrics(events), schemas.USER_METRICS),
        quality.check_constraints(rollups.aggregated_metrics(events), schemas.AGGREGATED_METRICS),
        quality.check_constraints(adoption.feature_usage_windows(events), schemas.FEATURE_USAGE),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def category_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.category_distribution(
        raw_events(spark, sf_dir), {"event_type": quality.EVENT_TYPE_MIX, "plan_tier": quality.PLAN_TIER_MIX}
    )


def audit_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readonly.audit_queries(feeds.query_texts(spark, sf_dir))


def gated_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text sent through the gate: the rows it gives over the two views, or why it is refused."""
    views = {"raw_events": raw_events(spark, sf_dir), "user_metrics": rollups.user_metrics(raw_events(spark, sf_dir))}
    register_views(spark, views)
    answers = None
    for name, text in feeds.gated_texts(sf_dir).items():
        try:
            result, reason = readonly.run_readonly(spark, text, views), F.lit(None).cast("string")
        except readonly.NotReadOnly as refused:
            result, reason = None, F.lit(str(refused).partition(":")[0] if str(refused).startswith("outside") else str(refused))
        rows = spark.range(1).select(F.lit(None).cast("bigint").alias("n")) if result is None else result.agg(F.count("*").alias("n"))
        answer = rows.select(F.lit(name).alias("query"), reason.alias("refused"), F.col("n").alias("result_rows"))
        answers = answer if answers is None else answers.unionByName(answer)
    return answers


# --- streaming: one pass over the stream into a fresh folder -----------------


def _plain_time(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _streamed(
    spark: SparkSession, sf_dir: str, name: str, job: Callable[[DataFrame], DataFrame], mode: str
) -> str:
    folder = shared_folder(spark, name)
    decoded = decode_events(feeds.stream_messages(spark, sf_dir))
    jobs.run_once(job(decoded), sinks.ChangelogSink(f"{folder}/table"), f"{folder}/checkpoint", mode)
    return f"{folder}/table"


def events_per_minute_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _streamed(spark, sf_dir, "events-per-minute", jobs.window_counts, "update")
    metrics = rollups.metric_series(sinks.metrics_latest(spark, path))
    return _plain_time(metrics, "window_start", "window_end")


def kpi_overview_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _streamed(spark, sf_dir, "kpi", jobs.window_counts, "update")
    return rollups.kpi_overview(sinks.metrics_latest(spark, path))


def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reader's view after each of three batches was written twice and the first two were compacted.

    A batch holds the running counts of all events up to one third and two
    thirds of the time the log spans, and of the whole log, as update mode
    would emit them.
    """
    folder = shared_folder(spark, "upserts")
    sink = sinks.ChangelogSink(folder)
    events = raw_events(spark, sf_dir)
    first, last = F.min("event_timestamp"), F.max("event_timestamp")
    third = (last - first) / 3
    bounds = events.agg((first + third).alias("one"), (last - third).alias("two")).first()
    parts = [events.filter(F.col("event_timestamp") < F.lit(b)) for b in bounds] if bounds[0] else []
    for batch_id, upto in enumerate([*parts, events]):
        emitted = rollups.aggregated_metrics(upto).select(
            F.col("window_start").cast("timestamp").alias("window_start"),
            F.col("window_end").cast("timestamp").alias("window_end"),
            "metric_name",
            "metric_value",
        )
        sink(emitted, batch_id)
        sink(emitted, batch_id)
    sinks.compact(spark, folder, sinks.METRIC_ROW, schemas.AGGREGATED_METRICS.key)
    latest = sinks.metrics_latest(spark, folder).select(*schemas.AGGREGATED_METRICS.key, "metric_value")
    return _plain_time(latest, "window_start", "window_end")


def raw_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log and quarantine after streaming the damaged feed."""
    folder = shared_folder(spark, "raw-events")
    messages = feeds.with_faults(feeds.to_raw_events(feeds.stream_clicks(spark, sf_dir)))
    # a backfill of many dates at once: each date in as many files as its share of the input needs
    files = -(-stored_bytes(spark, f"{sf_dir}/events.parquet") // (DATES * FILE_BYTES))
    jobs.run_once(
        decode_events(messages), sinks.RawEventSink(f"{folder}/table", files_per_date=files), f"{folder}/checkpoint", "append"
    )
    columns = [c for c in schemas.RAW_EVENTS.schema.names if c != "ingested_at"]
    good = read_event_log(spark, f"{folder}/table").select(*columns, F.lit("").alias("reasons"))
    bad = read_quarantine(spark, f"{folder}/table").select(
        *columns, F.array_join("reasons", "|").alias("reasons")
    )
    return _plain_time(good.unionByName(bad), "event_timestamp")


def user_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _streamed(spark, sf_dir, "user-metrics", jobs.user_rollup, "update")
    rows = sinks.user_metrics_latest(spark, path).drop("updated_at")
    return _plain_time(rows, "first_seen", "last_seen")


def feature_usage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _streamed(spark, sf_dir, "feature-usage", jobs.feature_window_counts, "update")
    rows = sinks.feature_usage_latest(spark, path).drop("created_at", "updated_at")
    return _plain_time(rows, "window_start", "window_end")


def active_users_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, the open ones too: the stream keeps (window, user) pairs, the reader counts them."""
    path = _streamed(spark, sf_dir, "active-users", jobs.window_users, "update")
    return _plain_time(sinks.window_users_counted(spark, path), "window_start", "window_end")


#: how far behind the newest time a delayed message still counts, and the windows it is counted in
PATIENCE, BROAD = "2 days", "1 hour"


def _replayed(spark: SparkSession, sf_dir: str) -> replay.Replay:
    folder = shared_folder(spark, "replay")
    feed = replay.by_arrival(feeds.delayed_messages(spark, sf_dir), f"{folder}/feed")
    return replay.replay(feed, feeds.ARRIVALS, folder, PATIENCE, BROAD)


def late_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per hour what came in time, what came late and still counted, and what the watermark dropped."""
    replayed = _replayed(spark, sf_dir)
    counted = sinks.metrics_latest(spark, f"{replayed.output}/aggregated_metrics")
    return _plain_time(replay.lateness(replayed, counted, BROAD), "window_start", "window_end")


def watermark_progress_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per arrival the engine's own account: watermark, messages, and windows whose late messages it dropped."""
    return _plain_time(_replayed(spark, sf_dir).progress(spark), "watermark")


def standing_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both standing queries on their own trigger over the damaged feed: per minute what each of them stored."""
    folder = shared_folder(spark, "standing")
    feeds.faulty_messages(spark, sf_dir).write.parquet(f"{folder}/inbox")
    stream = read_event_stream(spark, "parquet", f"{folder}/inbox", replay.MESSAGE)
    queries = jobs.start_ingest(stream, f"{folder}/out", f"{folder}/checkpoints")
    jobs.drain(queries)
    minute = F.date_trunc("minute", "event_timestamp").alias("window_start")
    stored = (
        read_event_log(spark, f"{folder}/out/raw_events").select(minute, F.lit(1).alias("logged"), F.lit(0).alias("refused"))
        .unionByName(read_quarantine(spark, f"{folder}/out/raw_events").select(
            minute, F.lit(0).alias("logged"), F.lit(1).alias("refused")))
        .groupBy("window_start").agg(F.sum("logged").alias("logged"), F.sum("refused").alias("refused"))
    )
    counted = sinks.metrics_latest(spark, f"{folder}/out/aggregated_metrics").select("window_start", "metric_value")
    return _plain_time(stored.join(counted, "window_start", "left"), "window_start")


def active_users_closed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows the watermark has closed, each emitted once and for good."""
    path = _streamed(spark, sf_dir, "active-users-closed", jobs.active_users_exact, "append")
    rows = sinks.active_users_latest(spark, path).drop("created_at", "updated_at")
    return _plain_time(rows, "window_start", "window_end")


def active_users_sketch_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, weeks and months estimated from the minutes' sketches, judged by the exact figures."""
    path = _streamed(spark, sf_dir, "active-users-sketches", jobs.window_sketches, "update")
    sketches = written(sinks.window_sketches_latest(spark, path), "sketches")
    exact = {
        "day": activity.daily_active_users(raw_events(spark, sf_dir)),
        "week": activity.weekly_active_users(raw_events(spark, sf_dir)),
        "month": activity.monthly_active_users(raw_events(spark, sf_dir)),
    }
    result = None
    for grain, figures in exact.items():
        period, users = figures.columns
        judged = figures.select(F.col(period).alias("period_start"), F.col(users).alias("active_users")).join(
            activity.active_users_estimated(sketches, grain), "period_start", "left")
        away = F.abs(F.col("estimate") - F.col("active_users"))
        rows = judged.select(
            F.lit(grain).alias("grain"), "period_start", "active_users",
            F.coalesce(away <= activity.SKETCH_BOUND * F.col("active_users"), F.lit(False)).alias("within_bound"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


# --- upgrade prediction -------------------------------------------------------


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upgrade_model.classification_report(_rule_predictions(spark, sf_dir))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upgrade_model.confusion_matrix(_rule_predictions(spark, sf_dir))


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upgrade_model.headline_metrics(_rule_predictions(spark, sf_dir))


def _rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction any engine can repeat: users who log in more often than they log out convert."""
    rows = features.user_counts(raw_events(spark, sf_dir))
    guess = F.when(F.col("login_count") > F.col("logout_count"), 1).otherwise(0)
    return rows.select("user_id", F.col(features.LABEL).alias("label"), guess.alias("prediction"))


def _long(frame: DataFrame, vector: str, names: list[str]) -> DataFrame:
    values = vector_to_array(vector)
    cells = F.array(
        *[F.struct(F.lit(n).alias("feature"), values[i].alias("value")) for i, n in enumerate(names)]
    )
    return frame.select("user_id", F.explode(cells).alias("c")).select("user_id", "c.*")


def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read four times: by the indexer, for the first levels, and to be encoded
    encoded = upgrade_model.encode(written(features.user_features(raw_events(spark, sf_dir)), "features"))
    return _long(encoded, "x", upgrade_model.feature_names(encoded))


def _prepared(spark: SparkSession, sf_dir: str) -> upgrade_model.Prepared:
    return upgrade_model.prepare(features.user_features(raw_events(spark, sf_dir)))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scaled by the training rows, to six decimals."""
    data = _prepared(spark, sf_dir)
    scaled = upgrade_model.fit_scaler(data.train).transform(data.test)
    return _long(scaled, "x_scaled", data.names).withColumn("value", F.round("value", 6) + F.lit(0.0))


def logistic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    model = upgrade_model.train_logistic(data.train)
    return upgrade_model.classification_report(upgrade_model.predict(model, data.test))


def forest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    model = upgrade_model.train_forest(data.train)
    return upgrade_model.classification_report(upgrade_model.predict(model, data.test))


def forest_balanced_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    model = upgrade_model.train_forest(data.train, balanced=True)
    return upgrade_model.classification_report(upgrade_model.predict(model, data.test))


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Both engines' last digits differ; a zero has no sign."""
    return frame.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def logistic_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    model = upgrade_model.train_logistic(data.train)
    return _rounded(upgrade_model.coefficients(spark, model, data.names), 4, "coefficient")


def logistic_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted moments; their twin knows nothing of the fit, only labels and values."""
    data = _prepared(spark, sf_dir)
    model = upgrade_model.train_logistic(data.train)
    return _rounded(upgrade_model.fitted_moments(model, data.train, data.names), 4, "moment")


SPLIT_DIGITS = ("gain", "left_0", "left_1", "right_0", "right_1")


def _split_search(balanced: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = _prepared(spark, sf_dir)
        train = upgrade_model.balanced_weights(data.train) if balanced else data.train
        return _rounded(trees.best_split(train, data.names), 6, *SPLIT_DIGITS)

    return query


def _forest_stump(balanced: bool) -> Query:
    """The first split of the library's forest where nothing is left to chance."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = _prepared(spark, sf_dir)
        nodes = trees.node_table(trees.train_stump(data.train, data.names, balanced), spark)
        return _rounded(trees.root_split(nodes, data.names), 6, *SPLIT_DIGITS)

    return query


def stump_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    nodes = trees.node_table(trees.train_stump(data.train, data.names), spark)
    return _rounded(trees.node_importances(nodes, data.names), 6, "decrease", "importance")


def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _prepared(spark, sf_dir)
    model = upgrade_model.train_forest(data.train)
    return upgrade_model.feature_importances(spark, model, data.names)


QUERIES: dict[str, Query] = {
    "raw_events": raw_events,
    "dau": _on_events(activity.daily_active_users),
    "wau": _on_events(activity.weekly_active_users),
    "mau": _on_events(activity.monthly_active_users),
    "stickiness": _on_events(activity.stickiness),
    "feature_usage_share": _on_events(adoption.feature_usage_share),
    "feature_usage_by_tier": _on_events(adoption.feature_usage_by_tier),
    "feature_adoption": _on_events(adoption.feature_adoption),
    "conversion_funnel": _on_events(funnel.conversion_funnel),
    "conversion_by_tier": _on_events(funnel.conversion_by_tier),
    "idle_users_top20": _on_events(retention.idle_users),
    "recency_segments": _on_events(retention.recency_segments),
    "last_action_logout": _on_events(retention.last_action),
    "run_suite": lambda spark, sf_dir: suite_row_counts(raw_events(spark, sf_dir)),
    "newest_events": _on_events(lambda e: latest_rows_ranked(e, ["user_id"])),
    "user_metrics": _on_events(rollups.user_metrics),
    "feature_usage_windows": _on_events(adoption.feature_usage_windows),
    "active_users_per_minute": _on_events(activity.active_users_per_window),
    "events_per_minute": _on_metrics(rollups.metric_series),
    "kpi_overview": _on_metrics(rollups.kpi_overview),
    "ingest_heartbeat": ingest_heartbeat,
    "ingest_stalled": ingest_stalled,
    "events_keyed_json": events_keyed_json,
    "events_json_decode": events_json_decode,
    "validate_events": validate_events,
    "check_constraints": check_constraints,
    "default_values": default_values,
    "category_distribution": category_distribution,
    "audit_queries": audit_queries,
    "gated_queries": gated_queries,
    "events_per_minute_stream": events_per_minute_stream,
    "kpi_overview_stream": kpi_overview_stream,
    "upsert_metrics": upsert_metrics,
    "raw_events_stream": raw_events_stream,
    "user_metrics_stream": user_metrics_stream,
    "feature_usage_stream": feature_usage_stream,
    "active_users_stream": active_users_stream,
    "active_users_closed_stream": active_users_closed_stream,
    "active_users_sketch_stream": active_users_sketch_stream,
    "late_events_stream": late_events_stream,
    "watermark_progress_stream": watermark_progress_stream,
    "standing_ingest_stream": standing_ingest_stream,
    "user_features": _on_events(features.user_features),
    "user_features_leak_free": _on_events(lambda e: features.user_features(e, leak_free=True)),
    "label_balance": _on_labels(features.label_balance),
    "stratified_split": _on_labels(
        lambda users: features.stratified_split(users).select("user_id", features.LABEL, "split")
    ),
    "encoded_features": encoded_features,
    "scaled_features": scaled_features,
    "classification_report": classification_report,
    "classification_metrics": classification_metrics,
    "confusion_matrix": confusion_matrix,
    "logistic_report": logistic_report,
    "forest_report": forest_report,
    "forest_balanced_report": forest_balanced_report,
    "feature_importances": feature_importances,
    "logistic_coefficients": logistic_coefficients,
    "logistic_optimality": logistic_optimality,
    "gini_split": _split_search(balanced=False),
    "gini_split_balanced": _split_search(balanced=True),
    "forest_stump": _forest_stump(balanced=False),
    "forest_stump_balanced": _forest_stump(balanced=True),
    "stump_importances": stump_importances,
}
