"""DuckDB texts that compute the registered queries independently of Spark, for checking.

They follow the plain definitions (sub-selects, rankings, cross joins) rather
than the plans Spark is given.
"""

from __future__ import annotations

from usageloom import schemas


def _names(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


RAW_EVENTS = f"""
clicks AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, md5(CAST(event_id AS VARCHAR)) AS h
  FROM events
),
shaped AS (
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS user_id,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
         substr(h, 17, 4) || '-' || substr(h, 21, 12) AS session_id,
         ts AS event_timestamp,
         CASE event_type
           WHEN 'click' THEN 'feature_used'
           WHEN 'view' THEN 'login'
           WHEN 'error' THEN 'logout'
           WHEN 'signup' THEN CASE WHEN k < 10 THEN 'signup' ELSE 'login' END
           WHEN 'purchase' THEN CASE WHEN value >= 190 THEN 'upgrade'
                                     WHEN value >= 150 THEN 'purchase' ELSE 'feature_used' END
         END AS event_type,
         CASE WHEN k < 60 THEN 'free' WHEN k < 80 THEN 'basic' WHEN k < 95 THEN 'pro'
              ELSE 'enterprise' END AS plan_tier
  FROM clicks
),
raw_events AS (
  SELECT *,
         CASE WHEN event_type = 'feature_used'
              THEN ([{_names(schemas.FEATURE_NAMES)}])[id % 8 + 1] END AS feature_name,
         ([{_names(schemas.COUNTRIES)}])[id % 10 + 1] AS country,
         event_timestamp AS ingested_at
  FROM shaped
)"""

METRICS = f"""{RAW_EVENTS},
aggregated_metrics AS (
  SELECT date_trunc('minute', event_timestamp) AS window_start,
         date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS window_end,
         'events_per_minute' AS metric_name,
         CAST(count(*) AS DOUBLE) AS metric_value,
         min(ingested_at) AS created_at
  FROM raw_events GROUP BY ALL
)"""

ORDERED = "ORDER BY event_timestamp DESC, id DESC"

LAST_SEEN = f"""{RAW_EVENTS},
idle AS (
  SELECT user_id, event_timestamp AS last_event_at,
         CAST(epoch_us(max(event_timestamp) OVER ()) - epoch_us(event_timestamp) AS DOUBLE) / 60000000.0
           AS minutes_since_last_seen
  FROM raw_events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, id DESC) = 1
)"""


def _pct(parts: str, whole: str, scale: int = 20000, divisor: float = 100.0) -> str:
    base = f"nullif(CAST({whole} AS BIGINT), 0)"
    return f"(({scale} * CAST({parts} AS BIGINT) + {base}) // (2 * {base})) / {divisor}"


def _features(total: str) -> str:
    newest = "(event_timestamp, id)"
    return f"""{RAW_EVENTS},
user_features AS (
  SELECT user_id,
         {total} AS total_events,
         count(DISTINCT feature_name) AS distinct_features,
         count(*) FILTER (WHERE event_type = 'login') AS login_count,
         count(*) FILTER (WHERE event_type = 'logout') AS logout_count,
         count(*) FILTER (WHERE event_type = 'feature_used') AS feature_used_count,
         arg_max(plan_tier, {newest}) AS plan_tier,
         arg_max(country, {newest}) AS country,
         CAST(bool_or(event_type IN ('upgrade', 'purchase')) AS INTEGER) AS upgraded
  FROM raw_events GROUP BY user_id
)"""


FEATURES = _features("count(*)")
LEAK_FREE = _features("count(*) FILTER (WHERE event_type NOT IN ('upgrade', 'purchase'))")

SPLIT = f"""{FEATURES},
sizes AS (
  SELECT upgraded, n, total - CAST(ceil(total * 0.25) AS BIGINT) AS train_total, total
  FROM (SELECT upgraded, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
        FROM user_features GROUP BY upgraded)
),
floors AS (
  SELECT *, n * train_total // total AS base, n * train_total % total AS remainder FROM sizes
),
shares AS (
  SELECT upgraded, n - base - CASE WHEN row_number() OVER (ORDER BY remainder DESC, upgraded)
                                        <= train_total - sum(base) OVER () THEN 1 ELSE 0 END AS n_test
  FROM floors
),
ranked AS (
  SELECT f.*, row_number() OVER (PARTITION BY f.upgraded ORDER BY md5(user_id || '-42'), user_id) AS r, n_test
  FROM user_features f JOIN shares s ON s.upgraded = f.upgraded
),
split_features AS (SELECT *, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split FROM ranked)"""

NUMERIC = ("total_events", "distinct_features", "login_count", "logout_count", "feature_used_count")


def _encoded(source: str) -> str:
    numeric = "\n  UNION ALL ".join(
        f"SELECT user_id, split, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in NUMERIC
    )
    levels = "\n  UNION ALL ".join(
        f"""SELECT user_id, split, '{c}_' || level AS feature,
           CASE WHEN {c} = level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
    FROM {source}, (SELECT DISTINCT {c} AS level FROM {source}
                    WHERE {c} > (SELECT min({c}) FROM {source})) l"""
        for c in ("plan_tier", "country")
    )
    return f"encoded AS ({numeric}\n  UNION ALL {levels})"


# Scaled training and test rows as vectors, in the order of feature names, with a one for the intercept.
VECTORS = f"""{SPLIT}, {_encoded('split_features')},
moments AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS deviation
            FROM encoded WHERE split = 'train' GROUP BY feature),
scaled AS (
  SELECT e.user_id, e.split, e.feature, CASE WHEN deviation = 0 THEN 0 ELSE (value - mean) / deviation END AS z
  FROM encoded e JOIN moments m ON m.feature = e.feature
),
vectors AS (
  SELECT user_id, any_value(split) AS split, list_append(list(z ORDER BY feature), 1.0::DOUBLE) AS v
  FROM scaled GROUP BY user_id
),
labelled AS (SELECT x.split, x.v, f.upgraded AS y FROM vectors x JOIN user_features f ON f.user_id = x.user_id),
train AS (SELECT v, y FROM labelled WHERE split = 'train'),
size AS (SELECT len(any_value(v)) AS d FROM train),
axes AS (SELECT unnest(range(1, d + 1))::INTEGER AS j FROM size),
names AS (
  SELECT (row_number() OVER (ORDER BY feature))::INTEGER AS j, feature FROM moments
  UNION ALL SELECT d, '(intercept)' FROM size
)"""

# Newton steps with the Hessian's upper bound X'X / 4 + penalty, whose inverse is made once by elimination:
# each step lowers the loss, and the steps end where the gradient does.
LOGISTIC = f"""{VECTORS},
curvature AS (
  SELECT a.j AS i, b.j AS j, sum(v[a.j] * v[b.j]) / 4 + CASE WHEN a.j = b.j AND a.j < (SELECT d FROM size) THEN 1 ELSE 0 END AS c
  FROM train, axes a, axes b GROUP BY a.j, b.j
),
lines AS (
  SELECT i, list_concat(list(c ORDER BY j), list(CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ORDER BY j)) AS line
  FROM curvature GROUP BY i
),
eliminated(k, m) AS (
  SELECT 1, list(line ORDER BY i) FROM lines
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN p ELSE list_transform(r, lambda x, j: x - r[k] * p[j]) END)
  FROM (SELECT k, m, list_transform(m[k], lambda x: x / m[k][k]) AS p FROM eliminated WHERE k <= (SELECT d FROM size))
),
inverse AS (
  SELECT list_transform(m, lambda r: r[d + 1:]) AS b FROM eliminated, size WHERE k = d + 1
),
steps(n, w) AS (
  SELECT 0, list_transform(range(d), lambda x: 0.0::DOUBLE) FROM size
  UNION ALL
  SELECT n + 1, list_transform(w, lambda x, j: x + list_dot_product(b[j], g))
  FROM (
    SELECT n, any_value(w) AS w, list(slope - CASE WHEN j < len(w) THEN w[j] ELSE 0 END ORDER BY j) AS g
    FROM (
      SELECT n, j, any_value(w) AS w, sum((y - 1 / (1 + exp(-list_dot_product(w, v)))) * v[j]) AS slope
      FROM steps, train, axes WHERE n < 300 GROUP BY n, j
    ) GROUP BY n
  ), inverse
),
optimum AS (SELECT w FROM steps WHERE n = 300)"""

def _split_search(weight: str) -> str:
    running = ", ".join(
        f"sum({c}) OVER (PARTITION BY feature ORDER BY value) AS {c}_l, sum({c}) OVER (PARTITION BY feature) AS {c}_a"
        for c in ("n", "zero", "one")
    )
    gini = "(1 - ({0} / ({0} + {1})) ** 2 - ({1} / ({0} + {1})) ** 2)".format
    return f"""{SPLIT}, {_encoded('split_features')},
training AS (
  SELECT e.feature, e.value, f.upgraded AS y, {weight} AS w
  FROM encoded e JOIN split_features f ON f.user_id = e.user_id WHERE f.split = 'train'
),
cells AS (
  SELECT feature, value, count(*) AS n, coalesce(sum(w) FILTER (WHERE y = 0), 0) AS zero, coalesce(sum(w) FILTER (WHERE y = 1), 0) AS one
  FROM training GROUP BY feature, value
),
sides AS (
  SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS following, {running} FROM cells
),
gains AS (
  SELECT feature, (value + following) / 2 AS threshold, n_l AS left_rows, n_a - n_l AS right_rows,
         zero_l AS left_0, one_l AS left_1, zero_a - zero_l AS right_0, one_a - one_l AS right_1,
         {gini('zero_a', 'one_a')}
           - (zero_l + one_l) / (zero_a + one_a) * {gini('zero_l', 'one_l')}
           - (zero_a - zero_l + one_a - one_l) / (zero_a + one_a) * {gini('(zero_a - zero_l)', '(one_a - one_l)')} AS gain
  FROM sides WHERE following IS NOT NULL
),
best AS (
  SELECT * FROM gains
  ORDER BY round(gain, 12) DESC, coalesce(list_position([{_names(NUMERIC)}], feature), 99),
           feature NOT LIKE 'plan_tier%', feature DESC, threshold LIMIT 1
)"""


_DOUBLES = ", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in ("gain", "left_0", "left_1", "right_0", "right_1"))
_BEST = f"SELECT feature, threshold, CAST(left_rows AS BIGINT) AS left_rows, CAST(right_rows AS BIGINT) AS right_rows, {_DOUBLES} FROM best"
PLAIN_SPLIT = f"WITH {_split_search('1.0::DOUBLE')} {_BEST}"
BALANCED_SPLIT = "WITH " + _split_search(
    "(SELECT count(*) FROM split_features WHERE split = 'train')::DOUBLE"
    " / (2 * (SELECT count(*) FROM split_features g WHERE g.split = 'train' AND g.upgraded = f.upgraded))"
) + " " + _BEST

RULE_PREDICTIONS = f"""{FEATURES},
predictions AS (
  SELECT user_id, upgraded AS label, CASE WHEN login_count > logout_count THEN 1 ELSE 0 END AS prediction
  FROM user_features
)"""

# The damaged feed, field by field, before it becomes JSON.
FEED = f"""{RAW_EVENTS},
damaged AS (
  SELECT id, kind,
         CASE kind WHEN 11 THEN '' ELSE user_id END AS user_id,
         CASE kind WHEN 7 THEN upper(session_id) ELSE session_id END AS session_id,
         CASE kind WHEN 2 THEN 'yesterday' WHEN 9 THEN stamp ELSE stamp || '+00:00' END AS stamp_text,
         CASE kind WHEN 2 THEN NULL ELSE event_timestamp END AS event_timestamp,
         CASE kind WHEN 3 THEN 'refund' ELSE event_type END AS event_type,
         CASE kind WHEN 4 THEN 'gold' ELSE plan_tier END AS plan_tier,
         CASE kind WHEN 5 THEN 'dashboard_view' WHEN 6 THEN NULL ELSE feature_name END AS feature_name,
         CASE kind WHEN 8 THEN NULL WHEN 10 THEN 'far-away-country'
                   WHEN 14 THEN '{{"code":"' || country || '"}}' ELSE country END AS country,
         unnest(CASE kind WHEN 12 THEN [1, 2] ELSE [1] END) AS delivery
  FROM (SELECT *, id % 16 AS kind, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS stamp FROM raw_events)
),
decoded AS (
  SELECT id, kind, delivery,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE user_id END AS user_id,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE session_id END AS session_id,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE event_timestamp END AS event_timestamp,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE event_type END AS event_type,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE plan_tier END AS plan_tier,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE feature_name END AS feature_name,
         CASE WHEN kind IN (0, 1) THEN NULL ELSE country END AS country
  FROM damaged
)"""


# The delayed feed with the watermark each arrival is judged by, arrival after arrival.
DELAYED = f"""{RAW_EVENTS},
sent AS (
  SELECT event_timestamp,
         least((epoch_us(event_timestamp) - min(epoch_us(event_timestamp)) OVER ()) * 4
               // (max(epoch_us(event_timestamp)) OVER () - min(epoch_us(event_timestamp)) OVER () + 1)
               + CASE WHEN id % 50 = 7 THEN 2 WHEN id % 10 = 3 THEN 1 ELSE 0 END, 3)::INTEGER AS arrival
  FROM raw_events
),
arrivals AS (
  SELECT arrival, count(event_timestamp) AS messages, max(event_timestamp) AS newest
  FROM range(4) t(arrival) LEFT JOIN sent USING (arrival) GROUP BY arrival
),
marks AS (
  SELECT arrival::INTEGER AS arrival, messages,
         date_trunc('millisecond', max(newest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
           - INTERVAL 2 DAY AS watermark
  FROM arrivals
),
judged AS (
  SELECT s.*, watermark, date_trunc('hour', event_timestamp) AS window_start,
         coalesce(event_timestamp < watermark, false) AS late,
         coalesce(date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <= watermark, false) AS gone
  FROM sent s JOIN marks USING (arrival)
)"""


def _joined(rules: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in rules)
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), '|')"


CONTRACT = _joined(
    [
        ("keys_missing", "kind = 8"),
        ("user_id_not_text", "kind = 13"),
        ("country_not_text", "kind = 14"),
        ("user_id_missing", "coalesce(length(user_id), 0) = 0"),
        (
            "session_id_not_uuid",
            "NOT regexp_full_match(session_id, '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')",
        ),
        (
            "timestamp_not_iso",
            r"NOT regexp_full_match(stamp_text, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})')"
            " OR try_cast(stamp_text AS TIMESTAMPTZ) IS NULL",
        ),
        ("event_type_unknown", f"event_type NOT IN ({_names(schemas.EVENT_TYPES)})"),
        ("plan_tier_unknown", f"plan_tier NOT IN ({_names(schemas.PLAN_TIERS)})"),
        ("country_unknown", f"country IS NULL OR country NOT IN ({_names(schemas.COUNTRIES)})"),
        ("feature_name_unexpected", "event_type <> 'feature_used' AND feature_name IS NOT NULL"),
        (
            "feature_name_unknown",
            "event_type = 'feature_used' AND (feature_name IS NULL OR feature_name NOT IN"
            f" ({_names(schemas.FEATURE_NAMES)}))",
        ),
        *[(f"{c}_too_long", f"length({c}) > {n}") for c, n in schemas.RAW_EVENTS.max_length.items()],
    ]
)

_DECODED = [f for f in ("user_id", "session_id", "event_timestamp", "event_type", "plan_tier")]
STORAGE = _joined(
    [(f"{c}_missing", f"{c} IS NULL") for c in _DECODED]
    + [(f"{c}_too_long", f"length({c}) > {n}") for c, n in schemas.RAW_EVENTS.max_length.items()]
)


def _constraints(table: schemas.Table, source: str) -> str:
    parts = [
        f"SELECT '{table.name}' AS table_name, 'not_null({c})' AS rule,"
        f" count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {source}"
        for c in table.required
        if c not in ("updated_at",) and not (source == "feature_usage" and c == "created_at")
    ]
    parts += [
        f"SELECT '{table.name}', 'max_length({c})', count(*) FILTER (WHERE length({c}) > {n}) FROM {source}"
        for c, n in table.max_length.items()
    ]
    keys = ", ".join(table.key)
    parts.append(
        f"SELECT '{table.name}', 'unique({','.join(table.key)})', count(*) FROM"
        f" (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )
    return "\nUNION ALL ".join(parts)


def _distribution(column: str, names: tuple[str, ...], weights: tuple[int, ...]) -> str:
    rows = ", ".join(f"('{n}', {w})" for n, w in zip(names, weights))
    share = _pct("coalesce(n, 0)", "(SELECT count(*) FROM raw_events)")
    expected = _pct("coalesce(weight, 0)", str(sum(weights)))
    return f"""SELECT '{column}' AS column_name, coalesce(c.category, w.category) AS category,
  coalesce(n, 0) AS n, {share} AS share_pct, {expected} AS expected_pct, {share} - {expected} AS diff_pct
FROM (SELECT {column} AS category, count(*) AS n FROM raw_events GROUP BY {column}) c
FULL JOIN (VALUES {rows}) w(category, weight) ON w.category = c.category"""


_SPACE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _word(words: str) -> str:
    return rf"regexp_matches(upper(cleaned_sql), '(^|[^\p{{L}}\p{{N}}_])({words})($|[^\p{{L}}\p{{N}}_])')"


_FORBIDDEN = ("INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "TRUNCATE",
              "GRANT", "REVOKE", "CREATE", "EXECUTE", "CALL", "COPY")  # fixed values

USER_METRICS = f"""user_metrics AS (
  SELECT user_id, arg_max(plan_tier, (event_timestamp, id)) AS plan_tier,
         arg_max(country, (event_timestamp, id)) AS country, count(*) AS total_events,
         min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
  FROM raw_events GROUP BY user_id
)"""

FEATURE_USAGE = """feature_usage AS (
  SELECT date_trunc('minute', event_timestamp) AS window_start,
         date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS window_end,
         feature_name, count(*) AS usage_count
  FROM raw_events WHERE event_type = 'feature_used' AND feature_name IS NOT NULL GROUP BY ALL
)"""

ACTIVE_PER_MINUTE = """SELECT date_trunc('minute', event_timestamp) AS window_start,
         date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS window_end,
         count(DISTINCT user_id) AS active_users
  FROM raw_events GROUP BY ALL"""

_FEATURE_EVENTS = "event_type = 'feature_used' AND feature_name IS NOT NULL"

KPI = {
    "dau": f"""WITH {RAW_EVENTS}
SELECT CAST(event_timestamp AS DATE) AS activity_date, count(DISTINCT user_id) AS dau
FROM raw_events GROUP BY 1 ORDER BY 1""",
    "wau": f"""WITH {RAW_EVENTS}
SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start, count(DISTINCT user_id) AS wau
FROM raw_events GROUP BY 1 ORDER BY 1""",
    "mau": f"""WITH {RAW_EVENTS}
SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS month_start, count(DISTINCT user_id) AS mau
FROM raw_events GROUP BY 1 ORDER BY 1""",
    "stickiness": f"""WITH {RAW_EVENTS},
aged AS (
  SELECT user_id, event_timestamp AS seen, max(event_timestamp) OVER () AS newest FROM raw_events
),
actives AS (
  SELECT count(DISTINCT user_id) FILTER (WHERE CAST(seen AS DATE) = CAST(newest AS DATE)) AS dau_count,
         count(DISTINCT user_id) FILTER (WHERE date_trunc('month', seen) = date_trunc('month', newest)) AS mau_count
  FROM aged
)
SELECT dau_count, mau_count, {_pct('dau_count', 'mau_count', 2000, 1000.0)} AS dau_mau_ratio FROM actives""",
    "feature_usage_share": f"""WITH {RAW_EVENTS}
SELECT feature_name, count(*) AS usage_count,
       {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_all_feature_events
FROM raw_events WHERE {_FEATURE_EVENTS} GROUP BY feature_name""",
    "feature_usage_by_tier": f"""WITH {RAW_EVENTS}
SELECT plan_tier, feature_name, count(*) AS usage_count
FROM raw_events WHERE {_FEATURE_EVENTS} GROUP BY plan_tier, feature_name""",
    "feature_adoption": f"""WITH {RAW_EVENTS}
SELECT feature_name, count(DISTINCT user_id) AS unique_users, count(*) AS total_uses,
       {_pct('count(*)', 'count(DISTINCT user_id)', 200)} AS avg_uses_per_user
FROM raw_events WHERE {_FEATURE_EVENTS} GROUP BY feature_name""",
    "conversion_funnel": f"""WITH {RAW_EVENTS},
flags AS (
  SELECT bool_or(event_type = 'signup') AS signed, bool_or(event_type = 'feature_used') AS used,
         bool_or(event_type IN ('purchase', 'upgrade')) AS converted
  FROM raw_events GROUP BY user_id
),
stages AS (SELECT count_if(signed) AS a, count_if(used) AS b, count_if(converted) AS c FROM flags)
SELECT CAST(a AS BIGINT) AS stage_1_signups, CAST(b AS BIGINT) AS stage_2_used_feature, CAST(c AS BIGINT) AS stage_3_converted,
       {_pct('b', 'a')} AS pct_signup_to_feature_use, {_pct('c', 'b')} AS pct_feature_use_to_conversion
FROM stages""",
    "conversion_by_tier": f"""WITH {RAW_EVENTS},
users AS (
  SELECT arg_max(plan_tier, (event_timestamp, id)) AS plan_tier,
         bool_or(event_type IN ('purchase', 'upgrade')) AS converted
  FROM raw_events GROUP BY user_id
)
SELECT plan_tier, count(*) AS total_users, count(*) FILTER (WHERE converted) AS converted_users,
       {_pct('count(*) FILTER (WHERE converted)', 'count(*)')} AS conversion_rate_pct
FROM users GROUP BY plan_tier""",
    "idle_users_top20": f"""WITH {LAST_SEEN}
SELECT * FROM idle ORDER BY minutes_since_last_seen DESC, user_id LIMIT 20""",
    "recency_segments": f"""WITH {LAST_SEEN}
SELECT CASE WHEN minutes_since_last_seen < 30 THEN 'active (< 30 min)'
            WHEN minutes_since_last_seen < 120 THEN 'cooling (30-120 min)'
            ELSE 'churned (> 120 min)' END AS recency_segment, count(*) AS user_count
FROM idle GROUP BY 1""",
    "last_action_logout": f"""WITH {RAW_EVENTS}
SELECT CAST(count_if(newest = 'logout') AS BIGINT) AS users_whose_last_action_was_logout
FROM (SELECT arg_max(event_type, (event_timestamp, id)) AS newest FROM raw_events GROUP BY user_id)""",
}

_REPORT = """counts AS (
  SELECT v AS class, count(*) FILTER (WHERE label = v) AS support,
         CAST(count(*) FILTER (WHERE label = v AND prediction = v) AS DOUBLE) AS hits,
         count(*) FILTER (WHERE prediction = v) AS guessed
  FROM predictions, (VALUES (0), (1)) k(v)
  GROUP BY v HAVING count(*) FILTER (WHERE label = v OR prediction = v) > 0
),
scores AS (
  SELECT class, support, hits, coalesce(hits / nullif(guessed, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r,
         coalesce(2 * hits / nullif(guessed + support, 0), 0) AS f
  FROM counts
)
SELECT CAST(class AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, support FROM scores
UNION ALL
SELECT 'accuracy', a, a, a, n FROM (SELECT sum(hits) / sum(support) AS a, CAST(sum(support) AS BIGINT) AS n FROM scores)
UNION ALL
SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL
SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
       sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM scores"""

_KPI_OVERVIEW = f"""WITH {METRICS}
SELECT CAST(sum(metric_value) AS BIGINT) AS total_events,
       CAST(arg_max(metric_value, window_start) AS BIGINT) AS latest_window_events,
       avg(metric_value) AS avg_events_per_minute
FROM aggregated_metrics"""
_SERIES = f"""WITH {METRICS}
SELECT window_start, window_end, metric_name, metric_value FROM aggregated_metrics"""
_HEARTBEAT = (
    "CAST(epoch_us((SELECT max(event_timestamp) FROM raw_events) + INTERVAL 1 HOUR)"
    " - epoch_us(max(created_at)) AS DOUBLE) / 1000000.0"
)

TWINS: dict[str, str] = {
    "raw_events": f"WITH {RAW_EVENTS} SELECT * FROM raw_events",
    **KPI,
    "run_suite": "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS statement, count(*) AS result_rows FROM ({sql})"
        for i, (name, sql) in enumerate(KPI.items(), start=1)
    ),
    "user_metrics": f"WITH {RAW_EVENTS}, {USER_METRICS} SELECT * FROM user_metrics",
    "user_metrics_stream": f"""WITH {RAW_EVENTS}, {USER_METRICS} SELECT * FROM user_metrics""",
    "feature_usage_windows": f"WITH {RAW_EVENTS}, {FEATURE_USAGE} SELECT * FROM feature_usage",
    "feature_usage_stream": f"WITH {RAW_EVENTS}, {FEATURE_USAGE} SELECT * FROM feature_usage",
    "active_users_per_minute": f"WITH {RAW_EVENTS} {ACTIVE_PER_MINUTE}",
    "active_users_stream": f"WITH {RAW_EVENTS} {ACTIVE_PER_MINUTE}",
    "events_per_minute": _SERIES,
    "events_per_minute_stream": _SERIES,
    "upsert_metrics": _SERIES,
    "kpi_overview": _KPI_OVERVIEW,
    "kpi_overview_stream": _KPI_OVERVIEW,
    "ingest_heartbeat": f"""WITH {METRICS}
SELECT {_HEARTBEAT} AS seconds_since_update FROM aggregated_metrics""",
    "ingest_stalled": f"""WITH {METRICS}
SELECT {_HEARTBEAT} > 120 AS is_stalled FROM aggregated_metrics""",
    "events_keyed_json": f"""WITH {RAW_EVENTS}
SELECT user_id AS key,
       '{{"user_id":"' || user_id || '","session_id":"' || session_id || '","timestamp":"' ||
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","event_type":"' || event_type ||
       '","plan_tier":"' || plan_tier || '","feature_name":' || coalesce('"' || feature_name || '"', 'null') ||
       ',"country":"' || country || '"}}' AS value
FROM raw_events""",
    "events_json_decode": f"WITH {FEED} SELECT * EXCLUDE (kind, delivery) FROM decoded",
    "validate_events": f"""WITH {FEED},
judged AS (
  SELECT id, CASE WHEN kind IN (0, 1) THEN 'payload_unreadable' ELSE {CONTRACT} END AS reasons FROM damaged
)
SELECT id, reasons = '' AS is_valid, reasons FROM judged""",
    "raw_events_stream": f"""WITH {FEED}
SELECT id, user_id, session_id, event_timestamp, event_type, plan_tier, feature_name, country,
       {STORAGE} AS reasons FROM decoded""",
    "newest_events": f"""WITH {RAW_EVENTS}
SELECT DISTINCT ON (user_id) * FROM raw_events ORDER BY user_id, event_timestamp DESC, id DESC""",
    "active_users_closed_stream": f"""WITH {RAW_EVENTS}
SELECT * FROM ({ACTIVE_PER_MINUTE})
WHERE window_end <= (SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL 1 MINUTE FROM raw_events)""",
    "active_users_sketch_stream": "WITH " + RAW_EVENTS + "\nUNION ALL ".join(
        f" SELECT '{g}' AS grain, CAST(date_trunc('{g}', event_timestamp) AS DATE) AS period_start,"
        " count(DISTINCT user_id) AS active_users, true AS within_bound FROM raw_events GROUP BY ALL"
        for g in ("day", "week", "month")
    ),
    "default_values": f"""WITH {METRICS}, {USER_METRICS}, {FEATURE_USAGE}
SELECT 'raw_events' AS table_name, count(*) AS n, count(*) AS defaulted, NULL::BIGINT AS default_total FROM raw_events
UNION ALL SELECT 'user_metrics', count(*), count(*), 0 FROM user_metrics
UNION ALL SELECT 'aggregated_metrics', count(*), count(*), NULL FROM aggregated_metrics
UNION ALL SELECT 'feature_usage', count(*), count(*), NULL FROM feature_usage""",
    "late_events_stream": f"""WITH {DELAYED}
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) FILTER (WHERE NOT late) AS on_time,
       count(*) FILTER (WHERE late AND NOT gone) AS late_kept, count(*) FILTER (WHERE gone) AS dropped
FROM judged GROUP BY window_start""",
    "watermark_progress_stream": f"""WITH {DELAYED}
SELECT arrival, watermark, messages,
       (SELECT count(DISTINCT window_start) FROM judged j WHERE j.arrival = m.arrival AND gone) AS dropped_updates
FROM marks m""",
    "standing_ingest_stream": f"""WITH {FEED},
judged AS (SELECT date_trunc('minute', event_timestamp) AS window_start, {STORAGE} AS reasons FROM decoded)
SELECT window_start, count(*) FILTER (WHERE reasons = '') AS logged, count(*) FILTER (WHERE reasons <> '') AS refused,
       CASE WHEN window_start IS NOT NULL THEN CAST(count(*) AS DOUBLE) END AS metric_value
FROM judged GROUP BY window_start""",
    "check_constraints": f"""WITH {FEED},
landed AS (SELECT *, TIMESTAMP '2024-01-01' AS ingested_at FROM decoded),
{USER_METRICS}, {FEATURE_USAGE},
{METRICS[len(RAW_EVENTS) + 1:]}
{_constraints(schemas.RAW_EVENTS, 'landed')}
UNION ALL {_constraints(schemas.USER_METRICS, 'user_metrics')}
UNION ALL {_constraints(schemas.AGGREGATED_METRICS, 'aggregated_metrics')}
UNION ALL {_constraints(schemas.FEATURE_USAGE, 'feature_usage')}""",
    "category_distribution": f"""WITH {RAW_EVENTS}
{_distribution('event_type', schemas.EVENT_TYPES, schemas.EVENT_TYPE_WEIGHTS)}
UNION ALL {_distribution('plan_tier', schemas.PLAN_TIERS, schemas.PLAN_TIER_WEIGHTS)}""",
    "audit_queries": f"""WITH {RAW_EVENTS},
texts AS (
  SELECT 'event-' || id AS query_id,
         CASE id % 8
           WHEN 0 THEN 'SELECT * FROM raw_events WHERE user_id = ''' || user_id || ''''
           WHEN 1 THEN ' ' || chr(10) || chr(9) || 'with u AS (SELECT user_id FROM raw_events) SELECT * FROM u WHERE user_id = '''
                       || user_id || ''' ;; '
           WHEN 2 THEN 'DELETE FROM raw_events WHERE user_id = ''' || user_id || ''''
           WHEN 3 THEN 'select updated_at from user_metrics -- ' || user_id
           WHEN 4 THEN 'EXPLAIN SELECT ' || user_id
           WHEN 5 THEN 'SELECT * INTO t' || user_id || ' FROM raw_events;'
           WHEN 6 THEN 'SELECT(' || user_id || ')'
           ELSE 'SELECT ' || user_id || ' FROM raw_events WHERE event_type = ''Update'''
         END AS sql
  FROM raw_events
  UNION ALL
  SELECT 'document-' || doc_id, 'SELECT ''' || replace(text, '''', '''''') || ''' AS t;' FROM documents
),
trimmed AS (
  SELECT query_id, regexp_replace(regexp_replace(sql, '\\A{_SPACE}+|{_SPACE}+\\z', '', 'g'), ';+\\z', '') AS cleaned_sql
  FROM texts
),
judged AS (
  SELECT query_id, cleaned_sql,
         CASE WHEN NOT regexp_matches(cleaned_sql, '(?i)\\A{_SPACE}*(SELECT|WITH){_SPACE}') THEN 'not_select_or_with'
              {" ".join(f"WHEN {_word(w)} THEN 'forbidden:{w}'" for w in _FORBIDDEN)} END AS reason
  FROM trimmed
)
SELECT query_id, cleaned_sql, reason, reason IS NULL AS is_readonly FROM judged""",
    "gated_queries": f"""WITH {RAW_EVENTS}, {USER_METRICS},
busy AS (SELECT user_id, count(*) AS n FROM raw_events GROUP BY user_id),
ran(query, result_rows) AS (
  SELECT 'users_per_tier', count(DISTINCT plan_tier) FROM raw_events
  UNION ALL SELECT 'with_and_subquery', count(*) FROM busy WHERE n > (SELECT avg(n) FROM busy)
  UNION ALL SELECT 'join_of_views', count(*) FROM raw_events e JOIN user_metrics m ON m.user_id = e.user_id
            WHERE e.event_type = 'upgrade' AND m.plan_tier = 'pro'
  UNION ALL SELECT 'literal_rows', 3
)
SELECT query, NULL::VARCHAR AS refused, result_rows FROM ran
UNION ALL
SELECT query, refused, NULL FROM (VALUES
  ('word_in_text', 'forbidden:UPDATE'), ('change', 'not_select_or_with'), ('files', 'outside_views'),
  ('files_beneath', 'outside_views'), ('table_function', 'outside_views'), ('outside_code', 'calls_outside_code')
) t(query, refused)""",
    "user_features": f"WITH {FEATURES} SELECT * FROM user_features",
    "user_features_leak_free": f"WITH {LEAK_FREE} SELECT * FROM user_features",
    "label_balance": f"""WITH {FEATURES}
SELECT count(*) AS users, CAST(sum(upgraded) AS BIGINT) AS positives, avg(upgraded) AS label_rate
FROM user_features""",
    "stratified_split": f"WITH {SPLIT} SELECT user_id, upgraded, split FROM split_features",
    "encoded_features": f"""WITH {SPLIT}, {_encoded('split_features')}
SELECT user_id, feature, value FROM encoded""",
    "scaled_features": f"""WITH {SPLIT}, {_encoded('split_features')},
moments AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS deviation
            FROM encoded WHERE split = 'train' GROUP BY feature)
SELECT user_id, e.feature,
       round(CASE WHEN deviation = 0 THEN 0 ELSE (value - mean) / deviation END, 6) + 0.0::DOUBLE AS value
FROM encoded e JOIN moments m ON m.feature = e.feature WHERE split = 'test'""",
    "confusion_matrix": f"""WITH {RULE_PREDICTIONS},
grid AS (SELECT a.v AS label, g.v AS prediction FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) g(v))
SELECT g.label, g.prediction, count(p.user_id) AS n
FROM grid g LEFT JOIN predictions p ON p.label = g.label AND p.prediction = g.prediction
GROUP BY g.label, g.prediction""",
    "classification_metrics": f"""WITH {RULE_PREDICTIONS},
c AS (SELECT CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) AS good, count(*) AS n,
             CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS hits,
             count(*) FILTER (WHERE prediction = 1) AS guessed, count(*) FILTER (WHERE label = 1) AS positives
      FROM predictions)
SELECT coalesce(good / nullif(n, 0), 0) AS accuracy, coalesce(hits / nullif(guessed, 0), 0) AS precision,
       coalesce(hits / nullif(positives, 0), 0) AS recall,
       coalesce(2 * hits / nullif(guessed + positives, 0), 0) AS f1 FROM c""",
    "classification_report": f"WITH {RULE_PREDICTIONS}, {_REPORT}",
    "logistic_report": f"""WITH RECURSIVE {LOGISTIC},
predictions AS (
  SELECT y AS label, CASE WHEN list_dot_product(w, v) > 0 THEN 1 ELSE 0 END AS prediction
  FROM labelled, optimum WHERE split = 'test'
), {_REPORT}""",
    "logistic_coefficients": f"""WITH RECURSIVE {LOGISTIC}
SELECT feature, round(w[j], 4) + 0.0::DOUBLE AS coefficient FROM names, optimum""",
    "logistic_optimality": f"""WITH {VECTORS}
SELECT feature, round(sum(y * v[j]), 4) + 0.0::DOUBLE AS moment FROM train, names GROUP BY feature""",
    "gini_split": PLAIN_SPLIT,
    "gini_split_balanced": BALANCED_SPLIT,
    "forest_stump": PLAIN_SPLIT,
    "forest_stump_balanced": BALANCED_SPLIT,
    "stump_importances": f"""WITH {_split_search('1.0::DOUBLE')}
SELECT m.feature, coalesce(round(b.gain * (left_rows + right_rows), 6), 0) + 0.0::DOUBLE AS decrease,
       CASE WHEN b.feature IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS importance
FROM (SELECT DISTINCT feature FROM encoded) m LEFT JOIN best b ON b.feature = m.feature""",
}
