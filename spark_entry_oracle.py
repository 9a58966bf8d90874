"""DuckDB SQL giving the expected result of each query in ``__spark_entry__``."""

from __future__ import annotations

_VIEWS = """
vitals AS (
 SELECT event_id, printf('C%03d', user_id) AS citizen_id, epoch_us(ts) // 1000 AS timestamp,
  CAST(CASE WHEN event_id % 41 = 0 THEN 210 WHEN event_id % 43 = 0 THEN 35
       ELSE 50 + (event_id * 7919 + user_id * 31) % 61 END AS INT) AS average_heart_beat_rate,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 0.8e0
       ELSE CAST(9400 + (event_id * 104729) % 651 AS DOUBLE) / 10000 END AS o2_content,
  CASE WHEN event_id % 59 = 0 THEN 15.5e0 WHEN event_id % 61 = 0 THEN 1.0e0
       ELSE CAST(450 + (event_id * 15485863) % 601 AS DOUBLE) / 100 END AS sleep_time,
  CAST(200 + floor(value) AS INT) AS calories_burned, event_type FROM events),
redelivered AS (
 SELECT event_id + 1000000000000 AS seq, event_id, citizen_id, timestamp, average_heart_beat_rate,
  o2_content, sleep_time,
  calories_burned + CASE WHEN event_id % 70 = 0 THEN 0 ELSE 1 END AS calories_burned, event_type
 FROM vitals WHERE event_id % 10 = 0),
feed AS (SELECT event_id AS seq, * FROM vitals UNION ALL SELECT * FROM redelivered),
newest AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY citizen_id, timestamp ORDER BY seq DESC) AS rn FROM feed)
 WHERE rn = 1),
labelled AS (
 SELECT *, CASE WHEN average_heart_beat_rate > 100 OR o2_content < 0.95e0 OR sleep_time < 5e0
            THEN 1 ELSE 0 END AS label FROM vitals),
scored AS (
 SELECT *, abs(average_heart_beat_rate - 75) / 75.0e0 * 0.30e0 + (1.0e0 - o2_content) / 0.1e0 * 0.40e0
   + abs(sleep_time - 8.0e0) / 8.0e0 * 0.30e0 AS composite_risk_score FROM labelled),
classified AS (
 SELECT *, CASE WHEN composite_risk_score < 0e0 THEN 0e0 WHEN composite_risk_score > 1e0 THEN 1e0
            ELSE composite_risk_score END AS p,
  CASE WHEN composite_risk_score IS NULL THEN NULL
       WHEN composite_risk_score < 0.5e0 THEN 'healthy' ELSE 'unhealthy' END AS classification,
  '2024-02-01T12:30:45.678Z' AS inference_timestamp FROM scored),
cleaned AS (
 SELECT DISTINCT average_heart_beat_rate,
  CASE WHEN o2_content < 0.85e0 THEN 0.85e0 WHEN o2_content > 1.0e0 THEN 1.0e0 ELSE o2_content END AS o2_content,
  CASE WHEN sleep_time < 2e0 THEN 2e0 WHEN sleep_time > 14e0 THEN 14e0 ELSE sleep_time END AS sleep_time,
  calories_burned, label
 FROM labelled WHERE o2_content IS NOT NULL AND average_heart_beat_rate BETWEEN 40 AND 200),
engineered AS (
 SELECT *,
  CASE WHEN average_heart_beat_rate < 60 THEN 'Bradycardia' WHEN average_heart_beat_rate <= 100 THEN 'Normal'
       ELSE 'Tachycardia' END AS heart_rate_zone,
  CASE WHEN o2_content < 0.93e0 THEN 'Hypoxia_Risk' WHEN o2_content < 0.95e0 THEN 'Borderline'
       ELSE 'Normal' END AS o2_risk,
  CASE WHEN sleep_time < 5e0 THEN 'Insufficient' WHEN sleep_time < 7e0 THEN 'Below_Recommended'
       WHEN sleep_time <= 9e0 THEN 'Optimal' ELSE 'Extended' END AS sleep_quality,
  calories_burned / average_heart_beat_rate AS calorie_efficiency,
  abs(average_heart_beat_rate - 75) / 75.0e0 * 0.30e0 + (1.0e0 - o2_content) / 0.1e0 * 0.40e0
   + abs(sleep_time - 8.0e0) / 8.0e0 * 0.30e0 AS composite_risk_score,
  average_heart_beat_rate * (10.0e0 - sleep_time) / 100.0e0 AS hr_sleep_interaction
 FROM cleaned)"""

_FEATURES = [
    "average_heart_beat_rate", "o2_content", "sleep_time", "calories_burned",
    "calorie_efficiency", "composite_risk_score", "hr_sleep_interaction",
]
_RAW = "citizen_id, timestamp, average_heart_beat_rate, o2_content, sleep_time, calories_burned"
_AS_DOUBLE = (
    "citizen_id, timestamp, CAST(average_heart_beat_rate AS DOUBLE) AS average_heart_beat_rate, "
    "o2_content, sleep_time, calories_burned"
)
_OUTCOME = (
    "CASE WHEN o2_content IS NULL THEN 'failed' ELSE 'scored' END AS outcome, "
    "CASE WHEN o2_content IS NULL THEN 'missing reading' END AS reason, o2_content IS NOT NULL AS classified"
)
# what a browser shows for the far values of the query
_FAR_TEXT = (
    "['1500000000000.50', '1099511627776.25', '4503599627370495.50', '9007199254740992', '1152921504606847000', "
    "'123456789012345680000', '1e+21']"
)
_VALID = "average_heart_beat_rate BETWEEN 40 AND 200"


def _with(select: str, extra: str = "") -> str:
    return f"WITH {_VIEWS.strip()}{extra}\n{select}"


_KEPT = """,
kept AS (SELECT citizen_id, timestamp, average_heart_beat_rate::DOUBLE AS average_heart_beat_rate, o2_content, calories_burned
 FROM vitals WHERE average_heart_beat_rate BETWEEN 40 AND 200)"""
_READINGS = """count(*) AS n, min(average_heart_beat_rate) AS least_rate, max(average_heart_beat_rate) AS most_rate,
 count(*) FILTER (o2_content < 0.95) AS low_o2, sum(calories_burned)::BIGINT AS calories"""


def _levels(groups: str, dimensions: str) -> str:
    """Counts and sums of ``engineered`` per level."""
    names = dimensions.split()
    level = ", ".join(f"CASE WHEN grouping({c}) = 0 THEN '{c}' END" for c in names)
    return f"""SELECT {", ".join(names)}, concat_ws(',', {level}) AS level, count(*) AS n, sum(label)::BIGINT AS unhealthy,
 min(average_heart_beat_rate) AS least, max(average_heart_beat_rate) AS most, sum(calories_burned)::BIGINT AS calories
FROM engineered GROUP BY {groups}"""


_STATES = """,
states AS (SELECT event_id, citizen_id, timestamp, average_heart_beat_rate, o2_content, sleep_time, calories_burned FROM vitals),
old AS (SELECT * FROM states WHERE event_id % 7 <> 0),
new AS (SELECT * REPLACE (CASE WHEN event_id % 13 = 0 THEN NULL ELSE o2_content END AS o2_content,
  CASE WHEN event_id % 10 = 0 THEN calories_burned + 1 ELSE calories_burned END AS calories_burned) FROM states WHERE event_id % 11 <> 0)"""


def _audit(table: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_total, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev FROM {table}"
        for c in cols
    )


def _scaled(table: str, cols: list[str]) -> str:
    """Scaled columns, given one-row statistics joined as ``s``."""
    return ", ".join(f"round(({table}.{c} - s.{c}_mean) / s.{c}_std, 6) AS {c}_scaled" for c in cols)


def _stats(table: str, cols: list[str]) -> str:
    parts = ", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in cols)
    return f"(SELECT {parts} FROM {table}) s"


def _stratified(table: str, key: str, label: str) -> str:
    return (
        f"SELECT {key}, {label}, CASE WHEN row_number() OVER (PARTITION BY {label} "
        f"ORDER BY md5('42:' || {key}::VARCHAR)) <= floor(count(*) OVER (PARTITION BY {label}) * 0.8e0) "
        f"THEN 'train' ELSE 'validation' END AS split FROM {table}"
    )


# text of the exact binary value with ties rounded up: printf rounds exact ties to even,
# so a tie (an odd multiple of the half step that doubles hold exactly) is moved up first
def _fixed(x: str, digits: int) -> str:
    grid = {1: 4, 2: 8}[digits]  # one place ties at .25 / .75, two places at odd eighths
    step = {1: 0.01, 2: 0.001}[digits]
    tie = f"({x}) * {grid} = floor(({x}) * {grid}) AND CAST(floor(({x}) * {grid}) AS BIGINT) % 2 = 1"
    return f"printf('%.{digits}f', CASE WHEN {tie} THEN ({x}) + {step}e0 ELSE ({x}) END)"


def _number(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN '-' WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
        f"ELSE {_fixed(f'CAST({x} AS DOUBLE)', 2)} END"
    )


def _normals(seed: str, key: str) -> tuple[str, str]:
    digest = f"md5('{seed}:' || {key}::VARCHAR)"
    u1 = f"(CAST('0x' || substr({digest}, 1, 13) AS BIGINT) + 1) / 4503599627370496e0"
    u2 = f"CAST('0x' || substr({digest}, 14, 13) AS BIGINT) / 4503599627370496e0"
    radius = f"sqrt(ln({u1}) * -2e0)"
    return f"{radius} * cos({u2} * 6.283185307179586e0)", f"{radius} * sin({u2} * 6.283185307179586e0)"


def _drawn(normal: str, mean: str, spread: str, low: str, high: str) -> str:
    x = f"({normal}) * {spread} + {mean}"
    return f"CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END"


def _synthetic() -> str:
    (rate, o2), (sleep, calories) = _normals("42.0", "c_custkey"), _normals("42.1", "c_custkey")
    return f"""WITH drawn AS (SELECT c_custkey,
 {_drawn(rate, '75e0', '15e0', '40e0', '200e0')} AS rate,
 {_drawn(o2, '0.97e0', '0.02e0', '0.92e0', '1e0')} AS o2,
 {_drawn(sleep, '7e0', '1.5e0', '3e0', '12e0')} AS sleep,
 {_drawn(calories, '500e0', '150e0', '200e0', '900e0')} AS calories FROM customer)
SELECT printf('C%03d', c_custkey) AS citizen_id, CAST(trunc(rate) AS INT) AS average_heart_beat_rate,
 round(o2, 4) AS o2_content, round(sleep, 2) AS sleep_time, CAST(trunc(calories) AS INT) AS calories_burned,
 CASE WHEN rate > 100 OR o2 < 0.95e0 OR sleep < 5 THEN 1 ELSE 0 END AS label FROM drawn"""


_K = "json_extract_string(props, '$.k')"
_K_TEXT = (
    f"CASE event_type WHEN 'view' THEN {_K} || '.5' WHEN 'click' THEN 'n/a' "
    f"WHEN 'error' THEN ' ' || {_K} ELSE {_K} END"
)

_CHANNELS = """per_label AS (SELECT label, count(*) AS n, CAST(floor(count(*) * 0.8e0) AS BIGINT) AS t
 FROM cleaned GROUP BY label),
totals AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(t) AS BIGINT) AS train FROM per_label)"""


def oracle_sql() -> dict[str, str]:
    newest_valid = _with(f"SELECT seq, {_AS_DOUBLE} FROM newest WHERE {_VALID}")
    engineered = f"engineered, {_stats('engineered', _FEATURES)}"
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    clip_o2 = "CASE WHEN o2_content < 0.85e0 THEN 0.85e0 WHEN o2_content > 1e0 THEN 1e0 ELSE o2_content END"
    clip_sleep = "CASE WHEN sleep_time < 2e0 THEN 2e0 WHEN sleep_time > 14e0 THEN 14e0 ELSE sleep_time END"
    return {
        "coerce_props": f"""SELECT event_id, CAST(floor(TRY_CAST({_K_TEXT} AS DOUBLE)) AS INT) AS k_int,
 TRY_CAST({_K_TEXT} AS DOUBLE) AS k_double FROM events""",
        "csv_round_trip": _with(
            "SELECT citizen_id, average_heart_beat_rate, o2_content, sleep_time, calories_burned, label FROM labelled"
        ),
        "decode_payload": _with(f"SELECT seq, {_AS_DOUBLE} FROM feed"),
        "topic_route": "SELECT event_id, user_id, value, props FROM events WHERE event_type = 'click'",
        "raw_current": newest_valid,
        "snapshot_current": newest_valid,
        "stream_ingest": newest_valid,
        "synthetic_labelled": _synthetic(),
        "drop_incomplete": _with(
            "SELECT event_id, average_heart_beat_rate, o2_content, sleep_time, calories_burned "
            "FROM vitals WHERE o2_content IS NOT NULL"
        ),
        "keep_range": _with(f"SELECT event_id, average_heart_beat_rate FROM vitals WHERE {_VALID}"),
        "clip_values": _with(
            f"SELECT event_id, {clip_o2} AS o2_content, {clip_sleep} AS sleep_time FROM vitals"
        ),
        "clean_full": _with("SELECT * FROM cleaned"),
        "dedupe": _with("SELECT DISTINCT citizen_id, average_heart_beat_rate FROM vitals"),
        "dedupe_by_key": _with(
            "SELECT citizen_id, timestamp, calories_burned FROM (SELECT *, row_number() OVER "
            "(PARTITION BY citizen_id ORDER BY timestamp, calories_burned) AS rn FROM vitals) WHERE rn = 1"
        ),
        "zones": _with(
            """SELECT event_id,
 CASE WHEN average_heart_beat_rate < 60 THEN 'Bradycardia' WHEN average_heart_beat_rate <= 100 THEN 'Normal'
      ELSE 'Tachycardia' END AS heart_rate_zone,
 CASE WHEN o2_content < 0.93e0 THEN 'Hypoxia_Risk' WHEN o2_content < 0.95e0 THEN 'Borderline'
      ELSE 'Normal' END AS o2_risk,
 CASE WHEN sleep_time < 5e0 THEN 'Insufficient' WHEN sleep_time < 7e0 THEN 'Below_Recommended'
      WHEN sleep_time <= 9e0 THEN 'Optimal' ELSE 'Extended' END AS sleep_quality FROM vitals"""
        ),
        "risk_label": _with("SELECT event_id, label FROM labelled"),
        "safe_ratio": _with(
            "SELECT event_id, CASE WHEN average_heart_beat_rate > 0 "
            "THEN calories_burned / average_heart_beat_rate ELSE 0e0 END AS calorie_efficiency FROM vitals"
        ),
        "risk_score": _with("SELECT event_id, composite_risk_score FROM scored"),
        "interaction": _with(
            "SELECT event_id, average_heart_beat_rate * (10.0e0 - sleep_time) / 100.0e0 AS hr_sleep_interaction "
            "FROM vitals"
        ),
        "risk_matrix": _with(
            "SELECT heart_rate_zone, o2_risk, count(*) AS n, round(avg(composite_risk_score), 6) AS mean_risk "
            "FROM engineered GROUP BY heart_rate_zone, o2_risk"
        ),
        "classify": _with("SELECT event_id, classification FROM classified"),
        "iso_stamp": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS inference_timestamp FROM events",
        "defaults": _with(
            "SELECT event_id, coalesce(o2_content, 0e0) AS o2_content, "
            "CASE WHEN event_type IN ('view', 'error') THEN 'unknown' ELSE 'healthy' END AS classification FROM vitals"
        ),
        "report_rows": _with(
            f"""SELECT '&lt;' || citizen_id AS citizen_id, {_number('average_heart_beat_rate')} || ' bpm' AS heart_rate,
 CASE WHEN o2_content IS NULL THEN '-' ELSE {_fixed('o2_content * 100.0e0', 1)} || '%' END AS o2,
 CASE WHEN event_id % 20 = 0 THEN {_FAR_TEXT}[event_id % 7 + 1] ELSE {_number('sleep_time')} END || 'h' AS sleep,
 {_number('calories_burned')} || ' kcal' AS calories,
 coalesce(classification, 'unknown') AS classification, inference_timestamp FROM classified"""
        ),
        "json_records": _with(
            """SELECT '{"citizen_id":"' || citizen_id || '","timestamp":' || timestamp::VARCHAR
 || ',"average_heart_beat_rate":' || average_heart_beat_rate::VARCHAR
 || ',"o2_content":' || coalesce(o2_content::VARCHAR, 'null') || ',"sleep_time":' || sleep_time::VARCHAR
 || ',"calories_burned":' || calories_burned::VARCHAR || '}' AS record FROM vitals"""
        ),
        "preview": _with(
            "SELECT event_id, average_heart_beat_rate, o2_content, sleep_time, calories_burned "
            "FROM vitals ORDER BY event_id LIMIT 5"
        ),
        "label_distribution": _with("SELECT label, count(*) AS count FROM labelled GROUP BY label"),
        "audit": _with(_audit("vitals", _FEATURES[:4])),
        "audit_lineitem": _audit("lineitem", numbers),
        "anomaly_count": _with(
            "SELECT count(*) FILTER (average_heart_beat_rate < 40 OR average_heart_beat_rate > 200) AS n_anomalies "
            "FROM vitals"
        ),
        "clean_funnel": _with(
            f"""SELECT count(*) AS raw, count(*) FILTER (o2_content IS NOT NULL) AS after_nulls,
 count(*) FILTER (o2_content IS NOT NULL AND {_VALID}) AS after_range,
 (SELECT count(*) FROM cleaned) AS after_clean, count(*) - (SELECT count(*) FROM cleaned) AS removed
FROM labelled"""
        ),
        "ingest_counts": _with(
            f"SELECT count(*) FILTER ({_VALID}) AS stored, count(*) FILTER (NOT ({_VALID})) AS dropped, "
            "CAST(0 AS BIGINT) AS failed FROM feed"
        ),
        "stream_counts": _with(
            f"SELECT CASE WHEN {_VALID} THEN 'kept' ELSE 'anomaly' END AS route, count(*) AS n FROM feed GROUP BY 1"
        ),
        "summary_cards": _with(
            "SELECT count(*) AS total, count(*) FILTER (classification = 'healthy') AS healthy, "
            "count(*) FILTER (classification = 'unhealthy') AS unhealthy, "
            "count(DISTINCT citizen_id) AS citizens FROM classified"
        ),
        "scaler_stats": _with(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std "
                "FROM engineered"
                for c in _FEATURES
            )
        ),
        "standard_scale": _with(
            "SELECT average_heart_beat_rate, o2_content, sleep_time, calories_burned, label, "
            f"{_scaled('engineered', _FEATURES)} FROM {engineered}"
        ),
        "scale_lineitem": f"SELECT l_orderkey, l_linenumber, {_scaled('lineitem', numbers)} "
        f"FROM lineitem, {_stats('lineitem', numbers)}",
        "training_frame": _with(f"SELECT {_scaled('engineered', _FEATURES)}, label FROM {engineered}"),
        "random_split": "SELECT event_id, CASE WHEN CAST('0x' || substr(md5('42:' || event_id::VARCHAR), 1, 8) "
        "AS BIGINT) / 4294967296e0 < 0.8e0 THEN 'train' ELSE 'validation' END AS split FROM events",
        "stratified_split": _with(_stratified("labelled", "event_id", "label")),
        "stratified_orders": _stratified("orders", "o_orderkey", "o_orderpriority"),
        "decimals_to_double": "SELECT l_orderkey, l_linenumber, "
        + ", ".join(
            f"CAST(CAST({c} AS DECIMAL(12,2)) AS DOUBLE) AS {n}"
            for c, n in zip(
                ["l_quantity", "l_extendedprice", "l_tax", "l_discount"],
                ["quantity", "extendedprice", "tax", "discount"],
            )
        )
        + " FROM lineitem",
        "upsert_latest": _with(f"SELECT seq, {_RAW} FROM newest"),
        "pending_records": _with(
            "SELECT event_id, seq, citizen_id, timestamp FROM newest "
            "WHERE seq <> event_id OR timestamp >= 1705363200000"
        ),
        "analytics_upsert": _with(
            "SELECT seq, citizen_id, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') "
            "AS inference_timestamp, calories_burned FROM newest"
        ),
        "latest_per_citizen": _with(
            f"SELECT event_id, {_RAW} FROM (SELECT *, row_number() OVER "
            "(PARTITION BY citizen_id ORDER BY timestamp DESC, event_id DESC) AS rn FROM vitals) WHERE rn = 1"
        ),
        "route_feed": _with(
            f"""SELECT seq,
 CASE WHEN event_type IN ('error', 'purchase') THEN 'error'
      WHEN event_type = 'signup' OR NOT ({_VALID}) THEN 'anomaly' ELSE 'kept' END AS route,
 CASE WHEN event_type IN ('error', 'purchase') THEN 'heart rate is not a number'
      WHEN event_type = 'signup' OR NOT ({_VALID}) THEN 'heart rate out of range' END AS reason FROM feed"""
        ),
        "etl_processed": _with(
            f"SELECT engineered.*, {_scaled('engineered', _FEATURES)} FROM {engineered}"
        ),
        "etl_channels": _with(
            "SELECT 'train' AS split, label, t AS count FROM per_label "
            "UNION ALL SELECT 'validation', label, n - t FROM per_label",
            ",\n" + _CHANNELS,
        ),
        "etl_statistics": _with(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
                "(SELECT train FROM totals) AS train_count, (SELECT total - train FROM totals) AS val_count, "
                "(SELECT total FROM totals) AS total_processed, "
                "'2024-02-01T12:30:45.678901+00:00' AS created_at FROM engineered"
                for c in _FEATURES
            ),
            ",\n" + _CHANNELS,
        ),
        "etl_table_properties": _with(
            """SELECT unnest(['recordCount', 'trainCount', 'valCount', 'featureCount', 'last_etl_run', 'sourceKey'])
  AS key, unnest([total::VARCHAR, train::VARCHAR, (total - train)::VARCHAR, '7',
  '2024-02-01T12:30:45.678901+00:00', 'source.csv']) AS value FROM totals
 UNION ALL SELECT 'rows', total::VARCHAR FROM totals""",
            ",\n" + _CHANNELS,
        ),
        "results_export": _with(f"SELECT {_RAW}, classification, inference_timestamp FROM classified"),
        "feature_vector": _with(
            "SELECT event_id, CAST(average_heart_beat_rate AS DOUBLE) AS f0, coalesce(o2_content, 0e0) AS f1, "
            "sleep_time AS f2, CAST(calories_burned AS DOUBLE) AS f3 FROM vitals"
        ),
        "log_loss": _with(
            """SELECT round(avg(-CASE WHEN label = 1 THEN ln(q) ELSE ln(1e0 - q) END), 6) AS log_loss, count(q) AS n,
 count(*) - count(q) AS unscored
FROM (SELECT label, CASE WHEN p < 1e-15 THEN 1e-15 WHEN p > 1e0 - 1e-15 THEN 1e0 - 1e-15 ELSE p END AS q
 FROM classified)"""
        ),
        "model_round_trip": "SELECT count(*) AS n, count(*) AS n_equal FROM events",
        "gbt_confusion": _with(
            "SELECT label, CAST(n - t AS BIGINT) AS n, true AS accurate FROM per_label", ",\n" + _CHANNELS
        ),
        "stream_windows": _with(
            f"""SELECT citizen_id, w * 43200000 AS start_ms, (w + 2) * 43200000 AS end_ms, {_READINGS}
FROM kept, (VALUES (0), (1)) v(k), LATERAL (SELECT timestamp // 43200000 - k AS w) GROUP BY citizen_id, w""",
            _KEPT,
        ),
        "stream_sessions": _with(
            f"""SELECT citizen_id, min(timestamp) AS start_ms, max(timestamp) + 43200000 AS end_ms, {_READINGS}
FROM (SELECT *, sum(new) OVER (PARTITION BY citizen_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS session
 FROM (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER (PARTITION BY citizen_id ORDER BY timestamp) < 43200000 THEN 0 ELSE 1 END AS new
  FROM kept)) GROUP BY citizen_id, session""",
            _KEPT,
        ),
        "stream_alerts": _with(
            """SELECT citizen_id, kind, timestamp AS at_ms, seen FROM (
 SELECT citizen_id, 'silent' AS kind, timestamp, seen FROM placed WHERE next IS NULL OR next - timestamp > 172800000
 UNION ALL SELECT citizen_id, 'streak', timestamp, seen
 FROM (SELECT *, row_number() OVER (PARTITION BY citizen_id, odd, seen - nth ORDER BY seen) AS place FROM placed) WHERE odd AND place = 3)""",
            _KEPT
            + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY citizen_id, odd ORDER BY timestamp, average_heart_beat_rate) AS nth
 FROM (SELECT *, average_heart_beat_rate NOT BETWEEN 60 AND 100 AS odd, lead(timestamp) OVER w AS next, row_number() OVER w AS seen
  FROM kept WINDOW w AS (PARTITION BY citizen_id ORDER BY timestamp, average_heart_beat_rate)))""",
        ),
        "asof_readings": _with(
            """SELECT event_id, citizen_id, timestamp, CASE WHEN near THEN r.reading_id END AS reading_id,
 CASE WHEN near THEN r.average_heart_beat_rate END AS average_heart_beat_rate, CASE WHEN near THEN r.o2_content END AS o2_content
FROM (SELECT l.event_id, l.citizen_id, l.timestamp, r, coalesce(l.timestamp - r.t <= 172800000, false) AS near
 FROM vitals l LEFT JOIN LATERAL (
  SELECT v.timestamp AS t, v.event_id AS reading_id, v.average_heart_beat_rate, v.o2_content FROM vitals v
  WHERE v.event_type <> 'error' AND v.citizen_id = l.citizen_id AND v.timestamp <= l.timestamp
  ORDER BY v.timestamp DESC, v.event_id DESC LIMIT 1) r ON true
 WHERE l.event_type = 'error')"""
        ),
        "asof_orders": """SELECT l.o_orderkey, l.o_custkey, (l.o_orderdate::DATE - DATE '1970-01-01')::INT AS day,
 r.o_orderkey AS previous, (l.o_orderdate::DATE - r.o_orderdate::DATE)::INT AS days
FROM orders l LEFT JOIN LATERAL (SELECT v.o_orderkey, v.o_orderdate FROM orders v
 WHERE v.o_custkey = l.o_custkey AND v.o_orderdate::DATE < l.o_orderdate::DATE ORDER BY v.o_orderdate DESC, v.o_orderkey DESC LIMIT 1) r ON true""",
        "interval_readings": _with(
            """SELECT v.event_id, v.citizen_id, v.timestamp, v.average_heart_beat_rate, a.event_id AS alarm_id
FROM vitals v JOIN vitals a ON a.event_type = 'error' AND a.citizen_id = v.citizen_id AND v.timestamp >= a.timestamp
 AND v.timestamp < a.timestamp + (1 + a.event_id * 37 % 168) * 3600000"""
        ),
        "vitals_cube": _with(_levels("CUBE (heart_rate_zone, o2_risk, sleep_quality, label)", "heart_rate_zone o2_risk sleep_quality label")),
        "vitals_grouping_sets": _with(
            _levels("GROUPING SETS ((heart_rate_zone, label), (sleep_quality), ())", "heart_rate_zone sleep_quality label")
        ),
        "orders_rollup": """SELECT year, month, priority, concat_ws(',', CASE WHEN grouping(year) = 0 THEN 'year' END,
 CASE WHEN grouping(month) = 0 THEN 'month' END, CASE WHEN grouping(priority) = 0 THEN 'priority' END) AS level,
 count(*) AS n, count(DISTINCT o_custkey) AS customers
FROM (SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, o_orderpriority AS priority, o_custkey FROM orders)
GROUP BY ROLLUP (year, month, priority)""",
        "state_difference": _with(
            """SELECT event_id, CASE WHEN o.event_id IS NULL THEN 'added' WHEN n.event_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
 CASE WHEN o.event_id IS NULL OR n.event_id IS NULL THEN '' ELSE concat_ws(',',
  CASE WHEN o.o2_content IS DISTINCT FROM n.o2_content THEN 'o2_content' END,
  CASE WHEN o.calories_burned IS DISTINCT FROM n.calories_burned THEN 'calories_burned' END) END AS columns,
 o.calories_burned AS old_calories, n.calories_burned AS new_calories
FROM old o FULL JOIN new n USING (event_id)
WHERE o.event_id IS NULL OR n.event_id IS NULL OR o.o2_content IS DISTINCT FROM n.o2_content OR o.calories_burned <> n.calories_burned""",
            _STATES,
        ),
        "state_common": _with("SELECT * FROM old INTERSECT SELECT * FROM new", _STATES),
        "state_missing": _with(
            "SELECT citizen_id, average_heart_beat_rate, sleep_time FROM old EXCEPT ALL SELECT citizen_id, average_heart_beat_rate, sleep_time FROM new",
            _STATES,
        ),
        "incremental_scaler": _with(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, count({c}) AS n FROM complete"
                for c in _FEATURES
            ),
            """,
complete AS (SELECT *, CASE WHEN average_heart_beat_rate > 0 THEN calories_burned / average_heart_beat_rate ELSE 0 END AS calorie_efficiency,
  average_heart_beat_rate * (10.0e0 - sleep_time) / 100.0e0 AS hr_sleep_interaction FROM scored WHERE o2_content IS NOT NULL)""",
        ),
        "distinct_citizens": _with(
            """SELECT event_type, 'citizen_id' AS column_name, count(DISTINCT citizen_id) AS exact, true AS near FROM vitals GROUP BY event_type
UNION ALL SELECT event_type, 'timestamp', count(DISTINCT timestamp), true FROM vitals GROUP BY event_type"""
        ),
        "leafwise_confusion": _with(
            "SELECT label, CAST(n - t AS BIGINT) AS n, true AS accurate FROM per_label", ",\n" + _CHANNELS
        ),
        "leafwise_trees": "SELECT true AS in_time, true AS few_leaves, true AS full_leaves, 6 AS features, true AS few_rounds",
        "split_gains": _with(
            """SELECT feature, below, ln AS n_left, tn - ln AS n_right,
 round(power(lg / 1048576e0, 2) / nullif(lh / 1048576e0, 0) + power((tg - lg) / 1048576e0, 2) / nullif((th - lh) / 1048576e0, 0)
  - power(tg / 1048576e0, 2) / (th / 1048576e0), 6) AS gain
FROM (SELECT feature, below, count(*) FILTER (v < below) AS ln, count(*) AS tn, coalesce(sum(g) FILTER (v < below), 0)::DOUBLE AS lg,
  sum(g)::DOUBLE AS tg, coalesce(sum(h) FILTER (v < below), 0)::DOUBLE AS lh, sum(h)::DOUBLE AS th
 FROM edges JOIN each USING (feature) GROUP BY feature, below)""",
            """,
gh AS (SELECT *, round((p - label) * 1048576e0)::BIGINT AS g, round(p * (1 - p) * 1048576e0)::BIGINT AS h
 FROM labelled, (SELECT avg(label) AS p FROM labelled)),
each AS (
 SELECT 'average_heart_beat_rate' AS feature, average_heart_beat_rate::DOUBLE AS v, g, h FROM gh
 UNION ALL SELECT 'o2_content', o2_content, g, h FROM gh UNION ALL SELECT 'sleep_time', sleep_time, g, h FROM gh
 UNION ALL SELECT 'calories_burned', calories_burned::DOUBLE, g, h FROM gh),
edges AS (
 SELECT 'average_heart_beat_rate' AS feature, unnest(range(45, 200, 5))::DOUBLE AS below
 UNION ALL SELECT 'o2_content', unnest(range(171, 200)) / 200e0 UNION ALL SELECT 'sleep_time', unnest(range(9, 56)) / 4e0
 UNION ALL SELECT 'calories_burned', unnest(range(200, 900, 25))::DOUBLE)""",
        ),
        "score_classes": _with(
            """SELECT event_id, citizen_id,
 CASE WHEN o2_content IS NULL THEN NULL WHEN 0.1e0 + 0.5e0 * (t1 + t2) < 0 THEN 'healthy' ELSE 'unhealthy' END AS classification,
 CASE WHEN o2_content IS NULL THEN 'failed' ELSE 'scored' END AS outcome,
 CASE WHEN o2_content IS NULL THEN 'missing reading' END AS reason
FROM (SELECT *,
  CASE WHEN (average_heart_beat_rate - 75e0) / 15e0 >= 1e0 THEN 1.2e0 WHEN (o2 - 0.97e0) / 0.02e0 < -1e0 THEN 0.8e0 ELSE -0.9e0 END AS t1,
  CASE WHEN (sleep - 7e0) / 1.5e0 < -1.3e0 THEN 1e0
       WHEN (calories_burned / average_heart_beat_rate - 3e0) / 2e0 < 1.5e0 THEN -0.3e0 ELSE 0.2e0 END AS t2
 FROM (SELECT *, least(greatest(o2_content, 0.85e0), 1e0) AS o2, least(greatest(sleep_time, 2e0), 14e0) AS sleep FROM vitals))"""
        ),
        "score_batch": _with(
            f"SELECT {_RAW}, '2024-02-01T12:30:45.678Z' AS inference_timestamp, {_OUTCOME} FROM vitals"
        ),
        "scheduled_scoring": _with(
            f"""SELECT {_AS_DOUBLE}, seq AS source_seq, {_OUTCOME},
 CASE WHEN seq = event_id AND timestamp < 1705363200000 THEN '2024-02-01T12:30:45.678Z'
 ELSE '2024-02-01T12:45:45.678Z' END AS inference_timestamp FROM newest WHERE {_VALID}"""
        ),
    }
