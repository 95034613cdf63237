"""The same results in plain SQL over the test tables, for an independent check."""

from __future__ import annotations

READINGS = """
readings AS (
  SELECT event_id, ts, user_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('sensor-', CAST(user_id AS VARCHAR)) END AS device_id,
    CASE WHEN user_id % 7 = 6 THEN NULL WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS building,
    CAST(user_id % 3 + 1 AS INT) AS floor,
    CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'co2' WHEN 'purchase' THEN 'humidity'
      WHEN 'signup' THEN 'energy_consumption' ELSE event_type END AS type,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -value
      WHEN event_type = 'view' THEN value * 20 ELSE value END AS value,
    CASE event_type WHEN 'click' THEN '°C' WHEN 'view' THEN 'ppm' WHEN 'purchase' THEN '%'
      WHEN 'signup' THEN 'kWh' END AS unit
  FROM events
)"""

BRONZE = (
    READINGS
    + """,
bronze AS (
  SELECT device_id, ts AS timestamp_parsed, building, floor,
    building || '-' || CAST(floor AS VARCHAR) AS building_floor,
    type, value, unit,
    CASE WHEN type = 'temperature' AND value > 28 THEN 'HIGH'
      WHEN type = 'co2' AND value > 1000 THEN 'HIGH'
      WHEN type = 'humidity' AND (value < 30 OR value > 70) THEN 'MEDIUM'
      ELSE 'LOW' END AS alert_level
  FROM readings
  WHERE device_id IS NOT NULL AND value >= 0 AND ts IS NOT NULL
)"""
)

SILVER = (
    READINGS
    + """,
decoded AS (
  SELECT device_id AS sensor_id, ts AS event_time, building, floor, type AS sensor_type,
    value AS sensor_value, unit
  FROM readings WHERE value IS NOT NULL
),
silver AS (
  SELECT * FROM decoded WHERE sensor_id IS NOT NULL AND event_time IS NOT NULL AND sensor_value >= 0
)"""
)

# The third of its time that a row belongs to.
PARTS = """
span AS (SELECT epoch_us(min(ts)) AS lo, (epoch_us(max(ts)) - epoch_us(min(ts))) // 3 AS third FROM events),
parted AS (
  SELECT readings.*, CAST(CASE WHEN epoch_us(ts) < lo + third THEN 0 WHEN epoch_us(ts) < lo + 2 * third THEN 1 ELSE 2 END AS BIGINT) AS part
  FROM readings, span)"""

# Rows of part k are late if their window closed before the watermark the earlier parts left.
LATE = """
arrived AS (SELECT * REPLACE (part + CASE WHEN building = 'B' THEN 1 ELSE 0 END AS part) FROM parted),
marks AS (SELECT part, date_trunc('millisecond', max(ts)) - INTERVAL '5 days' AS mark FROM arrived GROUP BY 1),
limits AS (SELECT a.part, max(b.mark) AS late_before FROM marks a LEFT JOIN marks b ON b.part < a.part GROUP BY 1),
judged AS (
  SELECT arrived.*, coalesce(time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= late_before, ts IS NULL) AS late
  FROM arrived JOIN limits USING (part))"""

FIELDS = '"timestamp", device_id, building, floor, type, value, unit'

ALL_READINGS = f"WITH {READINGS} SELECT {FIELDS} FROM readings"
ALL_BRONZE = f"WITH {BRONZE} SELECT * FROM bronze"
ALL_SILVER = f"WITH {SILVER} SELECT * FROM silver"

TEMP_5MIN = """
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
    round(avg(sensor_value), 6) AS avg_temperature, count(*) AS n
  FROM silver WHERE sensor_type = 'temperature' GROUP BY 1"""
HOURLY = """
  SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start, building, sensor_type,
    round(avg(sensor_value), 6) AS avg_value, min(sensor_value + 0.0) AS min_value,
    max(sensor_value + 0.0) AS max_value, count(*) AS n
  FROM silver GROUP BY 1, 2, 3"""
LAST_KNOWN = """
  SELECT sensor_id, max(event_time) AS last_time,
    arg_max(sensor_value, (event_time, sensor_value)) AS last_value
  FROM silver GROUP BY 1"""

SLICES = """
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS n,
    round(avg(value), 6) AS avg_value"""


def _column_stats(name: str, relation: str, extra: str = "") -> str:
    ranged = f'"{name}" + 0.0' if name == "value" else f'"{name}"'
    return (
        f"SELECT {extra}'{name}' AS column_name, count(*) AS n_rows, count(*) - count(\"{name}\") AS n_nulls, "
        f"CAST(min({ranged}) AS VARCHAR) AS min_value, CAST(max({ranged}) AS VARCHAR) AS max_value FROM {relation}"
    )


REASON = """CASE WHEN device_id IS NULL THEN 'missing_sensor_id' WHEN value IS NULL THEN 'missing_value'
            WHEN ts IS NULL THEN 'missing_time' WHEN value < 0 THEN 'negative_value' ELSE 'accepted' END"""
READING_FIELDS = ("timestamp", "device_id", "building", "floor", "type", "value", "unit")
EVENT_FIELDS = (
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
)

ORACLE_SQL: dict[str, str] = {
    "fn_from_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
    "fn_parse_iso": "SELECT event_id, ts AS event_time FROM events",
    "fn_parse_pattern": "SELECT event_id, ts AS event_time FROM events",
    "fn_cast_string": f"""WITH {READINGS}
        SELECT event_id, device_id AS device_text, CAST(floor AS VARCHAR) AS floor_text FROM readings""",
    "fn_building_floor": f"""WITH {READINGS}
        SELECT event_id, building || '-' || CAST(floor AS VARCHAR) AS building_floor FROM readings""",
    "alert_level": f"""WITH {READINGS}
        SELECT event_id, type, value,
          CASE WHEN type = 'temperature' AND value > 28 THEN 'HIGH' WHEN type = 'co2' AND value > 1000 THEN 'HIGH'
            WHEN type = 'humidity' AND (value < 30 OR value > 70) THEN 'MEDIUM' ELSE 'LOW' END AS alert_level
        FROM readings""",
    "src_missing_table": """
        SELECT 'events' AS table_name, count(*) > 0 AS ready, count(*) AS n FROM events
        UNION ALL SELECT 'silver', false, 0""",
    "batch_stream_parity": f"WITH {BRONZE} SELECT CAST(0 AS BIGINT) AS n_diff, count(*) AS n_table, count(*) AS n_stream FROM bronze",
    "src_rate_limit": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS epochs_over_limit, count(*) > 750 AS several_epochs FROM events",
    "src_earliest": "SELECT count(*) AS n, 1 AS run FROM events UNION ALL SELECT count(*), 2 FROM events",
    "trig_available_now": "SELECT count(*) AS n, true AS ended_by_itself FROM events",
    "trig_processing_time": "SELECT count(*) AS n, true AS went_on FROM events",
    "silver_rejects": f"""WITH {READINGS}
        SELECT {REASON} AS reason,
          count(*) AS n
        FROM readings GROUP BY 1""",
    "gold_follow_hourly": f"WITH {SILVER} {HOURLY}",
    "gold_follow_5min": f"WITH {SILVER} {TEMP_5MIN}",
    "clean_not_null": f"""WITH {READINGS}
        SELECT {FIELDS} FROM readings WHERE device_id IS NOT NULL AND value IS NOT NULL AND ts IS NOT NULL""",
    "clean_non_negative": f"WITH {READINGS} SELECT {FIELDS} FROM readings WHERE value >= 0",
    "quality_rejects": f"""WITH {READINGS}
        SELECT CASE WHEN device_id IS NULL THEN 'missing_device_id' WHEN value IS NULL THEN 'missing_value'
            WHEN ts IS NULL THEN 'missing_timestamp' WHEN value < 0 THEN 'negative_value' ELSE 'accepted' END AS reason,
          count(*) AS n
        FROM readings GROUP BY 1""",
    "silver_decode": f"WITH {SILVER} SELECT * FROM decoded",
    "layer_raw": f"WITH {READINGS} SELECT {FIELDS}, 'plant_readings' AS topic FROM readings",
    "agg_total": f"WITH {BRONZE} SELECT count(*) AS n FROM bronze",
    "agg_by_building": f"WITH {BRONZE} SELECT building, count(*) AS n FROM bronze GROUP BY 1",
    "agg_by_type": f"WITH {BRONZE} SELECT type, count(*) AS n FROM bronze GROUP BY 1",
    "alerts_high": f"WITH {BRONZE} SELECT * FROM bronze WHERE alert_level = 'HIGH'",
    "sink_alert_messages": f"WITH {BRONZE} SELECT * FROM bronze WHERE alert_level = 'HIGH'",
    "sink_memory": f"WITH {BRONZE} SELECT type, alert_level, count(*) AS n FROM bronze GROUP BY 1, 2",
    "read_preview": f"WITH {READINGS} SELECT {FIELDS}, event_id FROM readings ORDER BY event_id LIMIT 20",
    "read_schema": " UNION ALL ".join(
        f"SELECT {position} AS position, '{name}' AS column_name, '{kind}' AS data_type, true AS nullable, "
        f"count({name}) AS n_set FROM events"
        for position, (name, kind) in enumerate(EVENT_FIELDS)
    ),
    "profile_columns": f"WITH {READINGS} "
    + " UNION ALL ".join(_column_stats(name, "readings") for name in READING_FIELDS),
    "profile_per_file": " UNION ALL ".join(
        _column_stats(name, "events", "'events.parquet' AS file_name, ") for name, _ in EVENT_FIELDS
    ),
    "gold_temp_5min": f"WITH {SILVER} {TEMP_5MIN}",
    "gold_hourly_kpi": f"WITH {SILVER} {HOURLY}",
    "gold_last_known": f"WITH {SILVER} {LAST_KNOWN}",
    "mode_update_last_known": f"WITH {SILVER} {LAST_KNOWN}",
    "layer_gold": f"""WITH {SILVER}, temp AS ({TEMP_5MIN}), hourly AS ({HOURLY}), known AS ({LAST_KNOWN})
        SELECT 'temperature_5min' AS kpi, CAST(NULL AS VARCHAR) AS building, 'temperature' AS sensor_type,
          CAST(NULL AS VARCHAR) AS sensor_id, window_start AS time, avg_temperature AS value, n FROM temp
        UNION ALL SELECT 'hourly', building, sensor_type, NULL, window_start, avg_value, n FROM hourly
        UNION ALL SELECT 'last_known', NULL, NULL, sensor_id, last_time, round(last_value, 6), 1 FROM known""",
    "win_tumbling": f"WITH {READINGS} {SLICES} FROM readings GROUP BY 1",
    "win_watermark_append": f"""WITH {READINGS}, slices AS ({SLICES} FROM readings GROUP BY 1)
        SELECT * FROM slices WHERE window_start + INTERVAL '5 minutes'
          <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '10 minutes' FROM events)""",
    "win_late_data": f"""WITH {READINGS}, {PARTS}, {LATE}, slices AS ({SLICES} FROM judged WHERE NOT late GROUP BY 1)
        SELECT * FROM slices WHERE window_start + INTERVAL '5 minutes' <= (SELECT max(mark) FROM marks)""",
    "win_late_kept": f"""WITH {READINGS}, {PARTS}, {LATE}, slices AS ({SLICES} FROM judged WHERE NOT late GROUP BY 1)
        SELECT * FROM slices WHERE window_start + INTERVAL '5 minutes' <= (SELECT max(mark) FROM marks)""",
    "win_late_counts": f"""WITH {READINGS}, {PARTS}, {LATE}
        SELECT part AS batch_id, count(*) AS n_read, count(*) FILTER (NOT late) AS n_kept, count(*) FILTER (late) AS n_late
        FROM judged GROUP BY 1""",
    "win_late_rows": f"""WITH {READINGS}, {PARTS}, {LATE} SELECT {FIELDS}, ts, part AS batch_id FROM judged WHERE late""",
    "state_bounded": f"""WITH {READINGS}, {PARTS}, run AS (SELECT unnest([0, 1, 2]) AS run),
        seen AS (
          SELECT DISTINCT run, time_bucket(INTERVAL '5 minutes', ts) AS window_start FROM run JOIN parted ON part <= run),
        marks AS (SELECT run, date_trunc('millisecond', max(ts)) - INTERVAL '1 day' AS mark FROM run JOIN parted ON part <= run GROUP BY 1),
        judged AS (SELECT *, window_start + INTERVAL '5 minutes' > mark AS held FROM seen JOIN marks USING (run))
        SELECT run, count(*) AS n_seen, count(*) FILTER (NOT held) AS n_closed, count(*) FILTER (held) AS n_held,
          min(window_start) FILTER (held) AS oldest_held
        FROM judged GROUP BY 1""",
    "state_last_known": f"""WITH {SILVER}, known AS ({LAST_KNOWN}),
        held AS (
          SELECT DISTINCT sensor_id FROM silver
          WHERE time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day'
            > (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL '1 day' FROM silver))
        SELECT known.*, sensor_id IN (SELECT sensor_id FROM held) AS held FROM known""",
    "silver_dedup_stored": f"""WITH {SILVER}
        SELECT * FROM silver UNION ALL SELECT * REPLACE (event_time + INTERVAL '60 days' AS event_time) FROM silver""",
    "silver_quarantine": f"""WITH {READINGS}, {PARTS}, judged AS (
          SELECT {FIELDS}, 'plant_readings' AS topic, {REASON} AS reason, part AS batch_id FROM parted)
        SELECT * FROM judged WHERE reason <> 'accepted'""",
    "silver_epochs": f"""WITH {READINGS}, {PARTS}, judged AS (SELECT part, {REASON} = 'accepted' AS good FROM parted)
        SELECT part AS batch_id, count(*) AS n_read, count(*) FILTER (good) AS n_accepted,
          count(*) FILTER (NOT good) AS n_rejected, CAST(0 AS BIGINT) AS n_copies
        FROM judged GROUP BY 1""",
    "sink_compacted": f"WITH {BRONZE} SELECT *, 1 AS n_folders FROM bronze",
    "profile_footers": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({name}) AS n_nulls, "
        + ", ".join(f"CAST({f'{end}({name})' if kind == 'bigint' else 'NULL'} AS VARCHAR) AS {end}_value" for end in ("min", "max"))
        + " FROM events"
        for name, kind in EVENT_FIELDS
    ),
    "mode_complete_counter": "SELECT count(*) AS n FROM events WHERE event_type = 'error'",
    "ingest_metrics": f"""WITH {READINGS}, {PARTS}
        SELECT part AS batch_id, count(*) AS rows_read, count(*) FILTER (device_id IS NOT NULL AND value >= 0) AS n_rows,
          CAST(1 AS BIGINT) AS n_files, 0 AS n_missing
        FROM parted GROUP BY 1""",
}

for _name in (
    "src_json_schema", "src_json_stream", "src_csv_stream", "src_kafka_decode",
    "replay_to_messages", "fn_to_json_roundtrip", "mode_append",
):
    ORACLE_SQL[_name] = ALL_READINGS
for _name in ("bronze_clean", "src_table_scan", "sink_append_table", "sink_resume", "sink_exactly_once"):
    ORACLE_SQL[_name] = ALL_BRONZE
for _name in ("silver_valid", "silver_dedup", "layer_silver", "replay_from_raw", "replay_between_streams"):
    ORACLE_SQL[_name] = ALL_SILVER
