from .features import _ewma
from .history import READINGS, label_ctes

SENSORS = ("volt", "rotate", "pressure", "vibration")
STATS = ", ".join(
    f"avg({s}) AS {s}_mean, stddev_samp({s}) AS {s}_std, min({s}) AS {s}_min, max({s}) AS {s}_max"
    for s in SENSORS
)


def _tumbling(width: str) -> str:
    return f"""
SELECT machineID, time_bucket(INTERVAL {width}, datetime) AS window_start,
       time_bucket(INTERVAL {width}, datetime) + INTERVAL {width} AS window_end,
       count(*) AS readings, {STATS}
FROM pdm_telemetry GROUP BY ALL
"""


def _rollup(unit: str) -> str:
    return f"""
SELECT machineID, CAST(date_trunc('{unit}', datetime) AS TIMESTAMP) AS window_start, count(*) AS readings, {STATS}
FROM pdm_telemetry GROUP BY machineID, 2
"""


ISLAND = """
gaps AS (
  SELECT *, datetime - lag(datetime) OVER w AS wait,
         CASE WHEN datetime - lag(datetime) OVER w <= INTERVAL 120 HOUR THEN 0 ELSE 1 END AS fresh
  FROM pdm_telemetry WINDOW w AS (PARTITION BY machineID ORDER BY datetime, event_id)
),
islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY machineID ORDER BY datetime, event_id) AS island FROM gaps
),
so_far AS (
  SELECT *, {lists}
  FROM islands WINDOW w AS (PARTITION BY machineID, island ORDER BY datetime, event_id)
)
---
SELECT machineID, datetime, len(volt_l) AS readings,
       CASE WHEN fresh = 0 THEN epoch_us(wait) / 3600000000.0::DOUBLE END AS hours_since_last, {means}
FROM so_far
""".format(
    lists=", ".join(f"list({s}) OVER w AS {s}_l" for s in SENSORS),
    means=", ".join(
        f"list_reduce({s}_l, lambda m, x: 0.1::DOUBLE * x + 0.9::DOUBLE * m) AS {s}_ewma" for s in SENSORS
    ),
)

ALERTS = """
base AS (SELECT machineID, avg(vibration) AS m, nullif(stddev_samp(vibration), 0) AS s
         FROM pdm_telemetry WHERE datetime < TIMESTAMP '2024-01-15' GROUP BY machineID),
z AS (
  SELECT machineID, datetime, event_id, abs((vibration - m) / s) AS z
  FROM pdm_telemetry LEFT JOIN base USING (machineID)
),
breaks AS (  -- an alert can't reach over a low score or a long silence
  SELECT *, coalesce(lag(z) OVER w < 0.75, false) OR coalesce(datetime - lag(datetime) OVER w > INTERVAL 168 HOUR, false) AS cut,
         lead(datetime) OVER w AS next_at
  FROM z WINDOW w AS (PARTITION BY machineID ORDER BY datetime, event_id)
),
parts AS (
  SELECT *, sum(cut::INT) OVER (PARTITION BY machineID ORDER BY datetime, event_id) AS part FROM breaks
),
risen AS (
  SELECT *, max((z > 1.5)::INT) OVER (PARTITION BY machineID, part ORDER BY datetime, event_id) AS up FROM parts
),
held AS (
  SELECT machineID, part, count(*) AS n, max(z) AS peak, min(datetime) AS raised, max(datetime) AS last_at,
         arg_min(z, (datetime, event_id)) AS first_z, arg_max(z, (datetime, event_id)) AS last_z,
         arg_max(next_at IS NOT NULL, (datetime, event_id)) AS goes_on
  FROM risen WHERE up = 1 GROUP BY machineID, part
),
mark AS (SELECT to_timestamp(floor(epoch_us(max(datetime)) / 1000) / 1000 - 3600)::TIMESTAMP AS at FROM pdm_telemetry)
---
SELECT machineID, raised AS at, 'raised' AS event, 1::BIGINT AS readings, first_z AS peak FROM held
UNION ALL
SELECT machineID, last_at, 'cleared', n, peak FROM held WHERE n > 1 AND last_z < 0.75
UNION ALL
SELECT machineID, last_at + INTERVAL 168 HOUR, 'timeout', n, peak FROM held, mark
WHERE coalesce(last_z >= 0.75, true) AND (goes_on OR last_at + INTERVAL 168 HOUR < mark.at)
"""


SQL = {
    "stream_rollup_daily": _rollup("day"),
    "stream_rollup_monthly": _rollup("month"),
    "stream_machine_state": ISLAND,
    "stream_alerts": ALERTS,
    "stream_tumbling": _tumbling("1 HOUR"),
    "stream_tumbling_5min": _tumbling("5 MINUTE"),
    "stream_downsample": _tumbling("24 HOUR"),
    "stream_sliding": f"""
hops AS (
  SELECT t.*, CAST(date_trunc('hour', datetime) AS TIMESTAMP) - to_hours(CAST(h.range AS BIGINT)) AS window_start
  FROM pdm_telemetry t, range(24) h
)
---
SELECT machineID, window_start, window_start + INTERVAL 24 HOUR AS window_end,
       count(*) AS readings, {STATS}
FROM hops GROUP BY machineID, window_start
""",
    "stream_prefilter": """
base AS (SELECT machineID, avg(vibration) AS m, nullif(stddev_samp(vibration), 0) AS s
         FROM pdm_telemetry WHERE datetime < TIMESTAMP '2024-01-15' GROUP BY machineID)
---
SELECT machineID, datetime, vibration, (vibration - m) / s AS zscore
FROM pdm_telemetry JOIN base USING (machineID) WHERE abs((vibration - m) / s) > 2
""",
    "stream_flags": """
base AS (SELECT machineID, avg(vibration) AS m, nullif(stddev_samp(vibration), 0) AS s
         FROM pdm_telemetry WHERE datetime < TIMESTAMP '2024-01-15' GROUP BY machineID)
---
SELECT machineID, datetime, vibration, (vibration - m) / s AS zscore,
       coalesce(abs((vibration - m) / s) > 2, false) AS is_odd
FROM pdm_telemetry LEFT JOIN base USING (machineID)
""",
    "stream_late_data": f"""
mark AS (SELECT epoch_ms(max(datetime)) - 3600000 AS ms FROM pdm_telemetry WHERE event_id % 10 <> 0),
hours AS (SELECT *, time_bucket(INTERVAL 1 HOUR, datetime) AS window_start FROM pdm_telemetry)
---
SELECT machineID, window_start, window_start + INTERVAL 1 HOUR AS window_end,
       count(*) AS readings, {STATS}
FROM hours, mark
WHERE event_id % 10 <> 0 OR epoch_ms(window_start + INTERVAL 1 HOUR) > ms
GROUP BY machineID, window_start
""",
    "stream_last_events": """
SELECT user_id AS machineID, max(ts) FILTER (WHERE event_type = 'error') AS last_error,
       max(ts) FILTER (WHERE event_type = 'purchase') AS last_purchase,
       max(ts) FILTER (WHERE event_type = 'signup') AS last_signup
FROM ev GROUP BY 1
""",
    "stream_sessions": """
mark AS (SELECT epoch_ms(max(datetime)) - 3600000 AS ms FROM pdm_telemetry),
cuts AS (
  SELECT *, coalesce(datetime - lag(datetime) OVER w > INTERVAL 2 HOUR, true) AS first
  FROM pdm_telemetry WINDOW w AS (PARTITION BY machineID ORDER BY datetime)
),
runs AS (
  SELECT *, sum(first::INT) OVER (PARTITION BY machineID ORDER BY datetime) AS run FROM cuts
),
ended AS (
  SELECT machineID, min(datetime) AS session_start, max(datetime) + INTERVAL 2 HOUR AS session_end,
         count(*) AS readings, avg(vibration) AS vibration_mean
  FROM runs GROUP BY machineID, run
)
---
SELECT ended.* FROM ended, mark WHERE epoch_us(session_end) <= ms * 1000
""",
    "stream_quality": """
SELECT DISTINCT machineID, datetime, volt IS NULL OR rotate IS NULL OR vibration IS NULL AS has_missing,
       volt < 0 OR rotate < 0 OR pressure < 0 OR vibration < 0 AS is_negative
FROM pdm_telemetry
""",
    "stream_ewma_state": _ewma(),
    "parquet_roundtrip": READINGS
    + "---\nSELECT *, strftime(timestamp, '%Y-%m-%d') AS date FROM readings",
    "csv_roundtrip": """
SELECT 'telemetry' AS source, datetime, machineID, CAST(NULL AS VARCHAR) AS what,
       volt + rotate + pressure + vibration AS x FROM pdm_telemetry
UNION ALL SELECT 'errors', datetime, machineID, errorID, NULL FROM pdm_errors
UNION ALL SELECT 'maint', datetime, machineID, comp, NULL FROM pdm_maint
UNION ALL SELECT 'failures', datetime, machineID, failure, NULL FROM pdm_failures
UNION ALL SELECT 'machines', NULL, machineID, model, age FROM pdm_machines
""",
    "time_series_folds": label_ctes()
    + """,
q AS (SELECT quantile_cont(CAST(epoch_us(timestamp) AS DOUBLE), [1/6::DOUBLE, 2/6::DOUBLE, 3/6::DOUBLE, 4/6::DOUBLE, 5/6::DOUBLE]) AS c
      FROM labels),
blocks AS (SELECT labels.*, len(list_filter(c, lambda x: x <= epoch_us(timestamp))) AS b FROM labels, q)
---
SELECT CAST(k.range AS INTEGER) AS fold, CASE WHEN b = k.range THEN 'test' ELSE 'train' END AS role,
       count(*) AS n, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp,
       CAST(sum(failure_label) AS BIGINT) AS positives
FROM blocks JOIN range(1, 6) k ON b <= k.range GROUP BY 1, 2
""",
}
