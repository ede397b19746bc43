from .base import no_nan

WEEK_1 = "datetime BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-08'"


def _corr(a: str, b: str) -> str:
    return no_nan(f"corr({a}, {b})")


LATEST_Z = """
month AS (
  SELECT machineID, avg(volt) AS mv, nullif(stddev_samp(volt), 0) AS sv,
         avg(vibration) AS mx, nullif(stddev_samp(vibration), 0) AS sx
  FROM pdm_telemetry, now_ WHERE datetime >= as_of - INTERVAL 30 DAY GROUP BY machineID
),
newest AS (
  SELECT machineID, datetime, volt, vibration FROM pdm_telemetry, now_
  WHERE datetime >= as_of - INTERVAL 7 DAY
  QUALIFY row_number() OVER (PARTITION BY machineID ORDER BY datetime DESC) = 1
),
z AS (
  SELECT machineID, datetime AS last_reading, volt AS current_voltage,
         vibration AS current_vibration,
         abs(volt - mv) / sv AS volt_zscore, abs(vibration - mx) / sx AS vib_zscore
  FROM newest JOIN month USING (machineID)
),
health_now AS (
  SELECT *, CASE WHEN coalesce(volt_zscore, 0) > 3 OR coalesce(vib_zscore, 0) > 3 THEN 'CRITICAL'
              WHEN coalesce(volt_zscore, 0) > 2 OR coalesce(vib_zscore, 0) > 2 THEN 'WARNING'
              ELSE 'HEALTHY' END AS health_status
  FROM z
)
"""

DRIFT = f"""
drift AS (
  SELECT machineID, avg(vibration) FILTER (WHERE {WEEK_1}) AS baseline_vibration,
         avg(vibration) FILTER (WHERE datetime >= TIMESTAMP '2024-01-23') AS recent_vibration
  FROM pdm_telemetry GROUP BY machineID
)
"""

SQL = {
    "health_score": LATEST_Z + "---\nSELECT * FROM health_now",
    "vibration_drift": DRIFT
    + """
---
SELECT *, recent_vibration - baseline_vibration AS vibration_drift,
       100.0::DOUBLE * (recent_vibration - baseline_vibration) / baseline_vibration AS pct_increase
FROM drift WHERE recent_vibration > baseline_vibration
ORDER BY vibration_drift DESC, machineID LIMIT 15
""",
    "degradation_rate": """
fit AS (
  SELECT machineID, count(*) AS data_points,
         regr_slope(vibration, epoch_us(datetime) / 3600000000.0::DOUBLE) AS b
  FROM pdm_telemetry GROUP BY machineID
)
---
SELECT machineID, data_points, b AS vib_degradation_per_hour, b * 8760 AS vib_degradation_per_year
FROM fit WHERE data_points > 30
""",
    "weekly_anomalies": """
scored AS (
  SELECT machineID, datetime, abs(vibration - avg(vibration) OVER d)
           > 3 * nullif(stddev_samp(vibration) OVER d, 0) AS odd
  FROM pdm_telemetry WINDOW d AS (PARTITION BY machineID, date_trunc('day', datetime))
)
---
SELECT machineID, CAST(date_trunc('week', datetime) AS TIMESTAMP) AS week,
       count(*) FILTER (WHERE odd) AS anomaly_count
FROM scored GROUP BY 1, 2
""",
    "never_failed": """
SELECT machineID, any_value(model) AS model, any_value(age) AS age, count(*) AS telemetry_records
FROM pdm_machines JOIN pdm_telemetry USING (machineID)
WHERE machineID NOT IN (SELECT machineID FROM pdm_failures)
GROUP BY machineID
""",
    "anomaly_leaders": f"""
base AS (SELECT machineID, avg(vibration) AS m, nullif(stddev_samp(vibration), 0) AS s
         FROM pdm_telemetry WHERE {WEEK_1} GROUP BY machineID)
---
SELECT machineID, count(*) FILTER (WHERE abs(vibration - m) > 3 * s) AS anomaly_count,
       100.0::DOUBLE * count(*) FILTER (WHERE abs(vibration - m) > 3 * s) / count(*) AS anomaly_rate_pct
FROM pdm_telemetry JOIN base USING (machineID) GROUP BY machineID
HAVING anomaly_count > 0 ORDER BY anomaly_count DESC, machineID LIMIT 10
""",
    "anomaly_leaders_global": """
base AS (SELECT machineID, avg(vibration) AS m, stddev_samp(vibration) AS s
         FROM pdm_telemetry WHERE datetime < TIMESTAMP '2024-01-15' GROUP BY machineID)
---
SELECT machineID, count(*) AS anomaly_count,
       100.0::DOUBLE * count(*) / (SELECT count(*) FROM pdm_telemetry) AS anomaly_rate_pct
FROM pdm_telemetry JOIN base USING (machineID) WHERE abs(vibration - m) > 3 * s
GROUP BY machineID ORDER BY anomaly_count DESC, machineID LIMIT 10
""",
    "rolling_daily_trend": """
daily AS (
  SELECT machineID, CAST(date_trunc('day', datetime) AS TIMESTAMP) AS day,
         avg(vibration) AS daily_avg_vibration
  FROM pdm_telemetry GROUP BY 1, 2
)
---
SELECT *, avg(daily_avg_vibration) OVER (PARTITION BY machineID ORDER BY day
          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7day_avg FROM daily
""",
    "sensor_correlation": f"""
c AS (
  SELECT machineID, {_corr('volt', 'vibration')} AS volt_vib_correlation,
         {_corr('rotate', 'vibration')} AS rotate_vib_correlation,
         {_corr('pressure', 'vibration')} AS pressure_vib_correlation,
         {_corr('volt', 'pressure')} AS volt_pressure_correlation
  FROM pdm_telemetry GROUP BY machineID
)
---
SELECT * FROM c WHERE volt_vib_correlation IS NOT NULL
""",
    "threshold_exceedance": """
lim AS (
  SELECT machineID, avg(vibration) + 3 * stddev_samp(vibration) AS threshold FROM pdm_telemetry
  WHERE datetime >= TIMESTAMP '2024-01-01' AND datetime <= TIMESTAMP '2024-01-15' GROUP BY machineID
)
---
SELECT machineID, count(*) AS exceedances, max(vibration) AS max_vibration, threshold
FROM pdm_telemetry JOIN lim USING (machineID), now_
WHERE datetime >= as_of - INTERVAL 24 HOUR AND vibration > threshold
GROUP BY machineID, threshold
""",
    "health_mix": """
lvl AS (
  SELECT machineID, arg_max(vibration, datetime) AS x,
         avg(vibration) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') AS m,
         stddev_samp(vibration) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') AS s
  FROM pdm_telemetry GROUP BY machineID HAVING m IS NOT NULL
),
named AS (SELECT CASE WHEN x > m + 3 * s THEN 'Critical' WHEN x > m + 2 * s THEN 'Warning'
                      ELSE 'Healthy' END AS health_status FROM lvl)
---
SELECT health_status, count(*) AS machine_count,
       100.0::DOUBLE * count(*) / (SELECT count(*) FROM named) AS pct
FROM named GROUP BY health_status
""",
    "spike_detection": """
mean30 AS (SELECT machineID, avg(vibration) AS running_avg FROM pdm_telemetry, now_
           WHERE datetime >= as_of - INTERVAL 30 DAY GROUP BY machineID)
---
SELECT machineID, datetime, vibration AS current_vib, running_avg,
       vibration / running_avg AS spike_ratio
FROM pdm_telemetry JOIN mean30 USING (machineID), now_
WHERE datetime >= as_of - INTERVAL 24 HOUR AND vibration > 2 * running_avg
""",
    "operating_hours": """
SELECT machineID, count(*) AS total_hours_operated, min(datetime) AS first_recorded,
       max(datetime) AS last_recorded,
       CAST(date_part('day', max(datetime) - min(datetime)) AS BIGINT) AS days_in_service
FROM pdm_telemetry GROUP BY machineID
""",
}
