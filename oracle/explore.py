from .base import no_nan  # noqa: F401

SENSOR_LIST = ("volt", "rotate", "pressure", "vibration")

SQL = {
    "table_counts": """
SELECT n AS table_name, c AS row_count FROM (
  VALUES ('telemetry', (SELECT count(*) FROM pdm_telemetry)),
         ('errors', (SELECT count(*) FROM pdm_errors)),
         ('maintenance', (SELECT count(*) FROM pdm_maint)),
         ('failures', (SELECT count(*) FROM pdm_failures)),
         ('machines', (SELECT count(*) FROM pdm_machines))) AS v(n, c)
""",
    "coverage": """
SELECT min(datetime) AS first_reading, max(datetime) AS last_reading,
       count(DISTINCT CAST(datetime AS DATE)) AS days_covered,
       count(DISTINCT machineID) AS machines_with_data,
       count(*) AS total_readings,
       count(*) / count(DISTINCT machineID) AS avg_readings_per_machine
FROM pdm_telemetry
""",
    "missing_hours": """
slots AS (
  SELECT machineID, unnest(generate_series(
           CAST(CAST(min(datetime) AS DATE) AS TIMESTAMP),
           CAST(CAST(max(datetime) AS DATE) AS TIMESTAMP), INTERVAL 1 HOUR)) AS slot
  FROM pdm_telemetry GROUP BY machineID
),
both_counts AS (
  SELECT s.machineID, s.n AS expected_readings, a.n AS actual_readings
  FROM (SELECT machineID, count(*) AS n FROM slots GROUP BY 1) s
  JOIN (SELECT machineID, count(*) AS n FROM pdm_telemetry GROUP BY 1) a USING (machineID)
)
---
SELECT *, expected_readings - actual_readings AS missing_readings,
       100.0::DOUBLE * (expected_readings - actual_readings) / expected_readings AS pct_missing
FROM both_counts WHERE expected_readings <> actual_readings
ORDER BY missing_readings DESC, machineID LIMIT 20
""",
    "missing_hours_to_last": """
per AS (
  SELECT machineID, count(*) AS actual_readings,
         date_diff('hour', date_trunc('day', min(datetime)), date_trunc('hour', max(datetime))) + 1
           AS expected_readings
  FROM pdm_telemetry GROUP BY machineID
)
---
SELECT machineID, expected_readings, actual_readings,
       expected_readings - actual_readings AS missing_readings,
       100.0::DOUBLE * (expected_readings - actual_readings) / expected_readings AS pct_missing
FROM per WHERE expected_readings <> actual_readings
""",
    "age_distribution": """
banded AS (
  SELECT CASE WHEN age <= 0 THEN 'New (0 years)' WHEN age <= 5 THEN '1-5 years'
              WHEN age <= 10 THEN '6-10 years' WHEN age <= 15 THEN '11-15 years'
              ELSE '15+ years' END AS age_group
  FROM pdm_machines
)
---
SELECT age_group, count(*) AS machine_count,
       100.0::DOUBLE * count(*) / (SELECT count(*) FROM pdm_machines) AS pct
FROM banded GROUP BY age_group
""",
    "sensor_summary": """
long AS (UNPIVOT (SELECT volt, rotate, pressure, vibration FROM pdm_telemetry)
         ON volt, rotate, pressure, vibration INTO NAME sensor VALUE x)
---
SELECT sensor, min(x) AS min_val, max(x) AS max_val, avg(x) AS avg_val, stddev_samp(x) AS std_val
FROM long GROUP BY sensor
""",
    "model_distribution": """
SELECT model, count(*) AS machine_count, avg(age) AS avg_age_years
FROM pdm_machines GROUP BY model
""",
    "machines_per_model": """
SELECT model, count(*) AS machine_count
FROM (SELECT DISTINCT model, machineID FROM pdm_machines) GROUP BY model
""",
    "sigma_outliers": """
scored AS (
  SELECT machineID, datetime,
    abs(volt - avg(volt) OVER ()) > 3 * stddev_samp(volt) OVER () AS a,
    abs(rotate - avg(rotate) OVER ()) > 3 * stddev_samp(rotate) OVER () AS b,
    abs(pressure - avg(pressure) OVER ()) > 3 * stddev_samp(pressure) OVER () AS c,
    abs(vibration - avg(vibration) OVER ()) > 3 * stddev_samp(vibration) OVER () AS d
  FROM pdm_telemetry
)
---
SELECT machineID, datetime,
       CASE WHEN a THEN 'VOLTAGE_OUTLIER' END AS volt_flag,
       CASE WHEN b THEN 'ROTATION_OUTLIER' END AS rot_flag,
       CASE WHEN c THEN 'PRESSURE_OUTLIER' END AS pres_flag,
       CASE WHEN d THEN 'VIBRATION_OUTLIER' END AS vib_flag
FROM scored WHERE a OR b OR c OR d ORDER BY datetime DESC, machineID LIMIT 100
""",
}
