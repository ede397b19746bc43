from .base import no_nan

NEAR = """
near AS (
  SELECT f.failure, t.volt, t.rotate, t.pressure, t.vibration,
         dense_rank() OVER (PARTITION BY f.machineID, f.datetime, f.failure
                            ORDER BY t.datetime DESC) AS nth
  FROM pdm_failures f JOIN pdm_telemetry t ON t.machineID = f.machineID
   AND f.datetime - t.datetime BETWEEN INTERVAL 0 HOUR AND INTERVAL 72 HOUR
)
"""


def _label_corr(source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS sensor, {no_nan(f'corr({c}, y)')} AS correlation_with_failure FROM {source}"
        for c, name in (
            ("volt", "voltage"),
            ("rotate", "rotation"),
            ("pressure", "pressure"),
            ("vibration", "vibration"),
        )
    )


SQL = {
    "survival_summary": """
s AS (
  SELECT coalesce((epoch_us(min(datetime)) - epoch_us(TIMESTAMP '2024-01-01')) / 3600000000.0::DOUBLE, 720) AS h
  FROM pdm_machines LEFT JOIN pdm_failures USING (machineID) GROUP BY machineID
)
---
SELECT 100.0::DOUBLE * count(*) FILTER (WHERE h > 168) / count(*) AS pct_survive_168hr,
       100.0::DOUBLE * count(*) FILTER (WHERE h > 336) / count(*) AS pct_survive_336hr,
       100.0::DOUBLE * count(*) FILTER (WHERE h > 504) / count(*) AS pct_survive_504hr,
       100.0::DOUBLE * count(*) FILTER (WHERE h > 672) / count(*) AS pct_survive_672hr,
       avg(h) AS mean_survival_hours, quantile_cont(h, 0.5) AS median_survival_hours
FROM s
""",
    "survival_curve": """
lives AS (
  SELECT machineID, coalesce(model, '') AS model, min(datetime) IS NULL AS censored,
         coalesce((epoch_us(min(datetime)) - epoch_us(TIMESTAMP '2024-01-01')) / 3600000000.0::DOUBLE, 720) AS h
  FROM pdm_machines LEFT JOIN pdm_failures USING (machineID) GROUP BY machineID, model
),
steps AS (
  SELECT model, h, count(*) AS lives, count(*) FILTER (WHERE NOT censored) AS d
  FROM (SELECT model, h, censored FROM lives UNION ALL SELECT 'fleet', h, censored FROM lives)
  GROUP BY model, h
),
risk AS (
  SELECT *, sum(lives) OVER (PARTITION BY model ORDER BY h DESC)::BIGINT AS n FROM steps
)
---
SELECT model, h AS time_hours, n AS at_risk, d AS events, lives - d AS censored,
       CASE WHEN min(n - d) OVER w = 0 THEN 0.0::DOUBLE
            ELSE exp(sum(CASE WHEN n > d THEN ln((n - d)::DOUBLE / n) ELSE 0 END) OVER w) END AS survival,
       CASE WHEN min(n - d) OVER w > 0
            THEN exp(2 * sum(CASE WHEN n > d THEN ln((n - d)::DOUBLE / n) ELSE 0 END) OVER w)
                 * sum(CASE WHEN n > d THEN d / (n::DOUBLE * (n - d)) ELSE 0 END) OVER w END AS variance
FROM risk WINDOW w AS (PARTITION BY model ORDER BY h)
""",
    "maintenance_forecast": """
g AS (
  SELECT comp, (epoch_us(datetime) - epoch_us(lag(datetime) OVER (
           PARTITION BY machineID, comp ORDER BY datetime))) / 3600000000.0::DOUBLE AS h
  FROM pdm_maint
)
---
SELECT comp AS component, count(*) AS sample_size, avg(h) AS avg_interval_hours,
       stddev_samp(h) AS std_interval_hours, avg(h) - 1.96::DOUBLE * stddev_samp(h) AS lower_95ci,
       avg(h) + 1.96::DOUBLE * stddev_samp(h) AS upper_95ci
FROM g WHERE h IS NOT NULL GROUP BY comp
""",
    "prefailure_profile": NEAR
    + """
---
SELECT failure, count(*) AS sample_count, avg(volt) AS avg_prefailure_voltage,
       avg(vibration) AS avg_prefailure_vibration, avg(rotate) AS avg_prefailure_rotation,
       avg(pressure) AS avg_prefailure_pressure, stddev_samp(vibration) AS std_prefailure_vibration
FROM near WHERE nth <= 72 GROUP BY failure
""",
    "prognostic_horizon": """
base AS (SELECT machineID, avg(vibration) AS m, nullif(stddev_samp(vibration), 0) AS s
         FROM pdm_telemetry WHERE datetime < TIMESTAMP '2024-01-15' GROUP BY machineID),
z AS (
  SELECT failure, (epoch_us(f.datetime) - epoch_us(t.datetime)) / 3600000000.0::DOUBLE AS h,
         coalesce(abs((vibration - m) / s), 0) > 2 AS odd
  FROM pdm_telemetry t JOIN base USING (machineID) JOIN pdm_failures f USING (machineID)
  WHERE t.datetime >= f.datetime - INTERVAL 168 HOUR AND t.datetime <= f.datetime - INTERVAL 1 HOUR
)
---
SELECT failure, avg(CASE WHEN odd THEN h END) AS avg_detection_horizon_hours,
       max(CASE WHEN odd THEN h END) AS max_detection_horizon_hours,
       count(CASE WHEN odd THEN 1 END) AS detectable_events
FROM z GROUP BY failure
""",
    "failure_correlation": """
m AS (
  SELECT t.*, CAST(f.machineID IS NOT NULL AS INTEGER) AS y
  FROM pdm_telemetry t LEFT JOIN pdm_failures f ON f.machineID = t.machineID
   AND f.datetime > t.datetime AND f.datetime <= t.datetime + INTERVAL 24 HOUR
)
---
"""
    + _label_corr("m"),
    "failure_correlation_once": """
m AS (
  SELECT t.*, CAST(EXISTS (SELECT 1 FROM pdm_failures f WHERE f.machineID = t.machineID
   AND f.datetime > t.datetime AND f.datetime <= t.datetime + INTERVAL 24 HOUR) AS INTEGER) AS y
  FROM pdm_telemetry t
)
---
"""
    + _label_corr("m"),
}
