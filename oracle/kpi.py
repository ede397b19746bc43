from .evaluation import CM, RATES
from .health import DRIFT, LATEST_Z
from .maintenance import SQL as MAINTENANCE  # noqa: F401

SCORES = LATEST_Z + """,
scores AS (
  SELECT machineID, last_reading, health_status,
         greatest(0, 1 - greatest(coalesce(volt_zscore, vib_zscore, 0), coalesce(vib_zscore, volt_zscore, 0)) / 5) AS health_score
  FROM health_now
),
banded AS (SELECT *, CASE WHEN health_score < 0.3 THEN 'High' WHEN health_score < 0.6 THEN 'Medium' ELSE 'Low' END AS risk_level
           FROM scores)
"""
READING_SCORES = """
rs AS (
  SELECT machineID, datetime, greatest(0, 1 - greatest(
      coalesce(abs(volt - avg(volt) OVER m) / nullif(stddev_samp(volt) OVER m, 0), 0),
      coalesce(abs(vibration - avg(vibration) OVER m) / nullif(stddev_samp(vibration) OVER m, 0), 0)) / 5) AS health_score
  FROM pdm_telemetry, now_ WHERE datetime >= as_of - INTERVAL 30 DAY
  WINDOW m AS (PARTITION BY machineID)
)
"""
BAND = "CASE WHEN health_score < 0.3 THEN 'High' WHEN health_score < 0.6 THEN 'Medium' ELSE 'Low' END AS risk_level"

YEARLY = """,
perf AS (SELECT {recall} AS r, {precision} AS pp FROM cm WHERE model = 'A'),
seg AS (SELECT model AS segment, count(DISTINCT m.machineID)::DOUBLE AS n, count(f.machineID) * 12.0::DOUBLE AS f
        FROM pdm_machines m LEFT JOIN pdm_failures f USING (machineID) GROUP BY model),
yearly AS (
  SELECT segment, n, f, r, pp, f * 111000 AS reactive, n * 12 * 34500 + 0.3::DOUBLE * f * 111000 AS preventive,
         f * r * 34500 + f * (1 - r) * 111000 + f * (1 - pp) / pp * r * 500 + n * 20000 / 3 + 170000 AS predictive
  FROM seg, perf
)
""".format(recall=RATES["recall"], precision=RATES["precision"])

SQL = {
    "health_pivot": READING_SCORES
    + "---\nSELECT machineID, strftime(datetime, '%Y-%m-%d') AS day, avg(health_score) AS health_score FROM rs GROUP BY 1, 2",
    "health_timeline": READING_SCORES
    + f""",
d AS (SELECT CAST(date_trunc('day', datetime) AS TIMESTAMP) AS day, avg(health_score) AS health_score FROM rs GROUP BY 1)
---
SELECT *, {BAND} FROM d""",
    "health_timeline_machines": READING_SCORES
    + f""",
d AS (SELECT machineID, CAST(date_trunc('day', datetime) AS TIMESTAMP) AS day, avg(health_score) AS health_score
      FROM rs GROUP BY 1, 2)
---
SELECT *, {BAND} FROM d""",
    "score_histogram": SCORES
    + """---
SELECT CAST(least(floor(health_score * 30), 29) AS BIGINT) AS bin, risk_level, count(*) AS machines,
       least(floor(health_score * 30), 29) / 30.0::DOUBLE AS bin_start
FROM banded GROUP BY ALL""",
    "machine_groups": SCORES
    + """---
SELECT (machineID // 10) * 10 AS machine_group, avg(health_score) AS health_score FROM scores GROUP BY 1""",
    "event_slice_trends": """
slice AS (
  SELECT f.machineID, f.datetime AS failure_time, t.volt, t.rotate, t.pressure, t.vibration,
         row_number() OVER (PARTITION BY f.machineID, f.datetime ORDER BY t.datetime) - 1 AS i
  FROM (SELECT DISTINCT machineID, datetime FROM pdm_failures) f JOIN pdm_telemetry t
    ON t.machineID = f.machineID AND t.datetime BETWEEN f.datetime - INTERVAL 168 HOUR AND f.datetime
),
long AS (UNPIVOT slice ON volt, rotate, pressure, vibration INTO NAME sensor VALUE x)
---
SELECT machineID, failure_time, sensor, count(*) AS points, regr_slope(x, i) AS slope,
       regr_intercept(x, i) AS intercept
FROM long GROUP BY 1, 2, 3 HAVING count(*) > 10""",
    "fleet_kpi_cards": SCORES
    + """,
gap AS (SELECT (epoch_us(datetime) - epoch_us(lag(datetime) OVER (PARTITION BY machineID ORDER BY datetime, failure)))
               / 3600000000.0::DOUBLE AS h FROM pdm_failures),
v AS (
  SELECT 1 - (SELECT sum(CASE comp WHEN 'other' THEN 4 ELSE 12 END) FROM pdm_maint, now_
              WHERE datetime >= as_of - INTERVAL 30 DAY) / (count(*) * 720.0::DOUBLE) AS availability,
         (SELECT avg(h) FROM gap) AS mtbf,
         (SELECT sum(CASE comp WHEN 'other' THEN 34500 ELSE 111000 END)::DOUBLE FROM pdm_maint, now_
          WHERE date_trunc('month', datetime) = date_trunc('month', as_of)) AS cost,
         (count(*) FILTER (WHERE health_status = 'CRITICAL'))::DOUBLE AS alarms,
         (count(*) FILTER (WHERE health_score < 0.6))::DOUBLE AS risk
  FROM scores
)
---
SELECT 'availability' AS kpi, availability AS value, CASE WHEN availability > 0.95 THEN 'good' ELSE 'warning' END AS status FROM v
UNION ALL SELECT 'mtbf_hours', mtbf, CASE WHEN mtbf > 1200 THEN 'good' ELSE 'warning' END FROM v
UNION ALL SELECT 'maintenance_cost_mtd', cost, CASE WHEN cost < 200000 THEN 'good' ELSE 'warning' END FROM v
UNION ALL SELECT 'active_alarms', alarms, CASE WHEN alarms > 10 THEN 'critical' ELSE 'good' END FROM v
UNION ALL SELECT 'machines_at_risk', risk, CASE WHEN risk > 15 THEN 'critical' ELSE 'warning' END FROM v""",
    "risk_bands": SCORES + "---\nSELECT machineID, last_reading, health_score, risk_level FROM banded",
    "risk_counts": SCORES
    + """---
SELECT risk_level, count(*) AS machines, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM banded) AS pct
FROM banded GROUP BY 1""",
    "at_risk_topk": SCORES
    + "---\nSELECT machineID, health_score FROM scores ORDER BY health_score, machineID LIMIT 10",
    "machine_card": f"""
{SCORES.strip()}, {READING_SCORES.strip()}
---
SELECT machineID, health_score, risk_level,
       (SELECT (epoch_us(any_value(as_of)) - epoch_us(max(datetime))) / 86400000000.0::DOUBLE
        FROM pdm_failures f, now_ WHERE f.machineID = b.machineID) AS days_since_failure,
       (SELECT count(*) FROM rs, now_ WHERE rs.machineID = b.machineID AND rs.health_score < 0.6
          AND datetime >= as_of - INTERVAL 7 DAY) AS sensor_anomalies_7d
FROM banded b""",
    "alerts": f"""
{LATEST_Z.strip()}, {DRIFT.strip()},
lim AS (SELECT machineID, avg(vibration) + 3 * stddev_samp(vibration) AS top FROM pdm_telemetry
        WHERE datetime BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-15' GROUP BY machineID),
lastm AS (SELECT machineID, max(datetime) AS m FROM pdm_maint GROUP BY machineID)
---
SELECT 'critical' AS severity, machineID,
       printf('Reading %.1f deviations off its 30-day mean', greatest(volt_zscore, vib_zscore)) AS message
FROM health_now WHERE health_status = 'CRITICAL'
UNION ALL
SELECT 'warning', machineID, printf('%d vibration readings over the limit in 24 hours', count(*))
FROM pdm_telemetry JOIN lim USING (machineID), now_
WHERE datetime >= as_of - INTERVAL 24 HOUR AND vibration > top GROUP BY machineID
UNION ALL
SELECT 'warning', machineID, printf('Vibration %.1f%% above its baseline period',
       100.0::DOUBLE * (recent_vibration - baseline_vibration) / baseline_vibration)
FROM drift WHERE 100.0::DOUBLE * (recent_vibration - baseline_vibration) / baseline_vibration > 15
UNION ALL
SELECT 'info', machineID, printf('Last maintenance %d days ago', CAST(date_part('day', as_of - m) AS BIGINT))
FROM pdm_machines JOIN lastm USING (machineID), now_ WHERE m < as_of - INTERVAL 7 DAY""",
    "monthly_cost_by_strategy": """
m AS (SELECT CAST(date_trunc('month', datetime) AS TIMESTAMP) AS month, count(*)::DOUBLE AS n FROM pdm_failures GROUP BY 1)
---
SELECT month, n * 111000 AS reactive,
       (SELECT count(DISTINCT machineID) FROM pdm_telemetry) * 34500.0::DOUBLE + 0.3::DOUBLE * n * 111000 AS preventive,
       n * 0.8::DOUBLE * 34500 + n * 0.2::DOUBLE * 111000 AS predictive FROM m""",
    "cost_by_component": """
SELECT c.component,
       (SELECT count(*) FROM pdm_failures WHERE failure = c.component) * 111000.0::DOUBLE AS emergency_cost,
       (SELECT count(*) FROM pdm_maint WHERE comp = c.component) * 34500.0::DOUBLE AS planned_cost
FROM (SELECT failure AS component FROM pdm_failures UNION SELECT comp FROM pdm_maint) AS c""",
    "strategy_costs": CM
    + YEARLY
    + """---
SELECT segment, 'reactive' AS strategy, reactive AS annual_cost, reactive * 3 AS total_cost,
       f * 12 AS downtime_hours_per_year FROM yearly
UNION ALL SELECT segment, 'preventive', preventive, preventive * 3, n * 48 + 0.3::DOUBLE * f * 12 FROM yearly
UNION ALL SELECT segment, 'predictive', predictive, predictive * 3, f * r * 4 + f * (1 - r) * 12 FROM yearly""",
    "strategy_roi_summary": CM
    + YEARLY
    + """---
SELECT segment, 3 * (reactive - predictive) AS savings_vs_reactive,
       3 * (preventive - predictive) AS savings_vs_preventive,
       300 * (reactive - predictive) / (n * 20000 + 510000) AS roi_percentage,
       CASE WHEN reactive > predictive THEN 12 * (n * 20000 + 50000) / (reactive - predictive) ELSE 0 END AS payback_months
FROM yearly""",
    "roi_grid": """
seg AS (SELECT model AS segment, count(DISTINCT m.machineID)::DOUBLE AS n, count(f.machineID) * 12.0::DOUBLE AS f
        FROM pdm_machines m LEFT JOIN pdm_failures f USING (machineID) GROUP BY model),
grid AS (SELECT segment, n, f, a.range / 100.0::DOUBLE AS recall, b.range / 100.0::DOUBLE AS precision
         FROM seg, range(50, 100, 5) a, range(50, 100, 5) b)
---
SELECT segment, recall, precision,
       300 * (f * 111000 - (f * recall * 34500 + f * (1 - recall) * 111000
              + f * (1 - precision) / precision * recall * 500 + n * 20000 / 3 + 170000)) / (n * 20000 + 510000) AS roi_percentage
FROM grid""",
}
