SQL = {
    "reactive_ratio": """
SELECT CASE WHEN comp LIKE 'comp%' THEN 'Reactive (Unscheduled)' ELSE 'Planned (Scheduled)' END
         AS maintenance_type,
       count(*) AS event_count, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM pdm_maint) AS pct
FROM pdm_maint GROUP BY 1
""",
    "error_to_failure": """
SELECT e.machineID, e.datetime AS error_time, f.datetime AS failure_time,
       (epoch_us(f.datetime) - epoch_us(e.datetime)) / 3600000000.0::DOUBLE AS hours_error_to_failure,
       errorID, failure
FROM pdm_errors e JOIN pdm_failures f ON e.machineID = f.machineID
WHERE f.datetime - e.datetime > INTERVAL 0 HOUR AND e.datetime >= f.datetime - INTERVAL 168 HOUR
""",
    "error_to_failure_machine": """
SELECT e.machineID, e.datetime AS error_time, f.datetime AS failure_time,
       (epoch_us(f.datetime) - epoch_us(e.datetime)) / 3600000000.0::DOUBLE AS hours_error_to_failure,
       errorID, failure
FROM pdm_errors e JOIN pdm_failures f ON e.machineID = f.machineID
WHERE e.machineID = 12 AND f.datetime > e.datetime AND e.datetime >= f.datetime - INTERVAL 168 HOUR
""",
    "error_outcomes": """
e AS (SELECT *, row_number() OVER () AS id FROM pdm_errors)
---
SELECT e.machineID, e.datetime AS error_time, errorID,
       count(*) FILTER (WHERE f.datetime <= e.datetime + INTERVAL 168 HOUR) AS failures_within,
       min(f.datetime) AS next_failure,
       (epoch_us(min(f.datetime)) - epoch_us(e.datetime)) / 3600000000.0::DOUBLE AS hours_to_failure,
       coalesce(min(f.datetime) <= e.datetime + INTERVAL 168 HOUR, false) AS is_precursor
FROM e LEFT JOIN pdm_failures f ON f.machineID = e.machineID AND f.datetime > e.datetime
GROUP BY id, e.machineID, e.datetime, errorID
""",
    "maintenance_effectiveness": """
SELECT m.machineID, m.datetime AS maintenance_date, m.comp AS maintained_component,
       count(*) AS failures_within, min(f.datetime) AS first_subsequent_failure,
       (epoch_us(min(f.datetime)) - epoch_us(m.datetime)) / 3600000000.0::DOUBLE AS hours_to_failure
FROM pdm_maint m JOIN pdm_failures f ON m.machineID = f.machineID
 AND f.datetime > m.datetime AND f.datetime <= m.datetime + INTERVAL 7 DAY
GROUP BY m.machineID, m.datetime, m.comp
""",
    "replacement_cost": """
SELECT comp, count(*) AS replacements,
       sum(CASE comp WHEN 'other' THEN 34500 ELSE 111000 END)::DOUBLE AS total_cost,
       avg(CASE comp WHEN 'other' THEN 34500 ELSE 111000 END)::DOUBLE AS avg_cost_per_replacement
FROM pdm_maint GROUP BY comp
""",
    "maintenance_intervals": """
g AS (
  SELECT machineID, comp, (epoch_us(datetime) - epoch_us(lag(datetime) OVER (
           PARTITION BY machineID ORDER BY datetime, comp))) / 3600000000.0::DOUBLE AS h
  FROM pdm_maint
)
---
SELECT machineID, comp, count(*) AS maintenance_count, avg(h) AS avg_hours_between,
       min(h) AS min_hours_between, max(h) AS max_hours_between
FROM g WHERE h IS NOT NULL GROUP BY machineID, comp
ORDER BY avg_hours_between, machineID, comp LIMIT 20
""",
    "replacement_frequency": """
SELECT comp AS component, count(*) AS replacement_count, count(DISTINCT machineID) AS machines_affected,
       (epoch_us(max(datetime)) - epoch_us(min(datetime))) / 86400000000.0::DOUBLE
         / nullif(count(*) - 1, 0) AS avg_days_between_replacements
FROM pdm_maint GROUP BY comp
""",
    "overdue_maintenance": """
lastm AS (SELECT machineID, max(datetime) AS last_maintenance FROM pdm_maint GROUP BY machineID)
---
SELECT machineID, last_maintenance,
       CAST(date_part('day', as_of - last_maintenance) AS BIGINT) AS days_since_last, model, age
FROM pdm_machines LEFT JOIN lastm USING (machineID), now_
WHERE last_maintenance IS NULL OR as_of - last_maintenance > INTERVAL 7 DAY
""",
    "monthly_downtime": """
SELECT CAST(date_trunc('month', datetime) AS TIMESTAMP) AS month, count(*) AS maintenance_events,
       count(*) * 4.0::DOUBLE AS planned_downtime_hours,
       sum(CASE WHEN comp = 'other' THEN 4 ELSE 12 END)::DOUBLE AS estimated_downtime_hours
FROM pdm_maint GROUP BY 1
""",
}
