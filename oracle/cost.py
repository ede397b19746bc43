REPAIRS = """
SELECT strftime(datetime, '%Y-%m') AS month,
       count(*) FILTER (WHERE comp <> 'other') AS emergency_repairs,
       count(*) FILTER (WHERE comp = 'other') AS planned_repairs,
       count(*) FILTER (WHERE comp <> 'other') * 111000.0::DOUBLE AS emergency_cost,
       count(*) FILTER (WHERE comp = 'other') * 34500.0::DOUBLE AS planned_cost,
       sum(CASE comp WHEN 'other' THEN 34500 ELSE 111000 END)::DOUBLE AS total_monthly_cost
FROM {rows} GROUP BY 1
"""

MACHINE_COST = """
SELECT *, annual_failure_cost + annual_planned_cost AS total_annual_cost FROM (
  SELECT machineID, failures, maintenance_events, failures * 111000.0::DOUBLE AS annual_failure_cost,
         maintenance_events * 2500.0::DOUBLE AS annual_planned_cost FROM c)
ORDER BY total_annual_cost DESC, machineID LIMIT 15
"""

SQL = {
    "monthly_tco": REPAIRS.format(rows="pdm_maint"),
    "monthly_tco_literal": """
doubled AS (
  SELECT m.datetime, m.comp FROM pdm_maint m LEFT JOIN pdm_failures f ON m.machineID = f.machineID
   AND date_trunc('month', m.datetime) = date_trunc('month', f.datetime)
)
---
"""
    + REPAIRS.format(rows="doubled"),
    "cost_per_failure_type": """
SELECT failure, count(*) AS occurrences, count(*) * 15000.0::DOUBLE AS emergency_repair_cost,
       count(*) * 96000.0::DOUBLE AS downtime_cost, count(*) * 111000.0::DOUBLE AS total_cost,
       count(*) * 100.0::DOUBLE / (SELECT count(*) FROM pdm_failures) AS pct_of_total_cost
FROM pdm_failures GROUP BY failure
""",
    "strategy_roi": """
n AS (SELECT count(*)::DOUBLE AS n FROM pdm_failures)
---
SELECT 'Reactive (Current)' AS strategy, n AS failure_events, n * 111000 AS annual_cost,
       CAST(0 AS DOUBLE) AS savings FROM n
UNION ALL
SELECT 'Predictive (ML-Driven)', n / 5, n * (0.8::DOUBLE * 34500 + 0.2::DOUBLE * 111000),
       n * 0.8::DOUBLE * 76500 FROM n
""",
    "sensor_investment": """
c AS (SELECT (SELECT count(DISTINCT machineID) FROM pdm_telemetry) AS n_machines,
             (SELECT count(*) FROM pdm_failures) AS f)
---
SELECT n_machines, n_machines * 20000.0::DOUBLE AS total_hardware_cost,
       50000::DOUBLE AS annual_software_cost, 120000::DOUBLE AS annual_personnel_cost,
       n_machines * 20000 / 3::DOUBLE + 170000 AS annualized_cost,
       f * 61200.0::DOUBLE AS gross_savings,
       f * 61200.0::DOUBLE - (n_machines * 20000 / 3::DOUBLE + 170000) AS net_savings_year1
FROM c
""",
    "cumulative_downtime_cost": """
m AS (SELECT CAST(date_trunc('month', datetime) AS TIMESTAMP) AS month, count(*) AS failures
      FROM pdm_failures GROUP BY 1)
---
SELECT month, failures, failures * 12.0::DOUBLE AS downtime_hours,
       failures * 96000.0::DOUBLE AS downtime_cost,
       (SELECT sum(failures) FROM m e WHERE e.month <= m.month) * 96000.0::DOUBLE AS cumulative_cost
FROM m
""",
    "cost_per_machine": """
c AS (
  SELECT machineID, count(*) AS failures,
         (SELECT count(*) FROM pdm_maint m WHERE m.machineID = f.machineID) AS maintenance_events
  FROM pdm_failures f GROUP BY machineID
)
---
"""
    + MACHINE_COST,
    "cost_per_machine_literal": """
c AS (
  SELECT f.machineID, count(*) AS failures, count(m.machineID) AS maintenance_events
  FROM pdm_failures f LEFT JOIN pdm_maint m ON m.machineID = f.machineID GROUP BY f.machineID
)
---
"""
    + MACHINE_COST,
    "conversion_savings": """
SELECT component, count(failure) AS failures, count(failure) * 61200.0::DOUBLE AS potential_savings
FROM (VALUES ('comp1'), ('comp2'), ('comp3'), ('comp4')) AS c(component)
LEFT JOIN pdm_failures ON failure = component GROUP BY component
""",
}
