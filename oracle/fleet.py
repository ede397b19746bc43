from .base import no_nan

RISK = """
SELECT machineID, historical_failures, avg_vibration, overdue_maintenance,
       0.4::DOUBLE * historical_failures
         + 0.3::DOUBLE * avg_vibration / (SELECT avg(vibration) FROM pdm_telemetry)
         + 0.3::DOUBLE * overdue_maintenance AS risk_score
FROM r ORDER BY risk_score DESC, machineID LIMIT 20
"""

MONTHS = """
SELECT CAST(t.month AS TIMESTAMP) AS month, active_machines, avg_vibration, {std} AS std_vibration,
       coalesce(mf, 0) AS machines_with_failures, coalesce(me, 0) AS machines_with_errors,
       coalesce(mf, 0) / (SELECT count(DISTINCT machineID) FROM pdm_telemetry)::DOUBLE AS failure_rate
FROM (SELECT date_trunc('month', datetime) AS month, count(DISTINCT machineID) AS active_machines,
             avg(vibration) AS avg_vibration, stddev_samp(vibration) AS sd,
             var_pop(vibration) AS vp, count(*)::DOUBLE AS n FROM pdm_telemetry GROUP BY 1) t
LEFT JOIN (SELECT date_trunc('month', datetime) AS month, count(DISTINCT machineID) AS mf,
                  count(*)::DOUBLE AS nf FROM pdm_failures GROUP BY 1) f USING (month)
LEFT JOIN (SELECT date_trunc('month', datetime) AS month, count(DISTINCT machineID) AS me,
                  count(*)::DOUBLE AS ne FROM pdm_errors GROUP BY 1) e USING (month)
"""

PRIORITY = """
SELECT machineID, any_value(model) AS model, any_value(age) AS age,
       {fails} AS total_failures, avg(vibration) AS recent_avg_vibration,
       (SELECT max(datetime) FROM pdm_failures f WHERE f.machineID = m.machineID) AS last_failure,
       {fails} * 0.5::DOUBLE + any_value(age) * 0.3::DOUBLE + avg(vibration) / 250 AS replacement_priority_score
FROM pdm_machines m JOIN pdm_telemetry t USING (machineID), now_
WHERE t.datetime >= as_of - INTERVAL 60 DAY
GROUP BY machineID ORDER BY replacement_priority_score DESC, machineID LIMIT 10
"""

KPI_LITERAL = """
SELECT count(DISTINCT t.machineID) AS total_machines, avg(volt) AS fleet_avg_voltage,
       avg(vibration) AS fleet_avg_vibration,
       count(DISTINCT f.machineID) AS machines_with_failures_30d,
       count(DISTINCT e.machineID) AS machines_with_errors_30d,
       100.0::DOUBLE * count(DISTINCT f.machineID) / count(DISTINCT t.machineID) AS pct_failed_30d
FROM (SELECT t.* FROM pdm_telemetry t, now_ WHERE datetime >= as_of - INTERVAL 7 DAY) t
LEFT JOIN (SELECT {distinct} machineID FROM pdm_failures, now_
           WHERE datetime >= as_of - INTERVAL 30 DAY) f ON t.machineID = f.machineID
LEFT JOIN (SELECT {distinct} machineID FROM pdm_errors, now_
           WHERE datetime >= as_of - INTERVAL 30 DAY) e ON t.machineID = e.machineID
"""

PEERS = """
prof AS (
  SELECT model, machineID, age, avg(vibration) AS avg_vibration,
         {fails} AS failure_count
  FROM pdm_machines m JOIN pdm_telemetry t USING (machineID), now_
  WHERE t.datetime >= as_of - INTERVAL 30 DAY GROUP BY model, machineID, age
)
---
SELECT *, (SELECT count(*) + 1 FROM prof o WHERE o.model = p.model AND o.avg_vibration > p.avg_vibration)
            AS vibration_rank_in_model,
       (SELECT count(*) + 1 FROM prof o WHERE o.model = p.model AND o.failure_count > p.failure_count)
            AS failure_rank_in_model
FROM prof p
"""
FAILS = "(SELECT count(*) FROM pdm_failures f WHERE f.machineID = m.machineID)"

SQL = {
    "risk_ranking": f"""
r AS (
  SELECT machineID, avg(vibration) AS avg_vibration,
         (SELECT count(*) FROM pdm_failures f WHERE f.machineID = t.machineID) AS historical_failures,
         CASE WHEN (SELECT max(datetime) FROM pdm_maint m WHERE m.machineID = t.machineID)
                   < any_value(as_of) - INTERVAL 7 DAY THEN 1 ELSE 0 END AS overdue_maintenance
  FROM pdm_telemetry t, now_ WHERE datetime >= as_of - INTERVAL 30 DAY GROUP BY machineID
)
---
{RISK}""",
    "risk_ranking_literal": f"""
r AS (
  SELECT t.machineID, avg(t.vibration) AS avg_vibration, count(f.machineID) AS historical_failures,
         CASE WHEN max(m.datetime) < any_value(as_of) - INTERVAL 7 DAY THEN 1 ELSE 0 END AS overdue_maintenance
  FROM (SELECT t.*, as_of FROM pdm_telemetry t, now_ WHERE datetime >= as_of - INTERVAL 30 DAY) t
  LEFT JOIN pdm_failures f ON t.machineID = f.machineID
  LEFT JOIN pdm_maint m ON t.machineID = m.machineID
  GROUP BY t.machineID
)
---
{RISK}""",
    "machine_similarity": f"""
kinds AS (SELECT DISTINCT machineID, failure FROM pdm_failures),
hourly AS (SELECT machineID, date_trunc('hour', datetime) AS hour, avg(vibration) AS v
           FROM pdm_telemetry GROUP BY 1, 2),
pairs AS (
  SELECT a.machineID, k.failure, a.hour, any_value(a.v) AS v, avg(b.v) AS other
  FROM kinds k JOIN hourly a USING (machineID)
  JOIN kinds o ON o.failure = k.failure AND o.machineID <> k.machineID
  JOIN hourly b ON b.machineID = o.machineID AND b.hour = a.hour
  GROUP BY a.machineID, k.failure, a.hour
)
---
SELECT machineID, any_value(model) AS model, failure,
       (SELECT count(*) - 1 FROM kinds k WHERE k.failure = p.failure) AS peer_machines,
       count(*) AS shared_hours, {no_nan('corr(v, other)')} AS vibration_correlation
FROM pairs p JOIN pdm_machines USING (machineID) GROUP BY machineID, failure
""",
    "similar_machines": f"""
kinds AS (SELECT DISTINCT machineID, failure FROM pdm_failures),
hourly AS (SELECT machineID, date_trunc('hour', datetime) AS hour, avg(vibration) AS v
           FROM pdm_telemetry GROUP BY 1, 2),
peers AS (SELECT DISTINCT b.machineID FROM kinds a JOIN kinds b USING (failure)
          WHERE a.machineID = 3 AND b.machineID <> 3),
same AS (
  SELECT b.machineID, {no_nan('corr(b.v, a.v)')} AS vibration_correlation
  FROM hourly a JOIN hourly b USING (hour) WHERE a.machineID = 3 GROUP BY b.machineID
)
---
SELECT CAST(3 AS BIGINT) AS machine_a, p.machineID AS machine_b,
       (SELECT model FROM pdm_machines WHERE machineID = 3) AS model_a, m.model AS model_b,
       vibration_correlation
FROM peers p JOIN pdm_machines m USING (machineID) LEFT JOIN same s USING (machineID)
""",
    "utilisation": """
SELECT CAST(date_trunc('hour', datetime) AS TIMESTAMP) AS hour,
       count(DISTINCT machineID) AS machines_reporting,
       100.0::DOUBLE * count(DISTINCT machineID)
         / (SELECT count(DISTINCT machineID) FROM pdm_telemetry) AS pct_fleet_reporting
FROM pdm_telemetry GROUP BY 1
""",
    "monthly_fleet_summary": MONTHS.format(std="sd"),
    # every reading of a month repeats nf * ne times in the literal join
    "monthly_fleet_summary_literal": MONTHS.format(
        std="sqrt(vp * (n * coalesce(nf, 1) * coalesce(ne, 1))"
        " / (n * coalesce(nf, 1) * coalesce(ne, 1) - 1))"
    ),
    "replacement_priority": PRIORITY.format(fails=FAILS),
    "replacement_priority_literal": PRIORITY.format(fails=f"least(1, {FAILS})"),
    "fleet_kpis": KPI_LITERAL.format(distinct="DISTINCT"),
    "fleet_kpis_literal": KPI_LITERAL.format(distinct=""),
    "peer_ranking": PEERS.format(fails=FAILS),
    "peer_ranking_literal": PEERS.format(fails=f"{FAILS} * count(*)"),
}
