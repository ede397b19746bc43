from .base import no_nan

SQL = {
    "failures_by_component": """
SELECT failure, count(*) AS failure_count,
       count(*) * 100.0::DOUBLE / (SELECT count(*) FROM pdm_failures) AS pct_of_total
FROM pdm_failures GROUP BY failure
""",
    "monthly_failures": """
SELECT CAST(date_trunc('month', datetime) AS TIMESTAMP) AS month, failure, count(*) AS failure_count
FROM pdm_failures GROUP BY ALL
""",
    "mtbf": """
g AS (
  SELECT machineID, (epoch_us(datetime) - epoch_us(lag(datetime) OVER (
           PARTITION BY machineID ORDER BY datetime, failure))) / 3600000000.0::DOUBLE AS h
  FROM pdm_failures
)
---
SELECT machineID, count(h) AS total_failures, avg(h) AS mtbf_hours, avg(h) / 24 AS mtbf_days,
       min(h) AS min_time_between, max(h) AS max_time_between
FROM g GROUP BY machineID HAVING count(h) > 0 ORDER BY mtbf_hours, machineID LIMIT 15
""",
    "weibull_fit": f"""
r AS (
  SELECT row_number() OVER (PARTITION BY machineID ORDER BY datetime, failure) AS k,
         (epoch_us(datetime) - min(epoch_us(datetime)) OVER (PARTITION BY machineID))
           / 3600000000.0::DOUBLE AS h
  FROM pdm_failures
),
pts AS (SELECT ln(h) AS x, ln(-ln(1 - k / ((SELECT count(*) FROM r WHERE h > 0) + 1.0::DOUBLE))) AS y
        FROM r WHERE h > 0),
fit AS (SELECT {no_nan('regr_slope(y, x)')} AS b, {no_nan('regr_intercept(y, x)')} AS a FROM pts)
---
SELECT b AS weibull_shape_beta, exp(-a / nullif(b, 0)) AS weibull_scale_eta_hours FROM fit
""",
    "failure_rate_by_model": """
SELECT model, count(DISTINCT m.machineID) AS machine_count, count(f.machineID) AS total_failures,
       count(f.machineID) / count(DISTINCT m.machineID)::DOUBLE AS failures_per_machine,
       count(f.machineID) / count(DISTINCT m.machineID)::DOUBLE / 1 AS failures_per_machine_per_month
FROM pdm_machines m LEFT JOIN pdm_failures f USING (machineID) GROUP BY model
""",
    "failure_sequences": """
s AS (
  SELECT machineID, datetime AS failure_time, failure AS current_failure,
         lead(failure) OVER w AS next_failure, lead(datetime) OVER w AS nxt
  FROM pdm_failures WINDOW w AS (PARTITION BY machineID ORDER BY datetime, failure)
)
---
SELECT machineID, failure_time, current_failure, next_failure,
       (epoch_us(nxt) - epoch_us(failure_time)) / 3600000000.0::DOUBLE AS hours_until_next
FROM s WHERE nxt IS NOT NULL
ORDER BY hours_until_next, machineID, failure_time, current_failure, next_failure LIMIT 20
""",
    "problem_machines": """
SELECT machineID, model, age, count(*) AS failure_count, min(datetime) AS first_failure,
       max(datetime) AS last_failure,
       CAST(date_part('day', max(datetime) - min(datetime)) AS BIGINT) AS days_between_first_last
FROM pdm_failures JOIN pdm_machines USING (machineID) GROUP BY machineID, model, age
ORDER BY failure_count DESC, machineID LIMIT 10
""",
    "failure_cascade": """
SELECT machineID, datetime AS failure_time,
       string_agg(DISTINCT failure, ', ' ORDER BY failure) AS failed_components,
       count(DISTINCT failure) AS components_affected
FROM pdm_failures GROUP BY machineID, datetime HAVING count(DISTINCT failure) > 1
""",
    "failure_cascade_within": """
SELECT a.machineID, a.datetime AS failure_time,
       string_agg(DISTINCT b.failure, ', ' ORDER BY b.failure) AS failed_components,
       count(DISTINCT b.failure) AS components_affected
FROM pdm_failures a JOIN pdm_failures b ON a.machineID = b.machineID
 AND b.datetime BETWEEN a.datetime - INTERVAL 24 HOUR AND a.datetime + INTERVAL 24 HOUR
GROUP BY a.machineID, a.datetime HAVING count(DISTINCT b.failure) > 1
""",
    "failures_by_age": """
joined AS (
  SELECT m.machineID, f.machineID AS failed,
         CASE WHEN age <= 0 THEN '0 years' WHEN age <= 5 THEN '1-5 years'
              WHEN age <= 10 THEN '6-10 years' WHEN age <= 15 THEN '11-15 years'
              ELSE '15+ years' END AS age_group
  FROM pdm_machines m LEFT JOIN pdm_failures f USING (machineID)
)
---
SELECT age_group, count(DISTINCT machineID) AS total_machines,
       count(DISTINCT failed) AS machines_with_failures, count(failed) AS total_failure_events,
       count(failed) / count(DISTINCT machineID)::DOUBLE AS failures_per_machine
FROM joined GROUP BY age_group
""",
    "failures_by_weekday": """
SELECT CAST(date_part('dow', datetime) AS BIGINT) AS day_of_week, dayname(datetime) AS day_name,
       count(*) AS failure_count
FROM pdm_failures GROUP BY 1, 2
""",
}
SQL["failures_by_age_literal"] = (
    SQL["failures_by_age"]
    .replace("count(failed) AS", "count(*) AS")
    .replace("count(failed) /", "count(*) /")
)
