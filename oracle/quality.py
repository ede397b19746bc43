SENSORS = ("volt", "rotate", "pressure", "vibration")


def _row(name, passed, measured, bound, severity="'error'", subject="NULL"):
    return (
        f"SELECT '{name}' AS check_name, {passed} AS passed, ({measured})::DOUBLE AS measured, "
        f"{bound}::DOUBLE AS bound, ({subject})::VARCHAR AS subject, {severity} AS severity FROM a, g, d"
    )


def _validate() -> str:
    rows = [
        _row("required_columns", "true", "0", 0),
        _row("no_duplicates", "dupes = 0", "dupes", 0),
        _row("column_dtypes", "true", "0", 0),
        _row("completeness", "complete >= 0.95", "complete", 0.95),
        _row("machine_count", "machines = 100", "machines", 100),
    ]
    for s in SENSORS:
        own = f"'{s}'"
        rows.append(_row(f"positive_values_{s}", f"{s}_neg = 0", f"{s}_neg", 0, "'warning'", own))
        rows.append(_row(f"outlier_check_{s}", f"{s}_far <= 0.05", f"{s}_far", 0.05, "'warning'", own))
    gap = "CASE WHEN bad IS NULL THEN 'info' ELSE 'warning' END"
    rows += [
        _row("date_range", "year(first) >= 2015 AND hours <= 8760", "hours", 8760, "'info'"),
        _row("hourly_frequency", "bad IS NULL", "bad_share", 0.9, gap, "bad"),
        _row("monotonic_timestamps", "late = 0", "late", 0),
    ]
    stats = ", ".join(
        f"count(*) FILTER (WHERE {s} < 0) AS {s}_neg, "
        f"avg(CASE WHEN abs({s} - {s}_m) > 5 * {s}_d THEN 1.0::DOUBLE ELSE 0 END) AS {s}_far"
        for s in SENSORS
    )
    means = ", ".join(
        f"avg({s}) OVER () AS {s}_m, stddev_samp({s}) OVER () AS {s}_d" for s in SENSORS
    )
    return f"""
x AS (SELECT *, {means},
             lag(datetime) OVER (PARTITION BY machineID ORDER BY datetime) AS prev,
             max(datetime) OVER (PARTITION BY machineID ORDER BY event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM pdm_telemetry),
a AS (
  SELECT 1 - (count(*) * 7 - count(event_id) - count(machineID) - count(datetime) - count(volt)
              - count(rotate) - count(pressure) - count(vibration)) / (count(*) * 7.0::DOUBLE) AS complete,
         count(DISTINCT machineID) AS machines, min(datetime) AS first, max(datetime) AS last,
         (epoch_us(max(datetime)) - epoch_us(min(datetime))) / 3600000000.0::DOUBLE AS hours,
         count(*) FILTER (WHERE datetime < newest) AS late, {stats}
  FROM x
),
shares AS (
  SELECT machineID, avg(CASE WHEN datetime - prev = INTERVAL 1 HOUR THEN 1.0::DOUBLE ELSE 0 END)
           FILTER (WHERE prev IS NOT NULL) AS sh
  FROM x GROUP BY machineID HAVING count(prev) >= 2
),
g AS (SELECT min(machineID) AS bad, arg_min(sh, machineID) AS bad_share FROM shares WHERE sh < 0.9),
d AS (SELECT count(*) - count(DISTINCT (machineID, datetime)) AS dupes FROM pdm_telemetry)
---
""" + "\nUNION ALL ".join(rows)


SQL = {
    "validate_telemetry": _validate(),
    "loader_checks": """
x AS (SELECT *, max(datetime) OVER (PARTITION BY machineID ORDER BY event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM pdm_telemetry)
---
SELECT unnest(['has_telemetry', 'has_timestamps', 'has_machine_ids', 'no_duplicate_rows',
               'timestamps_monotonic_per_machine', 'sensors_no_null', 'sensors_positive',
               'machine_count_correct']) AS check_name,
       unnest([count(*) > 0, count(datetime) = count(*), count(machineID) = count(*),
               count(DISTINCT (machineID, datetime)) = count(*),
               count(*) FILTER (WHERE datetime < newest) = 0,
               count(volt + rotate + pressure + vibration) = count(*),
               min(least(volt, rotate, pressure, vibration)) >= 0,
               count(DISTINCT machineID) = 100]) AS passed
FROM x
""",
    "ks_drift": """
long AS (UNPIVOT (SELECT datetime, volt, rotate, pressure, vibration FROM pdm_telemetry
                  WHERE datetime < TIMESTAMP '2024-01-15' OR datetime >= TIMESTAMP '2024-01-23')
         ON volt, rotate, pressure, vibration INTO NAME sensor VALUE x),
steps AS (
  SELECT sensor, x,
    count(*) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') OVER w
      / (count(*) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') OVER p)::DOUBLE AS f1,
    count(*) FILTER (WHERE datetime >= TIMESTAMP '2024-01-23') OVER w
      / (count(*) FILTER (WHERE datetime >= TIMESTAMP '2024-01-23') OVER p)::DOUBLE AS f2,
    count(*) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') OVER p AS n,
    count(*) FILTER (WHERE datetime >= TIMESTAMP '2024-01-23') OVER p AS m
  FROM long WINDOW w AS (PARTITION BY sensor ORDER BY x), p AS (PARTITION BY sensor)
),
ks AS (SELECT sensor, max(abs(f1 - f2)) AS d, sqrt(any_value(n)::DOUBLE * any_value(m) / (any_value(n) + any_value(m)))
         * max(abs(f1 - f2)) AS z FROM steps GROUP BY sensor),
pv AS (SELECT sensor, d, CASE WHEN z < 0.2 THEN 1 ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE,
         list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END
                                 * exp(-2.0::DOUBLE * k * k * z * z))))) END AS p FROM ks)
---
SELECT 'drift_check_' || sensor AS check_name, NOT (p < 0.05 AND d > 0.1) AS passed,
       d AS ks_statistic, p AS p_value,
       CASE WHEN p < 0.05 AND d > 0.1 THEN 'warning' ELSE 'info' END AS severity
FROM pv
""",
}
