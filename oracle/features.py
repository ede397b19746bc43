import math

from .base import no_nan
from .history import CUT, ERRORS_BY_HOUR, MASTER, READINGS, SPLIT, label_ctes

SENSORS = ("voltage", "rotation_speed", "pressure", "vibration")
PAIRS = [(a, b) for i, a in enumerate(SENSORS) for b in SENSORS[i + 1 :]]
HOURS = (6, 12, 24, 48, 72, 168)
NUMBERED = (
    READINGS
    + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY timestamp) AS rn FROM readings)
"""
)


def _select(columns: dict[str, str], source: str = "numbered", windows: str = "") -> str:
    cols = ",\n       ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"---\nSELECT machine_id, timestamp,\n       {cols}\nFROM {source}{windows}"


def _time_sql(build) -> str:
    cols: dict[str, str] = {}
    windows = []
    for w in HOURS:
        windows.append(
            f"w{w} AS (PARTITION BY machine_id ORDER BY epoch_us(timestamp)"
            f" RANGE BETWEEN {w * 3600000000 - 1} PRECEDING AND CURRENT ROW)"
        )
        for s in SENSORS:
            for name, e in build(s, w).items():
                cols[name] = f"CASE WHEN count({s}) OVER w{w} >= {max(2, w // 6)} THEN {e} END"
    return READINGS + _select(cols, "readings", "\nWINDOW " + ", ".join(windows))


def _moments(s, w):
    return {
        f"{s}_mean_{w}h": f"avg({s}) OVER w{w}",
        f"{s}_std_{w}h": f"stddev_samp({s}) OVER w{w}",
        f"{s}_min_{w}h": f"min({s}) OVER w{w}",
        f"{s}_max_{w}h": f"max({s}) OVER w{w}",
        f"{s}_range_{w}h": f"max({s}) OVER w{w} - min({s}) OVER w{w}",
    }


def _shape(s, w):
    flat = f"max({s}) OVER w{w} = min({s}) OVER w{w}"
    return {
        f"{s}_skew_{w}h": f"CASE WHEN {flat} OR count({s}) OVER w{w} < 3 THEN NULL ELSE skewness({s}) OVER w{w} END",
        f"{s}_kurtosis_{w}h": f"CASE WHEN {flat} OR count({s}) OVER w{w} < 4 THEN NULL ELSE kurtosis({s}) OVER w{w} END",
    }


def _quantiles(s, w):
    q = {p: f"quantile_cont({s}, {p / 100}) OVER w{w}" for p in (25, 50, 75)}
    return {
        **{f"{s}_q{p}_{w}h": e for p, e in q.items()},
        f"{s}_iqr_{w}h": f"{q[75]} - {q[25]}",
    }


def _rows(k: int) -> str:
    return f"(PARTITION BY machine_id ORDER BY rn ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


ORDER = "(PARTITION BY machine_id ORDER BY rn)"


def _rates():
    out = {}
    for s in SENSORS:
        for k in (1, 6, 24):
            out[f"{s}_delta_{k}h"] = f"{s} - lag({s}, {k}) OVER {ORDER}"
        out[f"{s}_accel_1h"] = (
            f"({s} - lag({s}) OVER {ORDER}) - (lag({s}) OVER {ORDER} - lag({s}, 2) OVER {ORDER})"
        )
        old = f"lag({s}, 24) OVER {ORDER}"
        out[f"{s}_pct_change_24h"] = (
            f"CASE WHEN {old} IS NULL OR {old} = 0 THEN 0 ELSE {s} / ({old}) - 1 END"
        )
        out[f"{s}_roc_24h"] = (
            f"CASE WHEN least(rn, 24) >= 6 THEN ({s} - first({s}) OVER {_rows(24)})"
            " / (least(rn, 24) - 1) END"
        )
    return out


def _lags():
    return {
        f"{s}_lag_{k}h": f"lag({s}, {k}) OVER {ORDER}"
        for s in SENSORS
        for k in (1, 3, 6, 12, 24, 48, 72, 168)
    }


def _trends():
    out = {}
    for k in (24, 72, 168):
        ready = f"CASE WHEN least(rn, {k}) >= {k // 2} THEN"
        for s in SENSORS:
            b, a, r = (
                no_nan(f"{fn}({s}, rn) OVER {_rows(k)}")
                for fn in ("regr_slope", "regr_intercept", "regr_r2")
            )
            out[f"{s}_slope_{k}h"] = f"{ready} {b} END"
            out[f"{s}_intercept_{k}h"] = f"{ready} {a} + ({b}) * greatest(1, rn - {k - 1}) END"
            out[f"{s}_r2_{k}h"] = f"{ready} {r} END"
    return out


def _corrs():
    return {
        f"{a}_{b}_corr_24h": f"CASE WHEN least(rn, 24) >= 12 THEN {no_nan(f'corr({a}, {b}) OVER {_rows(24)}')} END"
        for a, b in PAIRS
    }


def _interactions():
    out = {}
    for a, b in PAIRS:
        out[f"{a}_x_{b}"] = f"{a} * {b}"
        out[f"{a}_div_{b}"] = f"{a} / (nullif({b}, 0) + 1e-8::DOUBLE)"
        out[f"{a}_minus_{b}"] = f"{a} - {b}"
    return out


def _spectral() -> str:
    """Discrete Fourier transform of the 64 rows before, frequency by frequency."""
    parts = []
    for s in SENSORS:
        wave = "2 * pi() * f * i / 64"
        parts.append(f"""
{s}_mag AS (
  SELECT machine_id, timestamp, list_transform(range(33), lambda f: sqrt(
      pow(list_sum(list_transform(range(64), lambda i: ({s}_l[i + 1] - {s}_m) * cos({wave}))), 2)
    + pow(list_sum(list_transform(range(64), lambda i: ({s}_l[i + 1] - {s}_m) * sin({wave}))), 2))) AS mag
  FROM segments WHERE len({s}_l) = 64
),
{s}_sp AS (
  SELECT machine_id, timestamp,
    list_sum(list_transform(mag, lambda m: m * m)) AS {s}_spectral_energy,
    list_sum(list_transform(range(33), lambda f: f / 64.0::DOUBLE * mag[f + 1])) / list_sum(mag) AS {s}_spectral_centroid,
    (list_position(mag, list_max(mag)) - 1) / 64.0::DOUBLE AS {s}_dominant_freq,
    -list_sum(list_transform(mag, lambda m: CASE WHEN m > 0 THEN
        m * m / list_sum(list_transform(mag, lambda x: x * x))
        * ln(m * m / list_sum(list_transform(mag, lambda x: x * x))) ELSE 0 END)) AS {s}_spectral_entropy
  FROM {s}_mag
)""")
    lists = ",\n    ".join(
        f"list({s}) OVER b AS {s}_l, avg({s}) OVER b AS {s}_m" for s in SENSORS
    )
    joins = "\n".join(f"LEFT JOIN {s}_sp USING (machine_id, timestamp)" for s in SENSORS)
    return (
        NUMBERED
        + f""",
segments AS (
  SELECT machine_id, timestamp, {lists} FROM numbered
  WINDOW b AS (PARTITION BY machine_id ORDER BY rn ROWS BETWEEN 64 PRECEDING AND 1 PRECEDING)
),
{','.join(parts)}
---
SELECT machine_id, timestamp, {', '.join(f'{s}_{k}' for s in SENSORS for k in
    ('spectral_energy', 'spectral_centroid', 'dominant_freq', 'spectral_entropy'))}
FROM readings {joins}
"""
    )


def _ewma() -> str:
    names = [(s, n, a) for s in SENSORS for n, a in (("ewma_alpha01", 0.1), ("ewma_alpha005", 0.05))]
    first = ", ".join(f"{s} AS {s}_{n}" for s, n, _ in names)
    later = ", ".join(
        f"{a}::DOUBLE * r.{s} + {1 - a}::DOUBLE * e.{s}_{n}" for s, n, a in names
    )
    return (
        NUMBERED
        + f""",
e AS (
  SELECT machine_id, timestamp, rn, {first} FROM numbered WHERE rn = 1
  UNION ALL
  SELECT r.machine_id, r.timestamp, r.rn, {later}
  FROM e JOIN numbered r ON r.machine_id = e.machine_id AND r.rn = e.rn + 1
)
---
SELECT * EXCLUDE (rn) FROM e
"""
    )


def _deviation() -> str:
    far = ", ".join(f"{s} - avg({s}) OVER u AS {s}_d" for s in SENSORS)
    upto = "(PARTITION BY machine_id ORDER BY rn ROWS UNBOUNDED PRECEDING)"
    total = {f"{s}_cumul_deviation": f"sum({s}_d) OVER {upto}" for s in SENSORS}
    return (
        NUMBERED
        + f",\naway AS (SELECT machine_id, timestamp, rn, {far} FROM numbered WINDOW u AS {upto})\n"
        + _select(total, "away")
    )


def _baseline() -> str:
    stats = ", ".join(f"avg({s}) AS {s}_m, stddev_samp({s}) AS {s}_s" for s in SENSORS)
    z = {f"{s}_running_zscore": f"({s} - {s}_m) / ({s}_s + 1e-8::DOUBLE)" for s in SENSORS}
    return (
        NUMBERED
        + f",\nbase AS (SELECT machine_id, {stats} FROM numbered WHERE rn <= 168 GROUP BY machine_id)\n"
        + _select(z, "numbered JOIN base USING (machine_id)")
    )


HOUR = "date_part('hour', timestamp)"
DAY = "(date_part('isodow', timestamp) - 1)"
CALENDAR = {
    "hour_of_day": f"CAST({HOUR} AS INTEGER)",
    "day_of_week": f"CAST({DAY} AS INTEGER)",
    "day_of_month": "CAST(date_part('day', timestamp) AS INTEGER)",
    "month": "CAST(date_part('month', timestamp) AS INTEGER)",
    "is_weekend": f"CAST({DAY} IN (5, 6) AS INTEGER)",
    "is_night_shift": f"CAST({HOUR} NOT BETWEEN 6 AND 21 AS INTEGER)",
    "hour_sin": f"sin({2 * math.pi!r}::DOUBLE * {HOUR} / 24)",
    "hour_cos": f"cos({2 * math.pi!r}::DOUBLE * {HOUR} / 24)",
}


def _history() -> str:
    counts = {
        f"error_count_{k}h": f"CAST(sum(errors) OVER {_rows(k)} AS BIGINT)" for k in (24, 72, 168)
    }
    counts["days_since_last_maint"] = (
        "(epoch_us(timestamp) - epoch_us(last_m)) / 86400000000.0::DOUBLE"
    )
    return (
        NUMBERED
        + f""",
{ERRORS_BY_HOUR},
with_errors AS (
  SELECT n.machine_id, n.timestamp, n.rn, coalesce(e.n, 0) AS errors, m.datetime AS last_m
  FROM numbered n
  LEFT JOIN err_hour e ON e.machine_id = n.machine_id AND e.hour = date_trunc('hour', n.timestamp)
  ASOF LEFT JOIN pdm_maint m ON m.machineID = n.machine_id AND m.datetime <= n.timestamp
)
"""
        + _select(counts, "with_errors")
    )


def _scaled() -> str:
    q = ", ".join(
        f"quantile_cont({s}, [0.25, 0.5, 0.75]) FILTER (WHERE epoch_us(timestamp) < c) AS {s}_q"
        for s in SENSORS
    )
    cols = {"split": SPLIT}
    for s in SENSORS:
        cols[s] = s
        spread = f"({s}_q[3] - {s}_q[1])"
        cols[f"{s}_scaled"] = (
            f"({s} - {s}_q[2]) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END"
        )
    return (
        READINGS
        + f",\n{CUT},\nfit AS (SELECT {q} FROM readings, cut)\n"
        + _select(cols, "readings, cut, fit")
    )


SEQUENCES = (
    NUMBERED
    + f""",
{label_ctes()},
labelled AS (SELECT n.*, failure_label FROM numbered n JOIN labels USING (machine_id, timestamp)),
wins AS (SELECT machine_id, rn AS last_rn, timestamp AS end_time, failure_label AS label
         FROM labelled WHERE rn >= 48),
steps AS (
  SELECT w.machine_id, s.timestamp AS start_time, w.end_time, w.label, w.last_rn
  FROM wins w JOIN numbered s ON s.machine_id = w.machine_id AND s.rn = w.last_rn - 47
)
"""
)

SQL = {
    "rolling_moments": _time_sql(_moments),
    "rolling_shape": _time_sql(_shape),
    "rolling_quantiles": _time_sql(_quantiles),
    "rate_of_change": NUMBERED + _select(_rates()),
    "lags": NUMBERED + _select(_lags()),
    "trend_slopes": NUMBERED + _select(_trends()),
    "spectral": _spectral(),
    "interactions": READINGS + _select(_interactions(), "readings"),
    "rolling_corr": NUMBERED + _select(_corrs()),
    "ewma": _ewma(),
    "cumulative_deviation": _deviation(),
    "baseline_zscore": _baseline(),
    "calendar_features": READINGS + _select(CALENDAR, "readings"),
    "event_history": _history(),
    "robust_scaled": _scaled(),
    "sequences": SEQUENCES
    + """
---
SELECT t.machine_id, t.start_time, t.end_time, t.label, n.rn - t.last_rn + 47 AS pos, n.timestamp,
       n.voltage, n.rotation_speed, n.pressure, n.vibration
FROM steps t JOIN numbered n ON n.machine_id = t.machine_id AND n.rn BETWEEN t.last_rn - 47 AND t.last_rn
""",
    "sequence_split": SEQUENCES
    + """,
scut AS (SELECT quantile_cont(CAST(epoch_us(end_time) AS DOUBLE), 0.8) AS c FROM steps)
---
SELECT machine_id, start_time, end_time, label,
       CASE WHEN epoch_us(end_time) < c THEN 'train' ELSE 'test' END AS split
FROM steps, scut
""",
}


def _inner(sql: str) -> str:
    ctes, select = sql.split("---", 1)
    return f"WITH RECURSIVE {ctes.strip()}\n{select.strip()}"


def _table() -> str:
    """The statements of all parts, joined on machine and time."""
    parts = (
        "rolling_moments rolling_shape rolling_quantiles rate_of_change trend_slopes spectral interactions "
        "rolling_corr ewma cumulative_deviation baseline_zscore calendar_features event_history"
    ).split()
    tables = ",\n".join(f"part_{n} AS ({_inner(SQL[n])})" for n in parts)
    columns = ",\n       ".join(f"part_{n}.* EXCLUDE (machine_id, timestamp)" for n in parts)
    joins = "\n".join(f"LEFT JOIN part_{n} USING (machine_id, timestamp)" for n in parts)
    return f"""{MASTER},
{tables}
---
SELECT master.* EXCLUDE (error_count_24h),
       {columns}
FROM master
{joins}
"""


SQL["build_features"] = _table()
