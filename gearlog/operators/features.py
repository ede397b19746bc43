"""Features per machine in time order.

Inputs have ``machine_id``, ``timestamp`` and sensor columns. Time frames run on
time spans with a halo, row frames on blocks of numbered rows with a halo, and
unbounded ones on spans that carry totals, so every window partition is bounded
by time or rows and not by a machine's history.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.batches import STATISTICS, statistics, trailing
from ..functions.spans import (
    DAY_US,
    HOUR_US,
    block_window,
    blocked,
    last_time,
    numbered,
    row_blocks,
    running,
    span_of,
    with_halo,
)
from ..functions.stats import per_key_join, safe_corr
from ..params import FEATURE_SENSORS, LAG_ROWS, ROLLING_HOURS, SPECTRAL_ROWS, TREND_ROWS

KEY = ["machine_id"]
# The sensor pairs that interact.
PAIRS = [
    ("voltage", "rotation_speed"),
    ("voltage", "pressure"),
    ("voltage", "vibration"),
    ("rotation_speed", "pressure"),
    ("rotation_speed", "vibration"),
    ("pressure", "vibration"),
]
BASELINE_ROWS = 168
CORR_ROWS, CORR_LEAST = 24, 12


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("_us", F.unix_micros("timestamp"))


# ---- time windows -------------------------------------------------------------


# Each builder gives its columns in stages, because an expression that is used
# several times is cheap as a column and expensive as a repeated tree: ``prepare``
# per reading, ``raw`` aggregates per window, ``middle`` and ``final`` per row.


class _Moments:
    def prepare(self, order, longest) -> dict[str, Column]:
        return {}

    def raw(self, s: str, w: int, frame) -> dict[str, Column]:
        return {
            f"_low_{s}_{w}": F.min(s).over(frame),
            f"_high_{s}_{w}": F.max(s).over(frame),
            f"_mean_{s}_{w}": F.avg(s).over(frame),
            f"_std_{s}_{w}": F.stddev_samp(s).over(frame),
        }

    def middle(self, s: str, w: int) -> list[dict[str, str]]:
        return []

    def final(self, s: str, w: int) -> dict[str, str]:
        x = f"{s}_{w}"
        return {
            f"{s}_mean_{w}h": f"_mean_{x}",
            f"{s}_std_{w}h": f"_std_{x}",
            f"{s}_min_{w}h": f"_low_{x}",
            f"{s}_max_{w}h": f"_high_{x}",
            f"{s}_range_{w}h": f"_high_{x} - _low_{x}",
        }


class _Shape:
    """Bias-corrected skewness and excess kurtosis; null for a constant window.

    Sums of powers cost a fraction of the built-in aggregates in a sliding
    frame. Values are taken off the mean of their span, so they lose no digits.
    """

    def prepare(self, order, longest) -> dict[str, Column]:
        whole = Window.partitionBy(*KEY, "_span")
        return {f"_d_{s}": F.col(s) - F.avg(s).over(whole) for s in FEATURE_SENSORS}

    def raw(self, s: str, w: int, frame) -> dict[str, Column]:
        d = F.col(f"_d_{s}")
        return {
            f"_low_{s}_{w}": F.min(s).over(frame),
            f"_high_{s}_{w}": F.max(s).over(frame),
            f"_s1_{s}_{w}": F.sum(d).over(frame),
            f"_s2_{s}_{w}": F.sum(d * d).over(frame),
            f"_s3_{s}_{w}": F.sum(d * d * d).over(frame),
            f"_s4_{s}_{w}": F.sum(d * d * d * d).over(frame),
        }

    def middle(self, s: str, w: int) -> list[dict[str, str]]:
        x = f"{s}_{w}"
        mean = {f"_m_{x}": f"try_divide(_s1_{x}, _n_{x})"}
        central = {
            f"_m2_{x}": f"_s2_{x} - _s1_{x} * _m_{x}",
            f"_m3_{x}": f"_s3_{x} - 3 * _m_{x} * _s2_{x} + 2 * _n_{x} * pow(_m_{x}, 3)",
            f"_m4_{x}": f"_s4_{x} - 4 * _m_{x} * _s3_{x} + 6 * pow(_m_{x}, 2) * _s2_{x}"
            f" - 3 * _n_{x} * pow(_m_{x}, 4)",
        }
        return [mean, central]

    def final(self, s: str, w: int) -> dict[str, str]:
        x = f"{s}_{w}"
        n, varies = f"_n_{x}", f"_high_{x} > _low_{x}"
        skew = f"try_divide({n} * sqrt({n} - 1) * _m3_{x}, ({n} - 2) * pow(_m2_{x}, 1.5D))"
        ratio = f"try_divide({n} * ({n} + 1) * _m4_{x}, pow(_m2_{x}, 2)) - 3 * ({n} - 1)"
        kurt = f"try_divide(({n} - 1) * ({ratio}), ({n} - 2) * ({n} - 3))"
        return {
            f"{s}_skew_{w}h": f"if({varies} and {n} >= 3, {skew}, null)",
            f"{s}_kurtosis_{w}h": f"if({varies} and {n} >= 4, {kurt}, null)",
        }


class _Quantiles:
    """Quartiles, interpolated between the two values around their position.

    The values of the longest window are listed once in time order; each shorter
    window is the tail of that list.
    """

    def prepare(self, order, longest) -> dict[str, Column]:
        frame = order.rangeBetween(1 - longest, 0)
        return {f"_l_{s}": F.collect_list(s).over(frame) for s in FEATURE_SENSORS}

    def raw(self, s: str, w: int, frame) -> dict[str, Column]:
        return {}

    def middle(self, s: str, w: int) -> list[dict[str, str]]:
        x = f"{s}_{w}"
        n = f"cast(greatest(_n_{x}, 1) as int)"
        ordered = {f"_o_{x}": f"sort_array(slice(_l_{s}, -{n}, {n}))"}
        quartiles = {}
        for k in (1, 2, 3):
            # the k-th quartile lies k * (n - 1) quarter positions into the list
            place = f"{k} * (size(_o_{x}) - 1)"
            below = f"get(_o_{x}, shiftright({place}, 2))"
            above = f"coalesce(get(_o_{x}, shiftright({place}, 2) + 1), {below})"
            quartiles[f"_q{k}_{x}"] = f"{below} + ({place} & 3) / 4.0D * ({above} - {below})"
        return [ordered, quartiles]

    def final(self, s: str, w: int) -> dict[str, str]:
        x = f"{s}_{w}"
        return {
            f"{s}_q25_{w}h": f"_q1_{x}",
            f"{s}_q50_{w}h": f"_q2_{x}",
            f"{s}_q75_{w}h": f"_q3_{x}",
            f"{s}_iqr_{w}h": f"_q3_{x} - _q1_{x}",
        }


def _time_windows(df: DataFrame, hours, builders) -> DataFrame:
    """Add the builders' columns for time windows (t-w, t], null below w//6 readings."""
    longest = max(hours) * HOUR_US
    wide = with_halo(_timed(df), "_us", 4 * longest, before=longest)
    order = Window.partitionBy(*KEY, "_span").orderBy("_us")
    helpers: dict[str, Column] = {}
    raw: dict[str, Column] = {}
    middle: list[dict[str, Column]] = [{}, {}]
    final: list[Column] = []
    for build in builders:
        helpers |= build.prepare(order, longest)
    for w in hours:
        frame = order.rangeBetween(1 - w * HOUR_US, 0)
        for s in FEATURE_SENSORS:
            n = f"_n_{s}_{w}"
            raw[n] = F.count(s).over(frame).cast("double")
            for build in builders:
                raw |= build.raw(s, w, frame)
                for stage, columns in zip(middle, build.middle(s, w)):
                    stage |= {c: F.expr(e) for c, e in columns.items()}
                for c, e in build.final(s, w).items():
                    final.append(F.expr(f"if({n} >= {max(2, w // 6)}, {e}, null)").alias(c))
    for stage in (helpers, raw):
        wide = wide.withColumns(stage) if stage else wide
    wide = wide.filter("_own").drop("_span", "_own", "_us")
    for stage in middle:
        wide = wide.withColumns(stage) if stage else wide
    return wide.select(*df.columns, *final)


def rolling_moments(df: DataFrame, hours=ROLLING_HOURS) -> DataFrame:
    """Mean, deviation, minimum, maximum and range over trailing hours."""
    return _time_windows(df, hours, [_Moments()])


def rolling_shape(df: DataFrame, hours=ROLLING_HOURS) -> DataFrame:
    """Skewness and kurtosis over trailing hours."""
    return _time_windows(df, hours, [_Shape()])


def rolling_quantiles(df: DataFrame, hours=ROLLING_HOURS) -> DataFrame:
    """Quartiles and their distance over trailing hours."""
    return _time_windows(df, hours, [_Quantiles()])


def laid_out(df: DataFrame, rows: int = max(TREND_ROWS), size: int = 4096) -> DataFrame:
    """Blocks of numbered rows with all that row and time windows look back to, dealt out
    once: steps that stay inside a block follow without a shuffle.

    Rows carry ``_rn`` and ``_reach`` (see ``cumulative_deviation``). Inside a block they are
    numbered again from its first number, in order of time: where a machine is listed twice,
    copies of its readings share numbers with later ones.
    """
    blocks = row_blocks(df, rows, size).drop("_reach").repartition(*KEY, "_block")
    block = Window.partitionBy(*KEY, "_block")
    place = F.row_number().over(block.orderBy("timestamp", "_rn")) - 1
    return blocks.withColumn("_rn", F.min("_rn").over(block) + place)


def rolling_statistics(df: DataFrame, hours=ROLLING_HOURS) -> DataFrame:
    """All eleven rolling statistics in one pass.

    Rows laid out in blocks and sorted are taken as they are; others are dealt out by span.

    Some 260 window columns cost a frame's rows 44 updates for each row; here numpy takes
    many windows at a time. The order of columns is that of the three parts.
    """
    longest, dealt = max(hours) * HOUR_US, "_block" in df.columns
    # a row without a time has no time window
    wide = _timed(df).filter("_us IS NOT NULL") if dealt else with_halo(_timed(df), "_us", 4 * longest, before=longest)
    part = "_block" if dealt else "_span"
    keep = [c for c in df.columns if c not in ("_block", "_own", "_rn")]
    names = [f"{s}_{k}_{w}h" for w in hours for s in FEATURE_SENSORS for k in STATISTICS]

    def windows(table: pa.Table, at: np.ndarray, rows: slice) -> dict[str, pa.Array]:
        out = {}
        starts = {w: np.searchsorted(at, at[rows] - w * HOUR_US, side="right") for w in hours}
        ends = np.searchsorted(at, at[rows], side="right")
        for s in FEATURE_SENSORS:
            known = table[s].is_valid().to_numpy()
            before = np.concatenate([[0], np.cumsum(known)])  # values before each row
            values = table[s].drop_null().to_numpy().astype(float)
            for w in hours:
                found, there = statistics(values, before[starts[w]], before[ends], max(2, w // 6))
                for j, k in enumerate(STATISTICS):
                    out[f"{s}_{k}_{w}h"] = pa.array(found[:, j], mask=~there[:, j])
        return out

    return trailing(wide, [*KEY, part], "_us", longest, windows, names, keep, laid_out=dealt)


# ---- row windows --------------------------------------------------------------


def _rate_columns() -> dict[str, Column]:
    w = block_window(KEY)
    recent = w.rowsBetween(-23, 0)
    out: dict[str, Column] = {}
    for s in FEATURE_SENSORS:
        x = F.col(s)
        for k in (1, 6, 24):
            out[f"{s}_delta_{k}h"] = x - F.lag(s, k).over(w)
        out[f"{s}_accel_1h"] = x - 2 * F.lag(s, 1).over(w) + F.lag(s, 2).over(w)
        out[f"{s}_pct_change_24h"] = F.coalesce(
            F.try_divide(x, F.lag(s, 24).over(w)) - 1, F.lit(0.0)
        )
        n = F.count(s).over(recent)
        out[f"{s}_roc_24h"] = F.when(n >= 6, (x - F.first(s).over(recent)) / (n - 1))
    return out


def _lag_columns(rows=LAG_ROWS) -> dict[str, Column]:
    w = block_window(KEY)
    return {f"{s}_lag_{k}h": F.lag(s, k).over(w) for s in FEATURE_SENSORS for k in rows}


def _trend_sums() -> tuple[dict[str, Column], dict[str, Column]]:
    """Running sums inside a block that every trend window is a difference of."""
    w = block_window(KEY)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    i = F.row_number().over(w).cast("double")
    out: dict[str, Column] = {"_i": i}
    for s in FEATURE_SENSORS:
        whole = Window.partitionBy(*KEY, "_block")
        d = F.col(s) - F.avg(s).over(whole)
        moved = F.coalesce(F.col(s) != F.lag(s).over(w), F.lit(False)).cast("int")
        out |= {
            f"_t_{s}": F.struct(
                d.alias("d"), moved.alias("moved"), F.col(s).isNull().cast("int").alias("gone")
            )
        }
    sums: dict[str, Column] = {}
    for s in FEATURE_SENSORS:
        t = F.col(f"_t_{s}")
        sums |= {
            f"_y_{s}": F.sum(t["d"]).over(upto),
            f"_yy_{s}": F.sum(t["d"] * t["d"]).over(upto),
            f"_xy_{s}": F.sum(t["d"] * F.col("_i")).over(upto),
            f"_moved_{s}": F.sum(t["moved"]).over(upto),
            f"_gone_{s}": F.sum(t["gone"]).over(upto),
        }
    return out, sums


def _trend_columns(rows=TREND_ROWS) -> dict[str, Column]:
    """Least squares over the last rows; positions are 0, 1, 2, ... so their sums
    are known and only the sensor sums have to slide."""
    w = block_window(KEY)
    out: dict[str, Column] = {}
    for k in rows:
        n = F.least(F.col("_rn"), F.lit(k)).cast("double")
        sxx = n * (n * n - 1) / 12
        middle = F.col("_i") - (n - 1) / 2
        for s in FEATURE_SENSORS:

            def over_window(name: str, back: int = k) -> Column:
                before = F.coalesce(F.lag(f"{name}_{s}", back).over(w), F.lit(0))
                return F.col(f"{name}_{s}") - before

            y, yy, xy = over_window("_y"), over_window("_yy"), over_window("_xy")
            flat = (F.col(f"_moved_{s}") - F.coalesce(
                F.lag(f"_moved_{s}", k - 1).over(w), F.first(f"_moved_{s}").over(w)
            )) == 0
            sxy = xy - middle * y
            syy = yy - y * y / n
            usable = (n >= max(6, k // 4, k // 2)) & (over_window("_gone") == 0)
            slope = F.when(flat, 0.0).otherwise(F.try_divide(sxy, sxx))
            mean = F.col(s) - F.col(f"_t_{s}")["d"] + y / n
            fit = F.least(F.lit(1.0), F.try_divide(sxy * sxy, sxx * syy))
            out[f"{s}_slope_{k}h"] = F.when(usable, slope)
            out[f"{s}_intercept_{k}h"] = F.when(usable, mean - slope * (n - 1) / 2)
            out[f"{s}_r2_{k}h"] = F.when(usable, F.when(flat, 1.0).otherwise(fit))
    return out


def _with_trends(blocks: DataFrame, rows=TREND_ROWS) -> DataFrame:
    first, sums = _trend_sums()
    wide = blocks.withColumns(first).withColumns(sums).withColumns(_trend_columns(rows))
    return wide.drop(*first, *sums)


def _corr_columns() -> dict[str, Column]:
    frame = block_window(KEY).rowsBetween(1 - CORR_ROWS, 0)
    out = {}
    for a, b in PAIRS:
        both = F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).over(frame)
        out[f"{a}_{b}_corr_24h"] = F.when(
            both >= CORR_LEAST, safe_corr(F.col(a), F.col(b), over=frame)
        )
    return out


def _with_errors(blocks: DataFrame, rows=TREND_ROWS) -> DataFrame:
    """Errors over the last rows, as differences of a running sum inside the block."""
    w = block_window(KEY)
    upto = F.sum("error_count_1h").over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = {k: F.coalesce(F.lag("_errors", k).over(w), F.lit(0)) for k in rows}
    counts = {f"error_count_{k}h": F.col("_errors") - before[k] for k in rows}
    return blocks.withColumn("_errors", upto).withColumns(counts).drop("_errors")


def rate_of_change(df: DataFrame) -> DataFrame:
    """Differences, acceleration, relative change and mean change over 24 rows."""
    return blocked(_timed(df), KEY, "_us", 24, _rate_columns()).drop("_us", "_rn")


def lags(df: DataFrame, rows=LAG_ROWS) -> DataFrame:
    """Sensor values a number of rows back."""
    out = blocked(_timed(df), KEY, "_us", max(rows), _lag_columns(rows))
    return out.drop("_us", "_rn")


def trend_slopes(df: DataFrame, rows=TREND_ROWS) -> DataFrame:
    """Slope, value at window start and fit of a line through the last rows."""
    blocks = row_blocks(numbered(_timed(df), KEY, "_us"), max(rows))
    return _with_trends(blocks, rows).filter("_own").drop("_us", "_rn", "_block", "_own")


def rolling_corr(df: DataFrame) -> DataFrame:
    """Correlation of each sensor pair over the last 24 rows (12 needed)."""
    return blocked(_timed(df), KEY, "_us", CORR_ROWS - 1, _corr_columns()).drop("_us", "_rn")


# ---- spectrum -----------------------------------------------------------------

SPECTRAL = ("spectral_energy", "spectral_centroid", "dominant_freq", "spectral_entropy")


#: Magnitudes this close to the largest, relative to it, count as tied with it.
NEAR = 1e-9


def _first_largest(values: np.ndarray) -> int:
    """Frequency of the largest magnitude, by the transform's definition in row order.

    Whole-number readings can give two frequencies exactly the same magnitude. Then only
    rounding tells them apart, so it has to be that of the plain sums.
    """
    n, x = len(values), (values - values.mean()).tolist()
    mags = []
    for f in range(n // 2 + 1):
        re = im = 0.0
        for i, v in enumerate(x):  # not sum(), which corrects its rounding
            wave = 2 * math.pi * f * i / n
            re += v * math.cos(wave)
            im += v * math.sin(wave)
        mags.append(math.sqrt(re**2 + im**2))
    return mags.index(max(mags))


def _spectrum(values: np.ndarray) -> np.ndarray:
    """Energy, centroid, dominant frequency and entropy of each row of ``values``."""
    n = values.shape[1]
    mag = np.abs(np.fft.rfft(values - values.mean(axis=1, keepdims=True), axis=1))
    freq = np.fft.rfftfreq(n)
    total = mag.sum(axis=1)
    power = mag**2
    energy = power.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        centroid = (mag * freq).sum(axis=1) / total
        part = power / energy[:, None]
        entropy = -np.where(part > 0, part * np.log(part), 0.0).sum(axis=1)
    largest = mag.argmax(axis=1)
    tied = (mag >= (1 - NEAR) * mag.max(axis=1, keepdims=True)).sum(axis=1) > 1
    for row in np.flatnonzero(tied & (total > 0)):
        largest[row] = _first_largest(values[row])
    out = np.column_stack([energy, centroid, freq[largest], entropy])
    out[~(total > 0)] = np.nan
    return out


SPECTRAL_NAMES = [f"{s}_{k}" for s in FEATURE_SENSORS for k in SPECTRAL]


def _spectra(table: pa.Table, at: np.ndarray, some: slice, rows: int) -> dict[str, pa.Array]:
    first = np.searchsorted(at, at[some] - rows)
    full = np.flatnonzero(np.arange(len(at))[some] - first == rows)
    out = {}
    for s in FEATURE_SENSORS:
        found = np.full((len(first), len(SPECTRAL)), np.nan)
        if len(full):
            views = np.lib.stride_tricks.sliding_window_view(table[s].to_numpy(), rows)
            found[full] = _spectrum(views[first[full]])
        for j, k in enumerate(SPECTRAL):
            out[f"{s}_{k}"] = pa.array(found[:, j], from_pandas=True)  # NaN becomes null
    return out


def spectral(
    df: DataFrame, rows: int = SPECTRAL_ROWS, base: DataFrame | None = None
) -> DataFrame:
    """Spectrum of the ``rows`` readings before each reading (it is not included).

    Python gets blocks of machines' rows plus halos, many small ones at a time.
    """
    named = numbered(_timed(df), KEY, "_us", base=base)

    def spectra(table: pa.Table, at: np.ndarray, some: slice) -> dict[str, pa.Array]:
        return _spectra(table, at, some, rows)

    blocks = row_blocks(named, rows)
    return trailing(blocks, [*KEY, "_block"], "_rn", rows + 1, spectra, SPECTRAL_NAMES, df.columns)


def _correlations(table: pa.Table, at: np.ndarray, some: slice) -> dict[str, pa.Array]:
    """The columns of ``rolling_corr``, by the same definition."""
    spots = np.arange(len(at))[some, None] + np.arange(1 - CORR_ROWS, 1)
    inside = spots >= np.searchsorted(at, at[some] - CORR_ROWS, side="right")[:, None]
    spots = np.maximum(spots, 0)
    values = {s: table[s].to_numpy()[spots] for s in FEATURE_SENSORS}
    known = {s: table[s].is_valid().to_numpy()[spots] & inside for s in FEATURE_SENSORS}
    out = {}
    for a, b in PAIRS:
        both = known[a] & known[b]
        n = both.sum(axis=1)
        parts, product = [], 1.0
        with np.errstate(all="ignore"):
            for x in (values[a], values[b]):
                d = np.where(both, x - (np.where(both, x, 0.0).sum(axis=1) / n)[:, None], 0.0)
                flat = np.where(both, x, -np.inf).max(axis=1) == np.where(both, x, np.inf).min(axis=1)
                product = product * np.where(flat, 0.0, np.sqrt((d * d).sum(axis=1) / (n - 1)))
                parts.append(d)
            found = (parts[0] * parts[1]).sum(axis=1) / (n - 1) / product
        out[f"{a}_{b}_corr_24h"] = pa.array(found, mask=(product == 0) | (n < CORR_LEAST))
    return out


def spectral_and_corr(df: DataFrame, rows: int = SPECTRAL_ROWS) -> DataFrame:
    """Columns of ``spectral`` and ``rolling_corr`` in one pass over rows with ``_rn``.

    Rows laid out in blocks and sorted are taken as they are, and stay so.
    """

    def both(table: pa.Table, at: np.ndarray, some: slice) -> dict[str, pa.Array]:
        return _spectra(table, at, some, rows) | _correlations(table, at, some)

    names = [*SPECTRAL_NAMES, *[f"{a}_{b}_corr_24h" for a, b in PAIRS]]
    halo = max(rows, CORR_ROWS)
    if "_block" in df.columns:
        return trailing(df, [*KEY, "_block"], "_rn", halo + 1, both, names, df.columns, own=None, laid_out=True)
    return trailing(row_blocks(df, halo), [*KEY, "_block"], "_rn", halo + 1, both, names, df.columns)


# ---- sensors against each other and against the past --------------------------


def interactions(df: DataFrame) -> DataFrame:
    """Product, ratio and difference of each sensor pair."""
    out: dict[str, Column] = {}
    for a, b in PAIRS:
        out[f"{a}_x_{b}"] = F.col(a) * F.col(b)
        out[f"{a}_div_{b}"] = F.try_divide(F.col(a), F.nullif(F.col(b), F.lit(0.0)) + 1e-8)
        out[f"{a}_minus_{b}"] = F.col(a) - F.col(b)
    return df.withColumns(out)


def cumulative_deviation(
    df: DataFrame, base: DataFrame | None = None, number: bool = False, reach: int = 0
) -> DataFrame:
    """Running sum of each reading's distance from the mean of all readings so far.

    ``number`` also gives the row number ``_rn`` (see ``numbered``) from the same pass, and
    in ``_reach`` a row number that no row less than ``reach`` microseconds later exceeds.
    """
    order, span = [F.col("_us")], span_of("_us", DAY_US)
    one = F.lit(1).cast("long")
    rank = {"_rn": ("sum", one)} if number else {}
    ahead = {"_reach": (one, -(-reach // DAY_US))} if number else {}
    sums = {f"_s_{s}": ("sum", F.col(s)) for s in FEATURE_SENSORS}
    counts = {
        f"_n_{s}": ("sum", F.col(s).isNotNull().cast("double")) for s in FEATURE_SENSORS
    }
    away = {
        f"{s}_cumul_deviation": (
            "sum",
            F.col(s) - F.try_divide(F.col(f"_s_{s}"), F.col(f"_n_{s}")),
        )
        for s in FEATURE_SENSORS
    }

    def means(rows: DataFrame) -> DataFrame:
        return running(rows, KEY, order, rank | sums | counts, span, totals_of=base, ahead=ahead)

    return running(
        means(_timed(df)),
        KEY,
        order,
        away,
        span,
        totals_of=None if base is None else means(base),
    ).drop("_us", *sums, *counts)


def baseline_zscore(
    df: DataFrame, rows: int = BASELINE_ROWS, base: DataFrame | None = None
) -> DataFrame:
    """Distance from the machine's first ``rows`` readings in their deviations."""
    narrow = _timed(df) if base is None else base
    first = (
        numbered(narrow, KEY, "_us")
        .filter(F.col("_rn") <= rows)
        .groupBy(*KEY)
        .agg(
            *[F.avg(s).alias(f"_m_{s}") for s in FEATURE_SENSORS],
            *[F.stddev_samp(s).alias(f"_d_{s}") for s in FEATURE_SENSORS],
        )
    )
    joined = per_key_join(df, first, key=KEY[0], spread="timestamp")
    z = {
        f"{s}_running_zscore": (F.col(s) - F.col(f"_m_{s}")) / (F.col(f"_d_{s}") + 1e-8)
        for s in FEATURE_SENSORS
    }
    return joined.withColumns(z).select(*df.columns, *z)


def calendar_features(df: DataFrame) -> DataFrame:
    """Hour, weekday (Monday 0), day, month, weekend, night shift, cyclic hour."""
    hour, day = F.hour("timestamp"), F.weekday("timestamp")
    angle = F.lit(2 * math.pi) * hour / 24
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": day,
            "day_of_month": F.dayofmonth("timestamp"),
            "month": F.month("timestamp"),
            "is_weekend": (day >= 5).cast("int"),
            "is_night_shift": ((hour >= 22) | (hour < 6)).cast("int"),
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
        }
    )


def days_since_maintenance(
    df: DataFrame,
    maint: DataFrame,
    last_only: bool = False,
    base: DataFrame | None = None,
) -> DataFrame:
    """Days since the last maintenance at or before each reading.

    ``last_only=True`` measures from the machine's newest reading that has
    maintenance in its last 7 days, whatever the reading's own time.
    """
    if last_only:
        last = (
            df.filter("maint_count_7d > 0")
            .groupBy(*KEY)
            .agg(F.unix_micros(F.max("timestamp")).alias("_last"))
        )
        found = per_key_join(_timed(df), last, key=KEY[0], spread="timestamp", how="left")
    else:
        events = maint.select("machineID", F.unix_micros("datetime").alias("_us"))
        rows = _timed(df).withColumnRenamed("machine_id", "machineID")
        keys = None if base is None else base.select(F.col("machine_id").alias("machineID"), "_us")
        found = last_time(rows, {"_last": events}, base=keys)
        found = found.withColumnRenamed("machineID", "machine_id")
    days = (F.col("_us") - F.col("_last")) / F.lit(8.64e10)
    return found.withColumn("days_since_last_maint", days).select(
        *df.columns, "days_since_last_maint"
    )


def event_history(
    df: DataFrame, maint: DataFrame, rows=TREND_ROWS, base: DataFrame | None = None
) -> DataFrame:
    """Errors over the last rows and days since maintenance."""
    blocks = row_blocks(numbered(_timed(df), KEY, "_us", base=base), max(rows))
    counted = _with_errors(blocks, rows).filter("_own").drop("_us", "_rn", "_block", "_own")
    return days_since_maintenance(counted, maint, base=base)
