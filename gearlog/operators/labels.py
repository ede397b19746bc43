"""What happened around each reading: error, maintenance and failure history, labels.

Window counts are running sums over +1/-1 marks at the ends of each event's
span, next and last events are running minima and maxima. Every pass sorts
(machine, day) spans, so cost is linear in readings plus events and a machine
with a long history is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import exact_quantiles
from ..functions.spans import (
    DAY_US,
    HOUR_US,
    active_marks,
    beside,
    last_time,
    next_time,
    numbered,
    running,
    span_of,
)
from ..functions.stats import interval_join, per_key_join
from ..params import COMPONENTS, NO_FAILURE_HOURS, Params
from ..sources.tables import Tables, standardise
from .failures import timed


def _readings(t: Tables) -> DataFrame:
    return timed(t.telemetry.drop("event_id"))


def _base(t: Tables) -> DataFrame:
    """Only key and time of the readings: where passes after the first count rows."""
    return timed(t.telemetry.select("machineID", "datetime")).select("machineID", "_us")


def _finish(df: DataFrame) -> DataFrame:
    return standardise(df.drop("_us", "_kind"))


def _name_lists(events: DataFrame, name: str, start: Column, end: Column, out: str) -> DataFrame:
    """Moments at which the set of active event names changes, with that set.

    Column ``out`` holds (moment, comma list in order of name), whatever the names.
    An event is active in [start, end).
    """
    spans = events.select("machineID", start.alias("_low"), end.alias("_end"), F.col(name).alias("_name"))
    moments = spans.select("machineID", F.explode(F.array("_low", "_end")).alias("_us")).distinct()
    active = interval_join(
        moments, spans.withColumn("_high", F.col("_end") - 1), "machineID", "_us", "_low", "_high", 7 * DAY_US
    )
    listed = active.groupBy("machineID", "_us").agg(
        F.array_join(F.array_sort(F.collect_set("_name")), ",").alias("_list")
    )
    return moments.join(listed, ["machineID", "_us"], "left").select(
        "machineID", "_us", F.struct("_us", F.coalesce("_list", F.lit("")).alias("names")).alias(out)
    )


def _maint_marks(t: Tables, days: int, names: bool = True) -> DataFrame:
    """Each maintenance counts for readings in [event, event + days)."""
    m, end = timed(t.maint), F.col("_us") + days * DAY_US
    marks = active_marks(m, F.col("_us"), end, {"m_any": F.lit(1).cast("long")})
    if not names:
        return marks
    lists = _name_lists(m, "comp", F.col("_us"), end, "m_names")
    return marks.unionByName(lists, allowMissingColumns=True)


def _failure_marks(t: Tables, hours: int, names: bool = True) -> DataFrame:
    """Each failure counts for readings in [failure - hours, failure)."""
    f, start = timed(t.failures), F.col("_us") - hours * HOUR_US
    tags = {f"f_{c}": F.col("failure").contains(c).cast("long") for c in COMPONENTS}
    tags["f_any"] = F.lit(1).cast("long")
    marks = active_marks(f, start, F.col("_us"), tags)
    if not names:
        return marks
    lists = _name_lists(f, "failure", start, F.col("_us"), "f_names")
    return marks.unionByName(lists, allowMissingColumns=True)


FAILURE_TAGS = [*[f"f_{c}" for c in COMPONENTS], "f_any"]


def _count_active(
    rows: DataFrame, marks: DataFrame, names: list[str], lists: list[str], base: DataFrame
) -> DataFrame:
    """Running counts ``n_*`` of the tags and the newest list of each of ``lists``."""
    out = running(
        beside(rows, marks),
        ["machineID"],
        [F.col("_us"), F.col("_kind")],
        {f"n_{c}": ("sum", F.col(c)) for c in names} | {f"l_{c}": ("max", F.col(c)) for c in lists},
        span_of("_us", DAY_US),
        totals_of=beside(base, marks),
    ).filter("_kind = 1")
    return (
        out.drop("_kind", *names, *lists)
        .fillna(0, [f"n_{c}" for c in names])
        .withColumns({f"l_{c}": F.coalesce(f"l_{c}.names", F.lit("")) for c in lists})
    )


def _with_maintenance(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"n_m_any": "maint_count_7d", "l_m_names": "maint_components_replaced"})


def _with_labels(df: DataFrame) -> DataFrame:
    hours = (F.col("_next") - F.col("_us")) / F.lit(3.6e9)
    lists = {"failure_components": F.col("l_f_names")} if "l_f_names" in df.columns else {}
    return df.withColumns(
        {
            "failure_label": (F.col("n_f_any") > 0).cast("int"),
            **lists,
            **{f"failure_{c}": (F.col(f"n_f_{c}") > 0).cast("int") for c in COMPONENTS},
            "time_to_failure_hours": F.coalesce(hours, F.lit(NO_FAILURE_HOURS)),
        }
    ).drop("_next", "l_f_names", *[f"n_{c}" for c in FAILURE_TAGS])


def _errors_by_hour(t: Tables) -> DataFrame:
    return t.errors.groupBy(
        "machineID", F.date_trunc("hour", "datetime").alias("_hour")
    ).agg(
        F.count("*").alias("error_count_1h"),
        F.array_join(F.array_sort(F.collect_set("errorID")), ",").alias("error_types_1h"),
    )


def error_features(t: Tables, p: Params) -> DataFrame:
    """Errors per machine and telemetry hour: count and distinct types."""
    hours = t.telemetry.select(
        "machineID", F.date_trunc("hour", "datetime").alias("_hour")
    ).distinct()
    return standardise(
        hours.join(_errors_by_hour(t), ["machineID", "_hour"], "left")
        .fillna(0, ["error_count_1h"])
        .fillna("", ["error_types_1h"])
        .withColumnRenamed("_hour", "datetime")
    )


def maintenance_features(t: Tables, p: Params, days: int = 7) -> DataFrame:
    """Maintenance in the ``days`` up to each reading: count and components."""
    rows = _readings(t).select("machineID", "datetime", "_us")
    counted = _count_active(rows, _maint_marks(t, days), ["m_any"], ["m_names"], _base(t))
    return _finish(_with_maintenance(counted))


def _labelled(t: Tables, rows: DataFrame, hours: int) -> DataFrame:
    counted = _count_active(rows, _failure_marks(t, hours), FAILURE_TAGS, ["f_names"], _base(t))
    return _with_labels(next_time(counted, timed(t.failures), "_next", base=_base(t)))


def failure_labels(
    t: Tables, p: Params, hours: int = 24, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Label readings with a failure in (reading, reading + ``hours``].

    ``keep`` names telemetry columns to carry along.
    """
    rows = timed(t.telemetry.select("machineID", "datetime", *keep))
    return _finish(_labelled(t, rows, hours))


def lead_time_labels(
    t: Tables, p: Params, hours: int = 48, min_cycles: int = 24
) -> DataFrame:
    """Labels with a longer lead, from each machine's ``min_cycles``-th reading on."""
    rows = _readings(t).select("machineID", "datetime", "_us")
    ready = numbered(rows, ["machineID"], "_us").filter(F.col("_rn") >= min_cycles)
    return _finish(_labelled(t, ready.drop("_rn"), hours))


def asof_last_event(t: Tables, p: Params) -> DataFrame:
    """Last maintenance, error and failure at or before each reading."""
    events = {"maintenance": t.maint, "error": t.errors, "failure": t.failures}
    rows = _readings(t).select("machineID", "datetime", "_us")
    found = last_time(rows, {n: timed(df) for n, df in events.items()})
    for n in events:
        hours = (F.col("_us") - F.col(n)) / F.lit(3.6e9)
        found = found.withColumns(
            {f"last_{n}": F.timestamp_micros(n), f"hours_since_{n}": hours}
        ).drop(n)
    return _finish(found)


def master_table(
    t: Tables, p: Params, hours: int = 24, days: int = 7, names: bool = True
) -> DataFrame:
    """Readings with machine data, error and maintenance history and labels.

    All window counts share one pass over readings and marks; the only other
    pass looks for the next failure. ``names=False`` leaves out the lists of names
    (error types, components), which models don't take.
    """
    errors = active_marks(
        timed(t.errors), F.col("_us"), F.col("_us") + DAY_US, {"e_any": F.lit(1).cast("long")}
    )
    marks = errors
    for other in (_maint_marks(t, days, names), _failure_marks(t, hours, names)):
        marks = marks.unionByName(other, allowMissingColumns=True)
    tags, lists = [*FAILURE_TAGS, "m_any", "e_any"], ["m_names", "f_names"] if names else []
    counted = _count_active(_readings(t), marks, tags, lists, _base(t))
    ahead = next_time(counted, timed(t.failures), "_next", base=_base(t))
    full = _with_labels(_with_maintenance(ahead))
    by_hour = _errors_by_hour(t) if names else _errors_by_hour(t).drop("error_types_1h")
    full = (
        full.withColumn("_hour", F.date_trunc("hour", "datetime"))
        .join(by_hour, ["machineID", "_hour"], "left")
        .withColumnRenamed("n_e_any", "error_count_24h")
        .drop("_hour")
        .fillna(0, ["error_count_1h"])
    )
    if names:
        full = full.fillna("", ["error_types_1h"])
    return _finish(per_key_join(full, t.machines, how="left"))


def dataset_stats(t: Tables, p: Params) -> DataFrame:
    """Size, range and event totals of the master table in one row."""
    m = master_table(t, p)
    return m.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("machine_id").alias("n_machines"),
        F.lit(len(m.columns)).cast("long").alias("n_features"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.sum("failure_label").alias("n_failures"),
        (F.lit(100.0) * F.avg("failure_label")).alias("failure_rate_pct"),
        F.sum("error_count_1h").alias("n_errors"),
        F.sum("maint_count_7d").alias("n_maintenance_events"),
    )


def split_cut(df: DataFrame, test_share: float = 0.2, time: str = "timestamp"):
    """Microsecond stamp that leaves the last ``test_share`` of rows for testing."""
    stamps = df.select(F.unix_micros(time).cast("double").alias("_at"))
    return exact_quantiles(stamps, "_at", {"cut": 1 - test_share}, []).scalar()


def temporal_split(df: DataFrame, test_share: float = 0.2) -> DataFrame:
    """Add ``split``: train before the cut time, test from it on; ties stay together."""
    train = F.unix_micros("timestamp") < split_cut(df, test_share)
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def class_balance(t: Tables, p: Params) -> DataFrame:
    """Rows and share of positive labels in each split."""
    return (
        temporal_split(failure_labels(t, p))
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.avg("failure_label").alias("positive_rate"))
        .orderBy("split")
    )


def class_weights(df: DataFrame, label: str = "failure_label") -> DataFrame:
    """Balanced weight n / (classes * n_class) of each class (tiny result)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    whole = total.select(F.struct("*")).scalar()
    return counts.withColumn("weight", whole["n"] / (whole["k"] * F.col("n")))
