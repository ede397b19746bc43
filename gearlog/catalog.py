"""Every operator bound to the test tables under the name it is checked by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import (
    advanced,
    cost,
    evaluate,
    explore,
    failures,
    features,
    fleet,
    health,
    kpi,
    labels,
    maintenance,
    modeling,
    prepare,
    quality,
    smoothing,
)
from .params import FEATURE_SENSORS, FIXTURE
from .plans.feature_table import NOT_FEATURES, build_features
from .sources.bindings import EVENTS, bind, telemetry_of
from .sources.shared import shared_path
from .sources.sinks import write_csv, write_features
from .sources.tables import FILES, SCHEMAS, Tables, read_csv_tables, standardise
from .streaming import jobs
from .streaming import readings as streams
from .streaming import rollups, state

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(fn, **options) -> Query:
    return lambda spark, folder: fn(bind(spark, folder), FIXTURE, **options)


def _readings(t: Tables) -> DataFrame:
    return standardise(t.telemetry.drop("event_id"))


def _feature(fn) -> Query:
    """A feature operator on the readings: keys and the columns it adds."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(_readings(bind(spark, folder))).drop(*FEATURE_SENSORS)

    return run


def _event_history(t: Tables, p) -> DataFrame:
    rows = labels.master_table(t, p).select("machine_id", "timestamp", "error_count_1h")
    base = _readings(t).select("machine_id", F.unix_micros("timestamp").alias("_us"))
    return features.event_history(rows, t.maint, base=base).drop("error_count_1h")


def _sequences(t: Tables, p) -> DataFrame:
    labelled = labels.master_table(t, p).select(
        "machine_id", "timestamp", "failure_label", *FEATURE_SENSORS
    )
    return prepare.sequences(labelled)


def _sequence_rows(t: Tables, p) -> DataFrame:
    return _sequences(t, p).select(
        "machine_id", "start_time", "end_time", "label", F.posexplode("steps").alias("pos", "s")
    ).select("machine_id", "start_time", "end_time", "label", "pos", "s.*")


def _split_times(t: Tables, p) -> DataFrame:
    return labels.temporal_split(_readings(t)).select("machine_id", "timestamp", "split")


def pseudo_scores(t: Tables, p) -> DataFrame:
    """Two deterministic "models" scoring every reading, for the evaluation operators."""
    rows = labels.failure_labels(t, p, keep=("event_id",))
    models = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.lit(step).cast("long").alias("step"))
            for name, step in (("A", 7919), ("B", 104729))
        ]
    )
    noise = ((F.col("event_id") * F.col("m.step")) % 1000) / F.lit(1600.0)
    score = F.lit(0.05) + F.lit(0.4) * F.col("failure_label") + noise
    return rows.withColumn("m", F.explode(models)).select(
        "machine_id",
        "timestamp",
        "m.model",
        F.col("failure_label").alias("label"),
        F.least(F.lit(0.99), score).alias("probability"),
        (F.least(F.lit(0.99), score) >= 0.5).cast("int").alias("prediction"),
        "time_to_failure_hours",
    )


def _evaluated(fn) -> Query:
    return lambda spark, folder: fn(pseudo_scores(bind(spark, folder), FIXTURE))


def _vote(df: DataFrame) -> DataFrame:
    return evaluate.ensemble_vote(df, ["machine_id", "timestamp"], {"A": 2.0, "B": 1.0})


def _strategies(fn) -> Callable:
    """Cost operators fed with measured recall and precision of model A."""

    def run(t: Tables, p) -> DataFrame:
        scores = pseudo_scores(t, p).filter("model = 'A'")
        m = evaluate.classification_metrics(scores).select(F.struct("recall", "precision")).scalar()
        seg = kpi.segments(t, p).withColumn("_m", m)  # one row, read once
        return fn(seg, p, F.col("_m.recall"), F.col("_m.precision"))

    return run


def _drift(t: Tables, p) -> DataFrame:
    old = t.telemetry.filter(F.col("datetime") < F.lit(p.reference_before).cast("timestamp"))
    new = t.telemetry.filter(F.col("datetime") >= F.lit(p.recent_from).cast("timestamp"))
    return quality.ks_drift(old, new)


def _pivot_rows(t: Tables, p) -> DataFrame:
    wide = kpi.health_pivot(t, p)
    days = [c for c in wide.columns if c != "machineID"]
    return wide.unpivot(["machineID"], days, "day", "health_score").filter(
        "health_score is not null"
    )


def _parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Readings through the partitioned feature sink and back."""
    path = shared_path(spark, "features")
    write_features(_readings(bind(spark, folder)), path)
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """All five tables through CSV and back, joined to one row set by table."""
    t, path = bind(spark, folder), shared_path(spark, "csv")
    for name, file in FILES.items():
        write_csv(getattr(t, name).select(*SCHEMAS[name].names), f"{path}/{file}")
    back = read_csv_tables(spark, path)
    logs = None
    for name, what in (("errors", "errorID"), ("maint", "comp"), ("failures", "failure")):
        df = getattr(back, name).select(
            F.lit(name).alias("source"), "datetime", "machineID", F.col(what).alias("what")
        )
        logs = df if logs is None else logs.unionByName(df)
    readings = back.telemetry.select(
        F.lit("telemetry").alias("source"),
        "datetime",
        "machineID",
        F.lit(None).cast("string").alias("what"),
        (F.col("volt") + F.col("rotate") + F.col("pressure") + F.col("vibration")).alias("x"),
    )
    machines = back.machines.select(
        F.lit("machines").alias("source"),
        "machineID",
        F.col("model").alias("what"),
        F.col("age").cast("double").alias("x"),
    )
    out = readings.unionByName(logs, allowMissingColumns=True)
    return out.unionByName(machines, allowMissingColumns=True)


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return telemetry_of(streams.read_files(spark, folder, EVENTS, "events.parquet"))


WINDOW_KEY = ["machineID", "window_start"]


def _windows(name: str, fn) -> Query:
    return lambda spark, folder: jobs.update_to(
        fn(_stream(spark, folder)), jobs.new_run(spark, name), WINDOW_KEY
    )


def _baseline(spark: SparkSession, folder: str) -> DataFrame:
    old = F.col("datetime") < F.lit(FIXTURE.reference_before).cast("timestamp")
    return (
        bind(spark, folder)
        .telemetry.filter(old)
        .groupBy("machineID")
        .agg(F.avg("vibration").alias("mean"), F.stddev("vibration").alias("std"))
    )


def _stream_prefilter(spark: SparkSession, folder: str) -> DataFrame:
    found = streams.prefilter(_stream(spark, folder), _baseline(spark, folder), sigmas=2.0)
    return jobs.append_to(found, jobs.new_run(spark, "prefilter"))


def _stream_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = streams.flag_odd(_stream(spark, folder), _baseline(spark, folder), sigmas=2.0)
    return jobs.append_to(flagged, jobs.new_run(spark, "flags"))


def _stream_late_data(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth event arrives after all the others, too late for most windows."""
    events, path = spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet"), jobs.new_run(spark, "late")
    late, out = F.col("event_id") % 10 == 0, None
    for name, rows in (("a", events.filter(~late)), ("b", events.filter(late))):
        # as many files as the source has splits: one file would be one task's to aggregate
        rows.write.parquet(f"{path}/arrived/{name}")
        arriving = streams.read_files(spark, f"{path}/arrived/*", EVENTS, "*.parquet")
        hours = streams.tumbling(telemetry_of(arriving))
        out = jobs.update_to(hours, f"{path}/windows", WINDOW_KEY)
    return out


def _stream_last_events(spark: SparkSession, folder: str) -> DataFrame:
    events = streams.read_files(spark, folder, EVENTS, "events.parquet").select(
        F.col("user_id").alias("machineID"),
        F.col("ts").cast("timestamp").alias("datetime"),
        F.col("event_type").alias("kind"),
    )
    last = streams.last_events(events, ("error", "purchase", "signup"))
    return jobs.update_to(last, jobs.new_run(spark, "last"), ["machineID"])


def _hourly_states(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.update_to(
        rollups.partial_states(_stream(spark, folder)), jobs.new_run(spark, "states"), WINDOW_KEY
    )


def _stream_rollup_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.statistics(rollups.merged(_hourly_states(spark, folder), "day"))


def _stream_rollup_monthly(spark: SparkSession, folder: str) -> DataFrame:
    days = rollups.merged(_hourly_states(spark, folder), "day")
    return rollups.statistics(rollups.merged(days, "month"))


ORDER = ("datetime", "event_id")


def _stream_machine_state(spark: SparkSession, folder: str) -> DataFrame:
    with state.rocksdb(spark):
        states = state.machine_state(_stream(spark, folder), expiry_hours=120, order=ORDER)
        return jobs.append_to(states, jobs.new_run(spark, "state"))


def _stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    readings = _stream(spark, folder).withWatermark("datetime", streams.WATERMARK)
    scored = streams.flag_odd(readings, _baseline(spark, folder), sigmas=2.0, keep=("event_id",))
    with state.rocksdb(spark):
        events = state.alert_states(scored, 1.5, 0.75, quiet_hours=168, order=ORDER)
        return jobs.append_to(events, jobs.new_run(spark, "alerts"))


STREAMS: dict[str, Query] = {
    "stream_rollup_daily": _stream_rollup_daily,
    "stream_rollup_monthly": _stream_rollup_monthly,
    "stream_machine_state": _stream_machine_state,
    "stream_alerts": _stream_alerts,
    "stream_late_data": _stream_late_data,
    "stream_last_events": _stream_last_events,
    "stream_flags": _stream_flags,
    "stream_sessions": lambda spark, folder: jobs.append_to(
        streams.sessions(_stream(spark, folder)), jobs.new_run(spark, "sessions")
    ),
    "stream_tumbling": _windows("hours", streams.tumbling),
    "stream_tumbling_5min": _windows("minutes", lambda r: streams.tumbling(r, "5 minutes")),
    "stream_sliding": lambda spark, folder: jobs.slide_to(
        _stream(spark, folder), jobs.new_run(spark, "sliding")
    ),
    "stream_downsample": _windows("days", streams.downsample),
    "stream_prefilter": _stream_prefilter,
    "stream_quality": lambda spark, folder: jobs.append_to(
        streams.quality(_stream(spark, folder)), jobs.new_run(spark, "quality")
    ),
    "stream_ewma_state": lambda spark, folder: jobs.smooth_to(
        _stream(spark, folder), jobs.new_run(spark, "ewma")
    ).drop(*FEATURE_SENSORS),
}

# Sizes of the trained check forests; the library's defaults are the full ones.
CHECK_FOREST = {"trees": 10, "depth": 6}


def _model_rows(t: Tables, p) -> tuple[DataFrame, list[str]]:
    """The training table, without names; it is written once, since training reads it
    many times, and as it comes, since training reads all days."""
    table = features.calendar_features(labels.master_table(t, p, names=False))
    path = shared_path(table.sparkSession, "training")
    table.write.parquet(path)
    df = modeling.three_way_split(table.sparkSession.read.schema(table.schema).parquet(path))
    return df, [*FEATURE_SENSORS, *modeling.numeric_columns(df, NOT_FEATURES)]


def _predictions(train, **settings) -> Callable:
    def run(t: Tables, p) -> DataFrame:
        df, names = _model_rows(t, p)
        model = train(df, names, **settings)
        return modeling.predict(model, df.filter("split = 'test'")).select(
            "machine_id", "timestamp", modeling.LABEL, "probability", "prediction"
        )

    return run


def _importance(t: Tables, p) -> DataFrame:
    df, names = _model_rows(t, p)
    model = modeling.train_forest(df, names, **CHECK_FOREST)
    return modeling.feature_importance(df.sparkSession, model, names)


HISTORY: dict[str, Callable] = {
    "similar_machines": lambda t, p: fleet.similar_machines(t, p, 3),
    "error_to_failure_machine": lambda t, p: maintenance.error_to_failure(t, p, machine=12),
    "error_features": labels.error_features,
    "maintenance_features": labels.maintenance_features,
    "failure_labels": labels.failure_labels,
    "lead_time_labels": labels.lead_time_labels,
    "asof_last_event": labels.asof_last_event,
    "master_table": labels.master_table,
    "dataset_stats": labels.dataset_stats,
    "class_balance": labels.class_balance,
    "class_weights": lambda t, p: labels.class_weights(labels.failure_labels(t, p)),
    "temporal_split": _split_times,
    "event_history": _event_history,
    "robust_scaled": lambda t, p: prepare.robust_scaled(_readings(t)),
    "sequences": _sequence_rows,
    "sequence_split": lambda t, p: prepare.sequence_split(_sequences(t, p)).drop("steps"),
    "validate_telemetry": lambda t, p: quality.validate_telemetry(
        t.telemetry, arrival="event_id"
    ),
    "loader_checks": lambda t, p: quality.loader_checks(t.telemetry, arrival="event_id"),
    "ks_drift": _drift,
    "health_pivot": _pivot_rows,
    "health_timeline": kpi.health_timeline,
    "health_timeline_machines": lambda t, p: kpi.health_timeline(t, p, per_machine=True),
    "score_histogram": kpi.score_histogram,
    "machine_groups": kpi.machine_groups,
    "event_slice_trends": kpi.event_slice_trends,
    "fleet_kpi_cards": kpi.fleet_kpi_cards,
    "risk_bands": kpi.risk_bands,
    "risk_counts": kpi.risk_counts,
    "at_risk_topk": kpi.at_risk_topk,
    "machine_card": kpi.machine_card,
    "alerts": kpi.alerts,
    "monthly_cost_by_strategy": kpi.monthly_cost_by_strategy,
    "cost_by_component": kpi.cost_by_component,
    "strategy_costs": _strategies(kpi.strategy_costs),
    "strategy_roi_summary": _strategies(kpi.strategy_roi_summary),
    "roi_grid": lambda t, p: kpi.roi_grid(kpi.segments(t, p), p),
    "gbt_predictions": _predictions(modeling.train_gbt),
    "forest_predictions": _predictions(modeling.train_forest, **CHECK_FOREST),
    "feature_importance": _importance,
    "time_series_folds": lambda t, p: modeling.fold_sizes(labels.failure_labels(t, p)),
    "build_features": lambda t, p: build_features(t, p, drop_null=False),
}


def queries() -> dict[str, Query]:
    plain = [
        explore.table_counts,
        explore.coverage,
        explore.missing_hours,
        explore.age_distribution,
        explore.sensor_summary,
        explore.model_distribution,
        explore.machines_per_model,
        explore.sigma_outliers,
        health.health_score,
        health.vibration_drift,
        health.degradation_rate,
        health.weekly_anomalies,
        health.never_failed,
        health.anomaly_leaders,
        health.anomaly_leaders_global,
        health.rolling_daily_trend,
        health.sensor_correlation,
        health.threshold_exceedance,
        health.health_mix,
        health.spike_detection,
        health.operating_hours,
        failures.failures_by_component,
        failures.monthly_failures,
        failures.mtbf,
        failures.weibull_fit,
        failures.failure_rate_by_model,
        failures.failure_sequences,
        failures.problem_machines,
        failures.failure_cascade,
        failures.failures_by_age,
        failures.failures_by_weekday,
        maintenance.reactive_ratio,
        maintenance.error_to_failure,
        maintenance.error_outcomes,
        maintenance.maintenance_effectiveness,
        maintenance.replacement_cost,
        maintenance.maintenance_intervals,
        maintenance.replacement_frequency,
        maintenance.overdue_maintenance,
        maintenance.monthly_downtime,
        cost.monthly_tco,
        cost.cost_per_failure_type,
        cost.strategy_roi,
        cost.sensor_investment,
        cost.cumulative_downtime_cost,
        cost.cost_per_machine,
        cost.conversion_savings,
        fleet.risk_ranking,
        fleet.machine_similarity,
        fleet.utilisation,
        fleet.monthly_fleet_summary,
        fleet.replacement_priority,
        fleet.fleet_kpis,
        fleet.peer_ranking,
        advanced.survival_summary,
        advanced.survival_curve,
        advanced.maintenance_forecast,
        advanced.prefailure_profile,
        advanced.prognostic_horizon,
        advanced.failure_correlation,
    ]
    out: dict[str, Query] = {fn.__name__: _on_tables(fn) for fn in plain}
    out["missing_hours_to_last"] = _on_tables(explore.missing_hours, end="ts", top=None)
    out["failure_cascade_within"] = _on_tables(failures.failure_cascade, within=True)
    for fn in (
        failures.failures_by_age,
        cost.monthly_tco,
        cost.cost_per_machine,
        fleet.risk_ranking,
        fleet.monthly_fleet_summary,
        fleet.replacement_priority,
        fleet.fleet_kpis,
        fleet.peer_ranking,
    ):
        out[f"{fn.__name__}_literal"] = _on_tables(fn, fanout=True)
    for name, fn in HISTORY.items():
        out[name] = _on_tables(fn)
    for fn in (
        features.rolling_moments,
        features.rolling_shape,
        features.rolling_quantiles,
        features.rate_of_change,
        features.lags,
        features.trend_slopes,
        features.spectral,
        features.interactions,
        features.rolling_corr,
        smoothing.ewma,
        features.cumulative_deviation,
        features.baseline_zscore,
        features.calendar_features,
    ):
        out[fn.__name__] = _feature(fn)
    for fn in (
        evaluate.confusion_counts,
        evaluate.classification_metrics,
        evaluate.roc_auc,
        evaluate.average_precision,
        evaluate.brier,
        evaluate.cost_total,
        evaluate.phm_score,
        evaluate.lead_time,
        evaluate.prognostic_horizon_rows,
        evaluate.compare_models,
        evaluate.threshold_table,
        evaluate.cost_curve,
        evaluate.roc_curve,
        evaluate.pr_curve,
        evaluate.calibration,
        evaluate.model_report,
        evaluate.confusion_cost_cells,
        evaluate.tuned_threshold,
    ):
        out[fn.__name__] = _evaluated(fn)
    out["parquet_roundtrip"] = _parquet_roundtrip
    out["csv_roundtrip"] = _csv_roundtrip
    out |= STREAMS
    out["ensemble_vote"] = _evaluated(_vote)
    out["failure_correlation_once"] = _on_tables(advanced.failure_correlation, once=True)
    return out
