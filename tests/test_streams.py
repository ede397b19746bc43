"""Streams give what batch gives; late data and restarts."""

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gearlog import catalog
from gearlog.operators import smoothing
from gearlog.sources.shared import shared_path
from gearlog.sources.tables import SCHEMAS, standardise
from gearlog.streaming import jobs
from gearlog.streaming import readings as streams
from tests.fixtures import hours, noisy, reading, rows, tables


def _write(spark, folder, name, data):
    df = tables(spark, telemetry=data).telemetry
    df.coalesce(1).write.parquet(os.path.join(folder, name))


def _stream(spark, folder):
    reader = spark.readStream.schema(SCHEMAS["telemetry"]).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/*")


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="gearlog-stream-")


def test_late_reading_does_not_change_a_closed_window(spark, folder):
    """10:00 and 15:00, then 10:30 (late) and 20:00: the 10:00 window stays at 1."""
    path = shared_path(spark, "late")
    _write(spark, folder, "a", [reading(10), reading(15)])
    key = ["machineID", "window_start"]
    jobs.update_to(streams.tumbling(_stream(spark, folder)), path, key)
    _write(spark, folder, "b", [reading(10.5), reading(20)])
    out = jobs.update_to(streams.tumbling(_stream(spark, folder)), path, key)
    got = [(r[0].hour, r[1]) for r in rows(out, "window_start", "readings")]
    assert got == [(10, 1), (15, 1), (20, 1)]


def test_update_keeps_the_newest_version(spark, folder):
    path = shared_path(spark, "update")
    _write(spark, folder, "a", [reading(10)])
    _write(spark, folder, "b", [reading(10.2), reading(10.4)])
    out = jobs.update_to(
        streams.tumbling(_stream(spark, folder), late="1 day"), path, ["machineID", "window_start"]
    )
    assert rows(out, "readings") == [(3,)]


def test_slid_windows_equal_the_direct_ones(spark, folder):
    """Batches, a restart, a missing reading, and equal readings in one window."""
    data = noisy(3, 60) + [(hours(7.5), 9, None, 450.0, 100.0, 40.0), *[reading(h + 0.1, 8) for h in range(5)]]
    cut = sorted(r[0] for r in data)[100]
    path = shared_path(spark, "slide")
    _write(spark, folder, "a", [r for r in data if r[0] < cut])
    jobs.slide_to(_stream(spark, folder), path)
    _write(spark, folder, "b", [r for r in data if r[0] >= cut])
    out = jobs.slide_to(_stream(spark, folder), path)
    want = streams.sliding(tables(spark, telemetry=data).telemetry)
    key = ["machineID", "window_start", "window_end", "readings"]
    a, b = [df.select(*want.columns).toPandas().sort_values(key, ignore_index=True) for df in (out, want)]
    assert list(a.columns) == list(b.columns)
    pd.testing.assert_frame_equal(a, b, rtol=1e-9, atol=1e-9)


def test_late_reading_counts_for_the_windows_still_open(spark, folder):
    """10:00 and 15:00 close windows that end by 14:00; a reading of 13:30 is in the others."""
    path = shared_path(spark, "slide-late")
    _write(spark, folder, "a", [reading(10), reading(15)])
    jobs.slide_to(_stream(spark, folder), path, width=2)
    _write(spark, folder, "b", [reading(13.5), reading(10.5)])
    out = jobs.slide_to(_stream(spark, folder), path, width=2)
    got = [(r[0].hour, r[1]) for r in rows(out, "window_start", "readings")]
    assert got == [(9, 1), (10, 1), (13, 1), (14, 1), (15, 1)]


def test_sliding_writes_no_row_per_window(spark, monkeypatch):
    path = shared_path(spark, "slide-size")
    monkeypatch.setattr(jobs, "new_run", lambda spark, name: path)
    folder = "/root/testdata/sf0.001"
    windows = catalog.queries()["stream_sliding"](spark, folder).count()
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    assert spark.read.parquet(f"{path}/table").count() <= events < windows


def test_late_data_arrives_in_as_many_files_as_it_had(spark, monkeypatch):
    """One file for all would be aggregated by one task."""
    path, folder = shared_path(spark, "late-files"), shared_path(spark, "late-in")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(16).write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(jobs, "new_run", lambda spark, name: path)
    with_small = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        catalog.queries()["stream_late_data"](spark, folder)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", with_small)
    assert len(spark.read.parquet(f"{path}/arrived/a").inputFiles()) > 1


def test_ewma_stream_continues_over_batches(spark, folder):
    data = noisy(3, 40)
    cut = sorted(r[0] for r in data)[60]
    _write(spark, folder, "a", [r for r in data if r[0] < cut])
    out = jobs.smooth_to(_stream(spark, folder), shared_path(spark, "ewma"))
    path = shared_path(spark, "ewma")
    first = jobs.smooth_to(_stream(spark, folder), path).count()
    _write(spark, folder, "b", [r for r in data if r[0] >= cut])
    out = jobs.smooth_to(_stream(spark, folder), path)
    assert out.count() == len(data) > first
    batch = smoothing.ewma(standardise(tables(spark, telemetry=data).telemetry))
    name = "vibration_ewma_alpha005"
    both = out.select("machine_id", "timestamp", F.col(name).alias("a")).join(
        batch.select("machine_id", "timestamp", F.col(name).alias("b")), ["machine_id", "timestamp"]
    )
    assert both.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    assert both.count() == len(data)


def test_quality_stream_drops_repeats(spark, folder):
    _write(spark, folder, "a", [reading(1), reading(1), reading(2, volt=None), reading(3, volt=-5.0)])
    out = jobs.append_to(streams.quality(_stream(spark, folder)), shared_path(spark, "quality"))
    assert [r[1:] for r in rows(out, "datetime", "has_missing", "is_negative")] == [
        (False, False),
        (True, False),
        (False, True),
    ]
