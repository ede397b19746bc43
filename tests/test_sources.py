"""Readers, names and sinks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from gearlog.sources.shared import shared_base, shared_path
from gearlog.sources.sinks import write_features, write_report
from gearlog.sources.tables import SCHEMAS, read_csv, read_parquet_tables, standardise
from tests.fixtures import hours, noisy, reading, tables


def _csv(tmp_path, text):
    path = tmp_path / "telemetry.csv"
    path.write_text(text)
    return f"file://{path}"


def test_csv_types_and_names(spark, tmp_path):
    path = _csv(
        tmp_path,
        "datetime,machineID,volt,rotate,pressure,vibration\n"
        "2015-01-01 06:00:00,1,176.217853,418.504078,113.077935,45.087686\n",
    )
    df = read_csv(spark, "telemetry", path, standard=True)
    assert df.columns == ["timestamp", "machine_id", "voltage", "rotation_speed", "pressure", "vibration"]
    row = df.first()
    assert (row["timestamp"], row["machine_id"], row["voltage"]) == (hours(6), 1, 176.217853)


@pytest.mark.parametrize(
    "text",
    [
        "datetime,machineID,volt,rotate,pressure,vibration\n2015-01-01 06:00:00,x,1,2,3,4\n",
        "machineID,datetime,volt,rotate,pressure,vibration\n1,2015-01-01 06:00:00,1,2,3,4\n",
    ],
)
def test_csv_that_does_not_fit_fails(spark, tmp_path, text):
    with pytest.raises(Exception):
        read_csv(spark, "telemetry", _csv(tmp_path, text)).collect()


def test_registered_names(spark):
    t = tables(spark, telemetry=[reading(0)], machines=[(1, "model1", 3)])
    t.register()
    out = spark.sql(
        "SELECT model, volt FROM pdm_telemetry JOIN pdm_machines USING (machineID)"
    ).collect()
    assert [tuple(r) for r in out] == [("model1", 170.0)]


def test_feature_sink_is_partitioned_by_day(spark):
    path = shared_path(spark, "days")
    df = standardise(tables(spark, telemetry=noisy(2, 50)).telemetry)
    write_features(df, path)
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    plan = back.filter("date = '2015-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    files = glob.glob(f"{path.removeprefix('file:')}/date=2015-01-02/*.snappy.parquet")
    assert files


def test_report_is_one_file(spark):
    path = shared_path(spark, "report")
    write_report(spark.range(20, numPartitions=4).select(F.col("id").alias("n")), path)
    assert len(glob.glob(f"{path.removeprefix('file:')}/*.csv")) == 1


def test_tables_from_parquet(spark):
    path = shared_path(spark, "tables")
    t = tables(spark, telemetry=[reading(0)])
    for name in SCHEMAS:
        getattr(t, name).write.parquet(f"{path}/{name}")
    assert read_parquet_tables(spark, path).telemetry.count() == 1


def test_shared_folder_is_the_sessions(spark):
    wanted = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_base(spark) == wanted.rstrip("/")
    assert os.path.basename(shared_path(spark, "x")).startswith("x-")
