import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_session():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[8]")
        .appName("gearlog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gearlog-"))
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
