"""The fleet tables derived from the generic ``events`` and ``customer`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

EVENTS = (
    "event_id long, ts timestamp, user_id long, event_type string, "
    "value double, props string"
)
CUSTOMER = "c_custkey long, c_nationkey int, c_mktsegment string"


def telemetry_of(events: DataFrame) -> DataFrame:
    """Every event is one reading; works on batch and streaming frames."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        F.col("user_id").alias("machineID"),
        F.col("ts").alias("datetime"),
        F.col("value").alias("volt"),
        k.cast("double").alias("rotate"),
        (F.lit(90) + F.col("event_id") % 21).cast("double").alias("pressure"),
        (F.lit(25.0) + F.lit(0.3) * F.col("value") + k % 7).alias("vibration"),
    )


def bind(spark: SparkSession, folder: str) -> Tables:
    """Map the files in ``folder`` onto the fleet tables."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # the JVM doesn't compile larger methods; wide projections are faster cut into small ones
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    events = spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")
    customer = spark.read.schema(CUSTOMER).parquet(f"{folder}/customer.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    machine = F.col("user_id").alias("machineID")
    day = F.date_trunc("day", "ts").alias("datetime")
    comp = F.concat(F.lit("comp"), (F.col("event_id") % 4 + 1).cast("string"))
    return Tables(
        telemetry=telemetry_of(events),
        errors=events.filter("event_type = 'error'").select(
            F.date_trunc("hour", "ts").alias("datetime"),
            machine,
            F.concat(F.lit("error"), (F.col("event_id") % 5 + 1).cast("string")).alias(
                "errorID"
            ),
        ),
        maint=events.filter("event_type = 'purchase'").select(
            day, machine, F.when(k % 5 == 0, "other").otherwise(comp).alias("comp")
        ),
        failures=events.filter((F.col("event_type") == "signup") & (k % 10 == 0)).select(
            day, machine, comp.alias("failure")
        ),
        machines=customer.select(
            F.col("c_custkey").alias("machineID"),
            F.col("c_mktsegment").alias("model"),
            F.col("c_nationkey").alias("age"),
        ),
    )
