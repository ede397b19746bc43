"""Running streaming operators to tables in the shared folder.

All tables are written per batch under the batch's number, so a batch that runs
again after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.spans import HOUR_US
from ..operators.smoothing import EWMA, ewma
from ..params import FEATURE_SENSORS
from ..sources.shared import read_or_empty, remove, shared_path
from ..sources.tables import standardise
from .readings import panes, windows_of


def append_to(stream: DataFrame, path: str) -> DataFrame:
    """Run an append-mode stream over all input there is and return its table."""
    (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    return read_or_empty(spark, stream.schema, f"{path}/table")


def update_to(stream: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Run an update-mode stream and return the newest row of each key.

    A batch writes only the rows it changed, and the watermark may drop old
    state, so neither state nor output is rewritten as a whole.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/batch={number}")

    (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{path}/progress")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    spark = stream.sparkSession
    versions = StructType([*stream.schema.fields, StructField("batch", IntegerType())])
    changes = read_or_empty(spark, versions, f"{path}/table")
    # one partition holds the versions of one result row
    newest = Window.partitionBy(*key).orderBy(F.desc("batch"))
    return (
        changes.withColumn("_nth", F.row_number().over(newest))
        .filter("_nth = 1")
        .drop("_nth", "batch")
    )


def slide_to(stream: DataFrame, path: str, width: int = 24, step: int = 1, late: int = 1) -> DataFrame:
    """Run a stream of readings and return its overlapping windows (all in hours).

    A window of ``width`` is made of panes of ``step``. A batch writes its own panes and
    no state; windows are put together when the table is read, so neither state, nor
    shuffles, nor tables hold a reading ``width / step`` times. A reading counts for
    the windows still open under the newest reading of earlier batches less ``late``.
    """
    if width % step:
        raise ValueError("width must be a multiple of step")
    spark = stream.sparkSession
    empty = spark.createDataFrame([], stream.schema)
    shape = panes(empty, f"{step} hours").withColumn("closed", F.lit(None).cast("long")).schema

    def save(batch: DataFrame, number: int) -> None:
        marks = read_or_empty(spark, StructType.fromDDL("closed long, batch int"), f"{path}/marks")
        closed = marks.filter(F.col("batch") < number).agg(F.max("closed")).first()[0]
        found = panes(batch, f"{step} hours").withColumn("closed", F.lit(closed).cast("long"))
        found.write.mode("overwrite").parquet(f"{path}/table/batch={number}")
        newest = spark.read.schema(shape).parquet(f"{path}/table/batch={number}").agg(F.max("newest").alias("at"))
        # a watermark counts in milliseconds
        mark = newest.select((F.floor(F.col("at") / 1000) * 1000 - late * HOUR_US).cast("long").alias("closed"))
        mark.write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return windows_of(read_or_empty(spark, shape, f"{path}/table"), width * HOUR_US, step * HOUR_US)


#: Batches after which the state of all machines is written as a whole.
COMPACT = 16


def smooth_to(stream: DataFrame, path: str) -> DataFrame:
    """Exponentially weighted means over a stream, with state carried in a table.

    Readings are smoothed in time order inside a batch and batches in the order
    they arrive. Each batch is one distributed ``ewma`` that starts from the
    values its machines had reached; it writes the state of its machines only,
    and every ``COMPACT`` batches that of all machines, after which older state
    is removed.
    """
    spark = stream.sparkSession
    names = [f"{s}_{n}" for s in FEATURE_SENSORS for n in EWMA]
    gaps = [f"{s}_gap" for s in FEATURE_SENSORS]
    state_type = ", ".join(
        ["machine_id long", *[f"{n} double" for n in names], *[f"{n} long" for n in gaps]]
    )
    empty = standardise(stream).select("machine_id", "timestamp", *FEATURE_SENSORS).schema
    result = ewma(spark.createDataFrame([], empty)).schema

    def state_before(number: int) -> DataFrame:
        if number == 0:
            return spark.createDataFrame([], state_type)
        first = (number - 1) // COMPACT * COMPACT
        paths = [f"{path}/state/batch={k}" for k in range(first, number)]
        versions = spark.read.option("basePath", f"{path}/state").schema(f"{state_type}, batch int")
        newest = Window.partitionBy("machine_id").orderBy(F.desc("batch"))
        return (
            versions.parquet(*paths)
            .withColumn("_nth", F.row_number().over(newest))
            .filter("_nth = 1")
            .drop("_nth", "batch")
        )

    def step(batch: DataFrame, number: int) -> None:
        rows = standardise(batch).select("machine_id", "timestamp", *FEATURE_SENSORS)
        before = state_before(number)
        known = before.join(rows.select("machine_id").distinct(), "machine_id", "left_semi")
        smoothed = ewma(rows, carry=known, gaps=True)
        smoothed.write.mode("overwrite").parquet(f"{path}/table/batch={number}")
        done = spark.read.schema(smoothed.schema).parquet(f"{path}/table/batch={number}")
        last = done.groupBy("machine_id").agg(
            *[F.max_by(n, "timestamp").alias(n) for n in [*names, *gaps]]
        )
        if number % COMPACT == 0:
            last = last.unionByName(before.join(last, "machine_id", "left_anti"))
        last.write.mode("overwrite").parquet(f"{path}/state/batch={number}")
        if number % COMPACT == 1:  # the batch before has written the whole state
            for k in range(number - 1 - COMPACT, number - 1):
                if k >= 0:
                    remove(spark, f"{path}/state/batch={k}")

    (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return read_or_empty(spark, result, f"{path}/table")


def new_run(spark: SparkSession, name: str) -> str:
    return shared_path(spark, f"stream-{name}")
