"""The five fleet tables: schemas, CSV readers, names for SQL."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw file names, raw column names and their standard names.
FILES = {
    "telemetry": "PdM_telemetry.csv",
    "errors": "PdM_errors.csv",
    "maint": "PdM_maint.csv",
    "failures": "PdM_failures.csv",
    "machines": "PdM_machines.csv",
}
STANDARD_NAMES = {
    "machineID": "machine_id",
    "datetime": "timestamp",
    "volt": "voltage",
    "rotate": "rotation_speed",
    "pressure": "pressure",
    "vibration": "vibration",
    "errorID": "error_id",
    "comp": "component",
    "failure": "failure_type",
    "model": "machine_model",
    "age": "machine_age_years",
}


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols.items()])


SCHEMAS = {
    "telemetry": _schema(
        datetime=T.TimestampType(),
        machineID=T.LongType(),
        volt=T.DoubleType(),
        rotate=T.DoubleType(),
        pressure=T.DoubleType(),
        vibration=T.DoubleType(),
    ),
    "errors": _schema(
        datetime=T.TimestampType(), machineID=T.LongType(), errorID=T.StringType()
    ),
    "maint": _schema(
        datetime=T.TimestampType(), machineID=T.LongType(), comp=T.StringType()
    ),
    "failures": _schema(
        datetime=T.TimestampType(), machineID=T.LongType(), failure=T.StringType()
    ),
    "machines": _schema(
        machineID=T.LongType(), model=T.StringType(), age=T.IntegerType()
    ),
}


@dataclass(frozen=True)
class Tables:
    """One DataFrame per fleet table, under the raw column names."""

    telemetry: DataFrame
    errors: DataFrame
    maint: DataFrame
    failures: DataFrame
    machines: DataFrame

    def as_of(self, params) -> Column:
        """The moment relative look-backs count from."""
        if params.as_of is not None:
            return F.lit(params.as_of).cast("timestamp")
        return self.telemetry.agg(F.max("datetime")).scalar()

    def register(self, prefix: str = "pdm_") -> None:
        """Name the tables for ``spark.sql``: pdm_telemetry, pdm_errors, ..."""
        for f in fields(self):
            getattr(self, f.name).createOrReplaceTempView(prefix + f.name)


def read_csv(
    spark: SparkSession, table: str, path: str, standard: bool = False
) -> DataFrame:
    """One raw table. Rows that do not fit the schema fail the read."""
    df = (
        spark.read.schema(SCHEMAS[table])
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)  # the header must match the schema
        .csv(path)
    )
    return standardise(df) if standard else df


def read_csv_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        **{t: read_csv(spark, t, f"{folder}/{name}") for t, name in FILES.items()}
    )


def read_parquet_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(
        **{t: spark.read.schema(s).parquet(f"{folder}/{t}") for t, s in SCHEMAS.items()}
    )


def standardise(df: DataFrame) -> DataFrame:
    """Rename raw columns to their standard names."""
    return df.withColumnsRenamed(STANDARD_NAMES)
