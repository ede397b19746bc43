"""Shared helpers: tables, written intermediate results, batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gearlog.sources.shared import shared_path

#: Texts handed to numpy together: about this many bytes.
SLICE_BYTES = 1 << 19
#: Narrow rows (a few numbers) that one task writes.
ROWS_PER_TASK = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written tables of one run, in the folder that all executors share.

    A written table cuts the lineage: losing an executor costs the running tasks
    only. ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.count = spark, shared_path(spark, name), 0

    def write(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Write and read back. ``rows``, where a bound is known, sets how many tasks
        and files a table of narrow rows is worth."""
        self.count += 1
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
        path = f"{self.base}/{self.count}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            jvm = self.spark._jvm
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches of (key columns, text last) so that a piece holds about
    ``size`` bytes of text, or one long text."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)
