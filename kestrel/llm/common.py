"""Helpers shared by the corpus operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kestrel.session import ship_package

#: Rows and bytes of one Arrow batch: a batch of very long texts stays small.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def limit_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers receive, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches, in workers that have this package."""
    limit_batches(df.sparkSession)
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def byte_texts(batch: pa.RecordBatch, name: str) -> list:
    """The column's texts as UTF-8 bytes, None for null."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def strings(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


class BoundedCache(dict):
    """A worker's memo of ``make(key)``; emptied when it holds ``limit`` keys, so
    its memory has a bound whatever the corpus. Long keys are not kept."""

    def __init__(self, make, limit: int, max_key: int = 64):
        super().__init__()
        self.make, self.limit, self.max_key = make, limit, max_key

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.max_key:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value
