"""What the operators of this folder share: tables, the shared folder, Arrow text access, digests."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch are cut so that one slice holds at most this many text bytes (or one row).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; only where that is unset, one of our own (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"rollcall-{uuid.uuid4().hex}"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage: Spark then removes the shuffle files that no live plan refers to.
    A plan counts as live until the action after its own has run."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of one operator in the shared folder, deleted once no later step reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, what: str, compression: str | None = None) -> DataFrame:
        path = fresh_path(self.spark, what)
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table, path in [x for x in self.paths if any(x[0] is t for t in tables)]:
            delete(self.spark, path)
            self.paths = [x for x in self.paths if x[0] is not table]

    def drop_all_but(self, *tables: DataFrame) -> None:
        self.drop(*[table for table, _ in self.paths if not any(table is t for t in tables)])


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, wherever Spark's paths lead."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Arrow batches of few rows for what is executed inside, where rows carry whole sets or texts twice."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def byte_rows(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, null as None."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded text size, so memory follows the longest row and not the row count."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        total, begin = column.nbytes, 0
        step = max(1, int(batch.num_rows * size / max(total, 1)))
        while begin < batch.num_rows:
            yield batch.slice(begin, step)
            begin += step


def list_array(rows: list, kind: pa.DataType) -> pa.Array:
    """A list column of numbers from sequences, without a Python object for each number."""
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate([np.asarray(x, np.int64) for x in rows]) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind, safe=False))
