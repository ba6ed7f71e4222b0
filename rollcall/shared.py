"""The folder that driver and executors share, and tables written into it to cut long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only where that is unset, one of our own (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"rollcall-{uuid.uuid4().hex}"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


class Written:
    """Tables of one computation in the shared folder; drop() deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            _, path = self.paths.pop(id(t), (None, None))
            if path:
                where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(hadoop).delete(where, True)
