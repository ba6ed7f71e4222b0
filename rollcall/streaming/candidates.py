"""Incremental forms over file streams: idempotent ingest and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import MergedTable


def stream(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """A file stream over Parquet that is already there or still comes."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def distinct_within(df: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Rows of a key once, as long as a copy comes within the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed(df: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    return df.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))


def drain(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Runs what is there to its end into Parquet."""
    query = df.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def upsert(df: DataFrame, out: str, checkpoint: str, keys: list[str], order: str) -> None:
    """Merges a stream into the table at out: of each key the row with the greatest order stays, inside a batch and across
    batches; running it again, or files that repeat rows, change nothing."""
    MergedTable(df.sparkSession, out, keys, order).follow(df, checkpoint)


def latest(spark: SparkSession, out: str, keys: list[str], order: str) -> DataFrame:
    """Of each key the row with the greatest order."""
    return MergedTable(spark, out, keys, order).read()
