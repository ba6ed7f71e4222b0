"""A table that batches are merged into: one row a key, the one with the greatest order, whatever is replayed.

Rows lie in buckets by the hash of their keys. Batch n reads the buckets that its own keys fall into as they were before n, keeps the
best row of each key and writes those buckets anew under v=n; a manifest then names the version of every bucket. A batch that
runs twice, or that broke off before its manifest, starts from the same versions and writes the same again. Readers follow the last
manifest, so they never see half a batch. Versions that neither the last nor the last but one names are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class MergedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str, buckets: int = 32):
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path.rstrip("/"), keys, order, buckets
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self.hadoop.Path(folder)
        return [x.getPath().getName() for x in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def _numbers(self) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in self._names(f"{self.path}/manifest") if x[:1].isdigit())

    def _manifest(self, number: int | None) -> dict:
        if number is None:
            return {"schema": None, "buckets": {}}
        text = self.spark.read.text(f"{self.path}/manifest/{number:012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, number: int, content: dict) -> None:
        done, open_ = (self.hadoop.Path(f"{self.path}/manifest/{x}") for x in (f"{number:012d}.json", f"_{number:012d}"))
        out = self.fs.create(open_, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        self.fs.delete(done, False)
        self.fs.rename(open_, done)

    def _read(self, manifest: dict, only: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/v={v}/_b={b}" for b, v in manifest["buckets"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, number: int) -> None:
        """Merges a batch; its number grows from batch to batch, and a repeated batch has the number it had."""
        before = next((k for k in reversed(self._numbers()) if k < number), None)
        base = self._manifest(before)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        batch = batch.persist()
        try:
            touched = sorted(r[0] for r in batch.select(bucket).distinct().collect())  # at most as many as there are buckets
            if not touched:
                return
            rows = batch.withColumn("_new", F.lit(1))
            if base["schema"]:
                rows = rows.unionByName(self._read(base, touched).withColumn("_new", F.lit(0)), allowMissingColumns=True)
            columns = [c for c in rows.columns if c != "_new"]
            first = Window.partitionBy(*self.keys).orderBy(F.desc_nulls_last(self.order), F.desc("_new"), F.desc("_tie"))
            best = rows.withColumn("_tie", F.xxhash64(F.to_json(F.struct(*columns)))).withColumn("_rn", F.row_number().over(first)).where("_rn = 1")
            best = best.select(*columns, bucket.alias("_b"))
            best.write.mode("overwrite").partitionBy("_b").parquet(f"{self.path}/v={number}")
            schema = json.loads(best.drop("_b").schema.json())
        finally:
            batch.unpersist()
        self._commit(number, {"schema": schema, "buckets": base["buckets"] | {str(b): number for b in touched}})
        self._clean(number)

    def _clean(self, number: int) -> None:
        kept = [k for k in self._numbers() if k <= number][-2:]
        named = {v for k in kept for v in self._manifest(k)["buckets"].values()}
        for name in self._names(self.path):
            if name.startswith("v=") and int(name[2:]) < kept[0] and int(name[2:]) not in named:
                self.fs.delete(self.hadoop.Path(f"{self.path}/{name}"), True)
        for k in self._numbers():
            if k < kept[0]:
                self.fs.delete(self.hadoop.Path(f"{self.path}/manifest/{k:012d}.json"), False)

    def read(self) -> DataFrame | None:
        """One row a key; None before the first batch."""
        last = next(reversed(self._numbers()), None)
        return None if last is None else self._read(self._manifest(last))

    def follow(self, stream: DataFrame, checkpoint: str) -> None:
        """Merges what a stream has, batch by batch."""
        query = stream.writeStream.foreachBatch(lambda batch, number: self.merge(batch, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
