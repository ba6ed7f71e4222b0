"""Stateful forms over streams that give out everything once the input ends: windows, sessions, neighbour elimination.

A stream's watermark stays behind its last row, so what ends last would never come out. with_end() joins a second, tiny stream to the
input: when mark_end() has written its one row there, the next run from the same checkpoint moves the watermark past
everything, and whatever is still open is closed. After that mark every further row counts as late.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: The time of the mark, which no row reaches.
END = "9999-12-31 00:00:00"
#: Rows that are given out at once.
BATCH = 10_000
#: Groups that the buckets of a key are dealt into in turn, and, in place of a slot, the group where what is left of them meets.
SLOTS, CHAIN = 256, -1
ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def with_end(df: DataFrame, marks: str, at: str, late: str) -> DataFrame:
    """df with a watermark on `at` that a mark in the folder `marks` moves to the end. Rows without a time are left out."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(marks)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    ends = spark.readStream.schema(f"{at} timestamp").parquet(marks)
    # a condition on the time itself is not moved below the watermark, which so sees the mark
    return df.unionByName(ends, allowMissingColumns=True).withWatermark(at, late).where(F.col(at) < F.lit(END).cast("timestamp"))


def mark_end(spark: SparkSession, marks: str, at: str) -> None:
    spark.range(1).select(F.lit(END).cast("timestamp").alias(at)).coalesce(1).write.mode("overwrite").parquet(marks)


def windowed(df: DataFrame, at: str, width: str, *keys: str) -> DataFrame:
    """start and n of fixed windows of a stream that has a watermark."""
    return df.groupBy(F.window(at, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sessions(df: DataFrame, at: str, gap: str, *keys: str) -> DataFrame:
    """keys, start, end and n of runs of rows less than gap apart; end is the last row's time plus gap."""
    runs = df.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return runs.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


@contextmanager
def rocks(spark: SparkSession):
    """The state store that keyed state with timers needs, for queries started inside. It sets no disk aside ahead, which for many
    small stores is most of what they take."""
    kept = {name: spark.conf.get(name, None) for name in ROCKS}
    for name, value in ROCKS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def bucket_us(gap_us: int) -> int:
    """Microseconds of a bucket of time: sixty gaps, a minute at least, whole milliseconds as timers are."""
    return -(-max(60 * gap_us, 60_000_000) // 1000) * 1000


class Neighbours(StatefulProcessor):
    """The greedy elimination of neighbouring rows of a key, in event time, for the key's buckets of time that share a slot.

    Rows wait in the state until the watermark has passed their bucket and are then taken in order, so the result does not depend
    on the order of arrival. A row goes if the one before it stays, is near and has no lower score; so fates alternate up to the
    next row that is far from the one before it or higher, which stays whatever was before. From the first such row on a bucket
    decides itself, but for its last row. What remains for Chain: the rows before it, of which every other one goes, and the last."""

    def __init__(self, gap_us: int):
        self.gap_us, self.width_us = gap_us, bucket_us(gap_us)

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, ord long, score double")

    def handleInputRows(self, key, rows, timerValues):
        first = last = None  # the earliest bucket, and its last row
        for pdf in rows:  # a batch at a time, so a large slot is never held as a whole here
            self.waiting.appendList(list(zip(pdf["us"].tolist(), pdf["ord"].tolist(), pdf["score"].tolist(), strict=True)))
            at = pdf["us"].to_numpy()
            begins = int(at.min()) // self.width_us
            if first is None or begins <= first:
                reach = int(at[at // self.width_us == begins].max())
                first, last = begins, reach if first is None or begins < first else max(last, reach)
        self._wake(last)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import numpy as np
        import pandas as pd

        passed, at = timerValues.getCurrentWatermarkInMs() * 1000, (expiredTimerInfo.getExpiryTimeInMs() - 1) * 1000
        end = at - at % self.width_us + self.width_us
        if passed < end:  # the bucket that the timer was set for is open
            self._wake(end - 1)
            return
        if not self.waiting.exists():
            return
        kind = np.dtype([("us", np.int64), ("ord", np.int64), ("score", np.float64)])  # 24 bytes a row
        rows = np.fromiter((tuple(r) for r in self.waiting.get()), kind)
        rows.sort(order=("us", "ord"))
        n_due = int(np.searchsorted(rows["us"], passed - passed % self.width_us))  # rows of buckets that are closed
        if not n_due:
            return
        later = rows[n_due:]
        self.waiting.clear()
        for start in range(0, len(later), BATCH):
            self.waiting.appendList(later[start : start + BATCH].tolist())
        if len(later):
            at = int(later["us"][0])
            self._wake(at - at % self.width_us + self.width_us - 1)
        cuts = np.flatnonzero(np.diff(rows["us"][:n_due] // self.width_us)) + 1
        sure, left = zip(*[self._decided(x) for x in np.split(rows[:n_due], cuts)], strict=True)
        left = pd.DataFrame(left, columns=["ords", "first", "first_score", "last", "last_ord", "last_score", "whole", "gone"])
        yield left.assign(key=key[0], part=CHAIN)
        sure = np.concatenate(sure)
        for start in range(0, len(sure), BATCH):
            some = left[:1].assign(key=key[0], part=key[1])
            some["ords"] = [sure[start : start + BATCH]]
            yield some

    def _decided(self, rows):
        """The rows of a bucket that stay for sure, and what remains: the rows before the first that does not depend on what was
        before the bucket, the bucket's first and last, whether there is no such row, and else whether the last one goes."""
        import numpy as np

        us, ords, score = rows["us"], rows["ord"], rows["score"]
        near, higher = np.diff(us) <= self.gap_us, score[:-1] < score[1:]
        starts = np.flatnonzero(~near | higher) + 1  # rows that stay whatever was before
        ends = us[0], score[0], us[-1], ords[-1], score[-1]
        if not len(starts):
            return ords[:0], (ords[:-1], *ends, True, False)
        lead, place = int(starts[0]), np.arange(starts[0], len(rows))
        gone = (place - starts[np.searchsorted(starts, place, "right") - 1]) % 2 == 1
        beaten = near & higher  # by the row after it
        sure = ords[lead:-1][~gone[:-1] & ~beaten[lead:]]
        return sure, (ords[: lead - int(beaten[lead - 1])], *ends, False, gone[-1])

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def close(self) -> None:
        pass


class Chain(StatefulProcessor):
    """The rows that stay, of what the buckets of Neighbours give out. Decided rows pass by slot; the rest of a key, one row a
    bucket, meets in order of time. All buckets that a watermark closes come in one run, so only the last row waits for its
    successor, or for the timer that fires when none can come within the gap."""

    def __init__(self, gap_us: int):
        self.gap_us, self.width_us = gap_us, bucket_us(gap_us)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long, ord long, score double")

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np
        import pandas as pd

        if key[1] != CHAIN:
            for pdf in rows:
                yield pd.DataFrame({"key": key[0], "ord": np.concatenate(pdf["ords"].tolist())})
            return
        last, out = tuple(self.last.get()) if self.last.exists() else None, []
        for r in pd.concat(list(rows)).sort_values("first").itertuples():
            goes = False
            if last is not None:
                close = r.first - last[0] <= self.gap_us
                beaten = close and last[2] < r.first_score
                goes = close and not beaten
                if not beaten:
                    out.append([last[1]])
            out.append(np.asarray(r.ords[int(goes) :: 2], np.int64))
            gone = (len(r.ords) + goes) % 2 == 1 if r.whole else r.gone
            last = None if gone else (r.last, r.last_ord, r.last_score)
        if last is None:
            self.last.clear()
        else:
            self.last.update(last)
            self.handle.registerTimer(self._free(last[0]))
        out = np.concatenate(out)
        for start in range(0, len(out), BATCH):
            yield pd.DataFrame({"key": key[0], "ord": out[start : start + BATCH]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        if self.last.exists():
            last = tuple(self.last.get())
            if timerValues.getCurrentWatermarkInMs() >= self._free(last[0]):
                self.last.clear()
                yield pd.DataFrame({"key": [key[0]], "ord": [last[1]]})

    def _free(self, us: int) -> int:
        """The watermark at which all buckets within the gap have come, those too that waited for the timer at their end."""
        reach = us + self.gap_us
        return (reach - reach % self.width_us + self.width_us) // 1000 + 2

    def close(self) -> None:
        pass


def neighbours(df: DataFrame, key: str, at: str, score: str, order: str, gap_seconds: float) -> DataFrame:
    """key and ord of the rows that stay, of a stream that has a watermark on `at`. Of consecutive rows of a key (by time, then
    order) at most gap apart the lower score goes, unless one of the two went before; ties keep the earlier. Late rows are
    dropped and counted (late_rows). Rows whose key, score or order is null are left out. The rows of a key meet by bucket of time
    (bucket_us) and come out once the watermark has passed it."""
    kind, gap_us = dict(df.dtypes)[key], int(gap_seconds * 1_000_000)
    width = bucket_us(gap_us)
    rows = df.select(F.col(key).alias("key"), F.col(at), F.unix_micros(at).alias("us"), F.col(score).cast("double").alias("score"), F.col(order).cast("long").alias("ord")).dropna()
    slots = rows.withColumn("part", F.expr(f"pmod((us - pmod(us, {width})) div {width}, {SLOTS})")).groupBy("key", "part")
    left = f"ords array<long>, first long, first_score double, last long, last_ord long, last_score double, whole boolean, gone boolean, key {kind}, part long"
    buckets = slots.transformWithStateInPandas(Neighbours(gap_us), left, "append", "EventTime")
    return buckets.groupBy("key", "part").transformWithStateInPandas(Chain(gap_us), f"key {kind}, ord long", "append", "EventTime")


def late_rows(query) -> int:
    """Rows that came after the watermark had passed them, over the progress that the query still holds."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def drain(df: DataFrame, out: str, checkpoint: str):
    """Runs what is there to its end into Parquet and gives the query."""
    query = df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
