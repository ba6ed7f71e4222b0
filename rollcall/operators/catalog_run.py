"""A run over a catalog of sessions that can be broken off and taken up again.

The catalog is taken in its order, cut to a number of sessions, begun at a session and freed of the sessions whose results are already
there. What is left is worked through in batches. A batch's results are committed as one folder; a run that is taken up again skips
the folders that were committed and works through the rest, so it ends with what an unbroken run gives.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions import text as tx

#: Confidence and label of a frame with and without indicators.
STRONG, WEAK = (0.9, "voting_results_only"), (0.3, "general_text")


def tally_in_text(text: Column) -> Column:
    """Ayes and noes that a frame's text tells ('yea | 7', 'ayes: 5'); null where it tells neither."""
    number = lambda words: F.regexp_extract(F.lower(text), rf"\b(?:{words})\b[^0-9a-z]*([0-9]+)", 1)
    ayes, noes = (F.nullif(number(w), F.lit("")).cast("int") for w in ("yea|yeas|aye|ayes", "nay|nays|no|noes"))
    return F.when(ayes.isNotNull() | noes.isNotNull(), F.struct(ayes.alias("ayes"), noes.alias("noes")))


@dataclass(frozen=True)
class Run:
    sink: str
    max_sessions: int | None = None
    resume_from: str | None = None
    threshold: float = 0.7
    batch: int = 100
    extract: Callable[[Column], Column] = tally_in_text

    def __post_init__(self):
        if (self.max_sessions or 0) < 0 or self.batch < 1:
            raise ValueError("max_sessions is not negative, batch is positive")


def selected(catalog: DataFrame, max_sessions: int | None = None, resume_from: str | None = None) -> DataFrame:
    """session_id and place of the catalog (session_id, place): the first max_sessions in order, of those from resume_from on;
    a session that is not among them resumes from the first."""
    rows = catalog.select("session_id", "place")
    if max_sessions:
        rows = rows.orderBy("place").limit(max_sessions)
    if resume_from is None:
        return rows
    start = rows.agg(F.min(F.when(F.col("session_id") == resume_from, F.col("place"))).alias("_start"))
    return rows.join(F.broadcast(start), F.coalesce(F.col("place") >= F.col("_start"), F.lit(True))).drop("_start")  # one row


def candidates(frames: DataFrame) -> DataFrame:
    """frames (session_id, frame_number, raw_text) with has_indicators, confidence and detection_method."""
    flag = tx.contains_any(F.lower(F.coalesce("raw_text", F.lit(""))), tx.INDICATORS)
    pick = lambda k: F.when(F.col("has_indicators"), F.lit(STRONG[k])).otherwise(F.lit(WEAK[k]))
    return frames.withColumn("has_indicators", flag).withColumns({"confidence": pick(0), "detection_method": pick(1)})


def extracted(found: DataFrame, threshold: float, extract: Callable[[Column], Column] = tally_in_text) -> DataFrame:
    """Ballots told by candidates over the threshold."""
    return found.where(F.col("confidence") > threshold).withColumn("tally", extract(F.col("raw_text"))).where("tally is not null")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or ())


RESULT = "session_id string, place long, frames long, candidates long, flagged long, ballots long"


def results(spark: SparkSession, sink: str) -> DataFrame:
    """Counters of the sessions whose batches are committed."""
    there = _exists(spark, f"{sink}/batch=*/_SUCCESS")
    return spark.read.schema(RESULT).json(f"{sink}/batch=*") if there else spark.createDataFrame([], RESULT)


def run(catalog: DataFrame, frames: DataFrame, config: Run) -> DataFrame:
    """Works through what is left and gives the results of all sessions of the sink. A session without frames has zeros."""
    spark = catalog.sparkSession
    todo = selected(catalog, config.max_sessions, config.resume_from)
    # the catalog has a row a session, so one order over it is small beside the frames
    numbered = todo.withColumn("batch", F.floor((F.row_number().over(Window.orderBy("place")) - 1) / config.batch).cast("int"))
    for k in sorted(r.batch for r in numbered.select("batch").distinct().collect()):
        path = f"{config.sink}/batch={config.resume_from or ''}-{config.max_sessions or ''}-{k:06d}"
        if _exists(spark, f"{path}/_SUCCESS"):
            continue
        part = numbered.where(F.col("batch") == k).join(results(spark, config.sink).select("session_id"), "session_id", "left_anti").select("session_id", "place")
        found = candidates(frames.join(F.broadcast(part.select("session_id")), "session_id", "left_semi"))  # at most config.batch rows
        ballots = extracted(found, config.threshold, config.extract).groupBy("session_id").agg(F.count(F.lit(1)).alias("ballots"))
        counts = found.groupBy("session_id").agg(F.count(F.lit(1)).alias("frames"), F.count("raw_text").alias("candidates"), F.count_if("has_indicators").alias("flagged"))
        rows = part.join(counts, "session_id", "left").join(ballots, "session_id", "left").fillna(0)
        rows.write.mode("overwrite").json(path)
    return results(spark, config.sink)


def summary(done: DataFrame) -> DataFrame:
    """One row: sessions, completed (with a ballot), sums, and the last session by place."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("frames", "candidates", "ballots")]
    return done.agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("ballots") > 0).alias("completed"), *sums, F.max_by("session_id", "place").alias("current"))


def session_status(done: DataFrame) -> DataFrame:
    return done.select("session_id", F.when(F.col("ballots") > 0, "completed").otherwise("failed").alias("status"), "frames", "candidates", "ballots")
