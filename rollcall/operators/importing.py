"""The import of new meetings as a whole: ballots are consolidated, placed in the video, dated and joined to what is there, and the
members' statistics are worked out again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import times as tm

from . import choices as ch

BALLOT = ("ballot_id", "session_id", "item_text", "frame_number", "choices", "marker_id", "video_ts", "ts_estimated", "consolidated_from")


@dataclass(frozen=True)
class Imported:
    ballots: DataFrame
    sessions: DataFrame
    member_stats: DataFrame
    session_summaries: DataFrame


def placed(ballots: DataFrame, sessions: DataFrame, matched: DataFrame | None = None) -> DataFrame:
    """Ballots with a marker stay. Others, of sessions that are imported, take the marker, seconds and flag that were matched for them
    (session_id, ballot_id, marker_id, seconds, estimated; a row a ballot), or else a marker of session and frame and a time
    estimated from the item."""
    known = sessions.select(F.col("session_id").alias("_s")).distinct().withColumn("_known", F.lit(True))
    out = ballots.join(known, F.col("session_id") == F.col("_s"), "left")
    found = {"_m": F.lit(None).cast("string"), "_t": F.lit(None).cast("long"), "_e": F.lit(None).cast("boolean")}
    if matched is None:
        out = out.withColumns(found)
    else:
        side = matched.select(F.col("session_id").alias("_ms"), F.col("ballot_id").alias("_mb"), F.col("marker_id").alias("_m"), F.col("seconds").cast("long").alias("_t"), F.col("estimated").alias("_e"))
        out = out.join(side, (F.col("session_id") == F.col("_ms")) & (F.col("ballot_id") == F.col("_mb")), "left").drop("_ms", "_mb")
    needs = (F.coalesce("marker_id", F.lit("")) == "") & F.coalesce("_known", F.lit(False))
    frame = F.coalesce("frame_number", F.lit(0))
    made = F.concat("session_id", F.lpad(frame.cast("string"), 4, "0"))
    made = F.when(F.length(frame.cast("string")) > 4, F.concat("session_id", frame.cast("string"))).otherwise(made)
    estimate = tm.by_content(F.nullif("item_text", F.lit("")), frame).cast("long")
    new = {
        "marker_id": F.when(needs, F.coalesce("_m", made)).otherwise(F.col("marker_id")),
        "video_ts": F.when(needs, F.when(F.col("_m").isNotNull(), F.col("_t")).otherwise(estimate)).otherwise(F.col("video_ts").cast("long")),
        "ts_estimated": F.when(needs, F.when(F.col("_m").isNotNull(), F.col("_e")).otherwise(True)).otherwise(F.col("ts_estimated")),
    }
    return out.withColumns(new).drop("_s", "_known", "_m", "_t", "_e")


def consolidated(new: DataFrame) -> DataFrame:
    return ch.merge_ballots(new.where("session_id is not null"), ["session_id", "item_text"])


def new_ballots(new: DataFrame, sessions: DataFrame, matched: DataFrame | None = None) -> DataFrame:
    return placed(consolidated(new), sessions, matched).select(*BALLOT)


def merged_sessions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both, a new session replacing one of its id; new sessions without a date are dated from their id."""
    dated = new.withColumn("date", tm.date_or_estimate(F.col("date"), F.col("session_id")))
    return existing.join(new.select("session_id"), "session_id", "left_anti").select(*new.columns).unionByName(dated)


def member_stats(ballots: DataFrame) -> DataFrame:
    """member, total, yes, no and abstain; another choice counts in the total only."""
    said = F.upper("choice")
    each = ballots.select(F.explode("choices").alias("member", "choice"))
    counts = [F.count_if(said == token).alias(name) for name, token in (("yes", "YES"), ("no", "NO"), ("abstain", "ABSTAIN"))]
    return each.groupBy("member").agg(F.count(F.lit(1)).alias("total"), *counts)


def run_import(new: DataFrame, new_sessions: DataFrame, existing: DataFrame, existing_sessions: DataFrame, matched: DataFrame | None = None) -> Imported:
    """The imported document. Ballots are a plain union: an id may stand on both sides. Summaries are of the new sessions."""
    added = new_ballots(new, new_sessions, matched)
    ballots = existing.select(*[c for c in BALLOT if c in existing.columns]).unionByName(added, allowMissingColumns=True)
    counted = ch.session_counters(added.withColumn("in_ord", F.struct("frame_number", "ballot_id")))
    zero = {"total": F.coalesce("total", F.lit(0)), "passed": F.coalesce("passed", F.lit(0)), "failed": F.coalesce("failed", F.lit(0))}
    summaries = new_sessions.select("session_id").distinct().join(counted, "session_id", "left").withColumns(zero)
    summaries = summaries.withColumn("summary", ch.counters_text(F.col("session_id"), F.col("total"), F.col("passed")))
    # placing keeps every ballot and its choices, so the statistics do without it
    chosen = existing.select("choices").union(consolidated(new).select("choices"))
    return Imported(ballots, merged_sessions(existing_sessions, new_sessions), member_stats(chosen), summaries)
