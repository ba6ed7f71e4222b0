"""Scores of ballots and the keep-best policies on them.

A ballot has ballot_id, session_id, frame_number, item_text, outcome, tally (ayes, noes, abstentions), choices (a map),
frame_path, motion_text and in_ord, its place within the session. Ties go to the first in_ord.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.functions import text as tx

from .dedupe import adjacent_fold, keep_best

KEY = "_key"


def has(c: str) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False))


def points(cond: Column, n: int) -> Column:
    return F.when(cond, n).otherwise(0)


def says(word: str) -> Column:
    return F.contains(F.lower(F.coalesce("outcome", F.lit(""))), F.lit(word))


def n_choices() -> Column:
    return F.coalesce(F.size("choices"), F.lit(0))


def passing_score() -> Column:
    """An id, a passing outcome with ayes and many choices."""
    ayes = F.coalesce("tally.ayes", F.lit(0))
    by_outcome = F.when(says("pass"), 50).when(says("fail"), -50).otherwise(0)
    return points(has("ballot_id"), 100) + by_outcome - points(says("pass") & (ayes == 0), 30) + 2 * n_choices()


def complete_score() -> Column:
    """passing_score with a frame and a motion."""
    return passing_score() + points(has("frame_path"), 10) + points(has("motion_text"), 5)


def tallied_score(keys: int = 3) -> Column:
    """passing_score with the number of the tally's fields."""
    return passing_score() + points(F.col("tally").isNotNull(), keys)


def frame_score() -> Column:
    """An id, choices, a tally, a long item and a frame."""
    total = F.coalesce(F.col("tally.ayes") + F.col("tally.noes") + F.col("tally.abstentions"), F.lit(0))
    length = F.coalesce(F.length("item_text"), F.lit(0))
    return points(has("ballot_id"), 100) + 10 * n_choices() + points(total > 0, 1) * 5 * total + length + points(has("frame_path"), 20)


def whole_item_score() -> Column:
    """frame_score less 50 for a cut or short item."""
    return frame_score() - points(F.contains("item_text", F.lit("...")) | (F.length("item_text") < 20), 50)


def long_item_score() -> Column:
    """frame_score less 30 for a very short item."""
    return frame_score() - points(F.length("item_text") < 10, 30)


def by_item(ballots: DataFrame, item: Column | None = None, score: Column | None = None) -> DataFrame:
    """The best ballot of each session and item; item is the text itself unless a normaliser's column is given."""
    keyed = ballots.withColumn(KEY, F.col("item_text") if item is None else item)
    return keep_best(keyed, ["session_id", KEY], complete_score() if score is None else score, ["in_ord"]).drop(KEY)


def by_ultra_item(ballots: DataFrame) -> DataFrame:
    return keep_best(tx.with_ultra(ballots, "item_text", KEY), ["session_id", KEY], complete_score(), ["in_ord"]).drop(KEY)


def by_category(ballots: DataFrame) -> DataFrame:
    """The best ballot of each session and category, with the longest item of the group (the first of equal length).

    Both are picked by one aggregation, so groups are reduced before the shuffle."""
    keyed = tx.with_category(ballots, "item_text", KEY)
    score = tallied_score().alias("s")
    row = F.struct(*[F.col(c) for c in ballots.columns])
    longest = F.max_by("item_text", F.struct(F.coalesce(F.length("item_text"), F.lit(0)), -F.col("in_ord")))
    best = F.max_by(row, F.struct(score, -F.col("in_ord")))
    out = keyed.groupBy("session_id", KEY).agg(best.alias("b"), longest.alias("longest"))
    return out.select(*[F.col("longest").alias(c) if c == "item_text" else F.col(f"b.{c}").alias(c) for c in ballots.columns])


def by_first_id(ballots: DataFrame) -> DataFrame:
    """Of each session and item the first ballot with an id; without any, the one with most choices."""
    rank = F.when(has("ballot_id"), 1_000_000).otherwise(n_choices())
    return by_item(ballots, score=rank)


def by_frame(ballots: DataFrame, score: Column, item: Column | None = None) -> DataFrame:
    """The best ballot of each session and frame (and item, if given); ballots without a frame all stay."""
    framed = ballots.where("frame_number is not null")
    keys = ["session_id", "frame_number"]
    best = keep_best(framed, keys, score, ["in_ord"]) if item is None else keep_best(framed.withColumn(KEY, item), [*keys, KEY], score, ["in_ord"]).drop(KEY)
    return best.unionByName(ballots.where("frame_number is null"))


def longest_of_frame(ballots: DataFrame) -> DataFrame:
    return by_frame(ballots, F.coalesce(F.length("item_text"), F.lit(0)))


def by_frame_then_neighbours(ballots: DataFrame, gap: int = 2) -> DataFrame:
    """The best ballot of each frame by whole_item_score, then the greedy elimination of neighbouring frames.

    Ballots that the first pass dropped stay in the scan and shield their neighbours, as in the source."""
    scored = ballots.withColumn("_s", whole_item_score())
    framed = scored.where("frame_number is not null")
    first = keep_best(framed, ["session_id", "frame_number"], F.col("_s"), ["in_ord"])
    marked = framed.join(first.select("session_id", "in_ord", F.lit(False).alias("_gone")), ["session_id", "in_ord"], "left").fillna(True, ["_gone"])
    kept = adjacent_fold(marked, ["session_id"], "frame_number", "_s", "in_ord", gap, "_gone")
    return kept.drop("_s", "_gone").unionByName(scored.where("frame_number is null").drop("_s"))


def drop_second(ballots: DataFrame, session: str, part: str) -> DataFrame:
    """ballots less the second longest of those of one session whose item holds part."""
    target = (F.col("session_id") == session) & F.contains("item_text", F.lit(part))
    w = Window.partitionBy("session_id").orderBy(F.length("item_text").desc(), "in_ord")
    second = ballots.where(target).withColumn("_rn", F.row_number().over(w)).where("_rn = 2").select("session_id", "in_ord")
    return ballots.join(F.broadcast(second), ["session_id", "in_ord"], "left_anti")  # one row


def patch_first(ballots: DataFrame, match: Column, column: str, value: Column) -> DataFrame:
    """ballots with column set in the first matching row only."""
    first = ballots.where(match).orderBy("session_id", "in_ord").limit(1).select("session_id", "in_ord", F.lit(True).alias("_hit"))
    out = ballots.join(F.broadcast(first), ["session_id", "in_ord"], "left")
    return out.withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column))).drop("_hit").select(*ballots.columns)
