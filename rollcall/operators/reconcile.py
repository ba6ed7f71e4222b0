"""Tallies, outcomes, inferred choices and validation. Whatever is inferred is flagged as such."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outcome(ayes: Column, noes: Column) -> Column:
    return F.when(ayes > noes, "Passes").when(ayes < noes, "Fails").otherwise("Tie")


def seat_choice(seat: Column, ayes: Column, noes: Column, abstentions: Column) -> Column:
    """The choice of a seat (from 0) when only a tally is known: ayes sit first, then noes, then abstentions."""
    return F.when(seat < ayes, "YES").when(seat < ayes + noes, "NO").when(seat < ayes + noes + abstentions, "ABSTAIN")


def choice_by_outcome(result: Column) -> Column:
    t = F.lower(F.coalesce(result, F.lit("")))
    has = lambda *words: F.greatest(*[F.contains(t, F.lit(w)).cast("int") for w in words]) == 1
    return F.when(has("pass", "adopt", "approve"), "YES").when(has("fail", "deny", "reject"), "NO").otherwise("YES")


def issues(**rules: Column) -> Column:
    """Names of the rules whose condition holds, as an array."""
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]), lambda x: x.isNotNull())


def upsert(own: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """own with the rows of new: those with a known key replace it, others are added."""
    return own.join(new.select(key), key, "left_anti").unionByName(new)


def fill_summaries(df: DataFrame, text: Column) -> DataFrame:
    """A summary only where there is none."""
    return df.withColumn("summary", F.when(F.coalesce("summary", F.lit("")) == "", text).otherwise(F.col("summary")))


def move_summaries(df: DataFrame, key: str, summary: str, start: str, to: Column) -> DataFrame:
    """Summaries that begin with start go to the row with the key to, and leave their own row without one."""
    away = F.coalesce(F.startswith(summary, F.lit(start)), F.lit(False))
    moved = df.where(away).select(to.alias(key), F.col(summary).alias("_moved"))
    out = df.join(moved, key, "left").withColumn(summary, F.coalesce("_moved", F.when(~away, F.col(summary))))
    return out.select(*df.columns)


def drawn(result: Column, row: Column, seed: int) -> Column:
    """A drawn choice of a member who mostly abstains: on a pass ABSTAIN with 0.7, else YES; on a fail NO with 0.3, else ABSTAIN;
    otherwise ABSTAIN. The draw follows from a digest of row and seed, so it is the same each time and everywhere. Nothing calls
    this unless asked to; what it gives is imputed."""
    digest = F.md5(F.concat_ws("|", row.cast("string"), F.lit(str(seed))))
    p = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(1 << 32)
    has = lambda w: F.contains(F.lower(F.coalesce(result, F.lit(""))), F.lit(w))
    return F.when(has("pass"), F.when(p < 0.7, "ABSTAIN").otherwise("YES")).when(has("fail"), F.when(p < 0.3, "NO").otherwise("ABSTAIN")).otherwise("ABSTAIN")
