"""Counters kept beside the ballots: changed by what was added or taken away, without a second look at the rest; and mergeable
sketches of distinct members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers: a relative error of about 1.04 / sqrt(2^12) = 1.6 per cent.
SKETCH_BITS = 12


def session_delta(changes: DataFrame, sign: str = "sign") -> DataFrame:
    """session_id and what changes its total, passed and failed: pass counts first, fail only otherwise. Rows added have sign 1,
    rows taken away -1; a ballot that changes is both."""
    said = lambda w: F.contains(F.lower(F.coalesce("outcome", F.lit(""))), F.lit(w))
    of = {"total": F.lit(True), "passed": said("pass"), "failed": ~said("pass") & said("fail")}
    sums = [F.sum(F.when(c, F.col(sign)).otherwise(0)).cast("long").alias(name) for name, c in of.items()]
    return changes.where("session_id is not null").groupBy("session_id").agg(*sums)


def member_delta(changes: DataFrame, sign: str = "sign") -> DataFrame:
    """member and what changes its total, yes, no and abstain."""
    each = changes.select(F.explode("choices").alias("member", "choice"), F.col(sign).alias("_s"))
    of = {"total": F.lit(True), "yes": F.upper("choice") == "YES", "no": F.upper("choice") == "NO", "abstain": F.upper("choice") == "ABSTAIN"}
    return each.groupBy("member").agg(*[F.sum(F.when(c, F.col("_s")).otherwise(0)).cast("long").alias(n) for n, c in of.items()])


def applied(stored: DataFrame, delta: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """key and measures after the change; keys that come to a total of 0 go. Only keys in delta change."""
    d = delta.select(F.col(key).alias("_k"), *[F.col(m).alias(f"_{m}") for m in measures])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    both = stored.select(key, *measures).join(d, F.col(key) == F.col("_k"), "full")
    out = both.select(F.coalesce(key, "_k").alias(key), *[(zero(m) + zero(f"_{m}")).cast("long").alias(m) for m in measures])
    return out.where(F.col(measures[0]) != 0)


def refreshed(stored: DataFrame, counts: DataFrame, key: str = "session_id") -> DataFrame:
    """Stored counters of sessions beside a full count: where the totals differ all three are rewritten, elsewhere none is, even if
    passed or failed differ. `changed` says which. Sessions without ballots count 0; only stored sessions are given."""
    new = counts.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in ("total", "passed", "failed")])
    rows = stored.join(new, F.col(key) == F.col("_k"), "left")
    differs = F.coalesce("total", F.lit(0)) != F.coalesce("_total", F.lit(0))
    now = {c: F.when(differs, F.coalesce(f"_{c}", F.lit(0))).otherwise(F.col(c)).cast("long") for c in ("total", "passed", "failed")}
    return rows.withColumn("changed", differs).withColumns(now).select(*stored.columns, "changed")


def sketches(df: DataFrame, keys: list[str], value: str | Column) -> DataFrame:
    """keys and sketch: the distinct values of each group, mergeable later without the rows."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch"))


def rolled_up(kept: DataFrame, *keys: str) -> DataFrame:
    """keys and the estimated number of distinct values of all groups that fall under them; without keys, of all."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("members")
    return kept.groupBy(*keys).agg(union) if keys else kept.agg(union)
