"""Keep-best policies, merges and the two order-dependent folds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_best(df: DataFrame, keys: list[str], score: Column, tiebreak: list[str]) -> DataFrame:
    """The row of each key with the highest score, ties to the first by tiebreak."""
    w = Window.partitionBy(*keys).orderBy(score.desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def carry_longest(df: DataFrame, keys: list[str], text: str, score: Column, tiebreak: list[str]) -> DataFrame:
    """keep_best whose text is the longest of its group. The best row comes from a ranking that tasks cut before the shuffle, the
    longest text from an aggregation of narrow rows, so neither moves a hot group whole.

    Tiebreak columns are numbers; the first in their order wins."""
    first = [-F.col(c) for c in tiebreak]
    longest = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max_by(text, F.struct(F.length(text), *first)).alias("_t"))
    best = keep_best(df, keys, score, tiebreak)
    met = best.join(longest, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]))
    return met.withColumn(text, F.col("_t")).select(*df.columns)


def drop_obvious(df: DataFrame, keys: list[str], obvious: Column) -> DataFrame:
    """Drops obvious rows of groups in which another row remains."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_o", obvious).withColumn("_left", F.sum((~F.col("_o")).cast("int")).over(w)).where("not _o or _left = 0").drop("_o", "_left")


def adjacent_fold(df: DataFrame, keys: list[str], at: str, score: str, order: str, gap: int, gone: str | None = None) -> DataFrame:
    """Of consecutive rows at most gap apart, the lower score goes unless one of the two went before (ties keep the earlier).
    gone: a column that marks rows as gone from the start; they take part in the scan and are dropped.

    No fold is needed: whether a row goes when its pair is looked at depends on the row before alone, which must not have
    gone. So in a stretch of rows that would each lose against the one before, every other one goes, counted from the
    stretch's first; what a row does to the one before it is then known too. One window order gives all of it."""
    w = Window.partitionBy(*keys).orderBy(at, order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = F.col(gone) if gone else F.lit(False)
    row = df.withColumn("_k", F.row_number().over(w)).withColumn("_out", out).withColumn("_pair", ~F.col("_out") & ~F.lag("_out", 1, True).over(w) & (F.col(at) - F.lag(at).over(w) <= gap))
    row = row.withColumn("_pair", F.coalesce("_pair", F.lit(False))).withColumn("_less", F.coalesce(F.lag(score).over(w) < F.col(score), F.lit(False)))
    row = row.withColumn("_last", F.max(F.when(~(F.col("_pair") & ~F.col("_less")), F.col("_k"))).over(so_far))
    row = row.withColumn("_goes", F.col("_out") | ((F.col("_k") - F.col("_last")) % 2 == 1))
    row = row.withColumn("_beats", F.col("_pair") & F.col("_less") & ~F.lag("_goes", 1, True).over(w))
    row = row.withColumn("_beaten", F.lead("_beats", 1, False).over(w))
    return row.where("not _goes and not _beaten").select(*df.columns)
