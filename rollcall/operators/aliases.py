"""Aliases of members, followed to their end and applied to every section of a document.

An alias table names for an alias a target, which may be an alias again. Of several targets the one with the least priority counts (then
the first by name). Chains are followed by pointer jumping: each round doubles the length of the paths that are known, so a
chain of n names takes log2(n) rounds of one self-join. The names of a circle stand for the first of them by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import let
from rollcall.shared import Written

#: Aliases that go to all tasks at most.
FEW = 100


def closure(aliases: DataFrame) -> DataFrame:
    """alias and canonical of an alias table (alias, target, priority). Null names and names that stand for themselves only are no
    aliases."""
    written = Written(aliases.sparkSession)
    rows = aliases.where("alias is not null and target is not null and alias <> target")
    one = rows.groupBy("alias").agg(F.min(F.struct("priority", "target"))["target"].alias("to"))
    # low: the first name on the path, the alias and what follows it, without the end
    paths = written.table(one.select("alias", "to", F.col("alias").alias("low"), F.lit(True).alias("open")), "aliases")
    # a path is open as long as its end may be an alias; rounds stop when none is, and circles at the length of the longest path
    for _ in range(paths.count().bit_length()):
        step = paths.select(F.col("alias").alias("_a"), F.col("to").alias("_to"), F.col("low").alias("_low"), F.col("open").alias("_open"))
        moved = paths.where("open").join(step.hint("merge"), F.col("to") == F.col("_a"), "left")
        moved = moved.select("alias", F.coalesce("_to", "to").alias("to"), F.least("low", F.coalesce("_low", "low")).alias("low"), F.coalesce("_open", F.lit(False)).alias("open"))
        longer = written.table(moved.union(paths.where("not open")), "aliases")
        written.drop(paths)
        paths = longer
        if paths.where("open").isEmpty():
            return paths.select("alias", F.col("to").alias("canonical"))
    ends = paths.where("open").select(F.col("alias").alias("_a"), F.col("low").alias("_circle"))  # an end that is an alias lies on a circle
    return paths.join(ends.hint("merge"), F.col("to") == F.col("_a"), "left").select("alias", F.coalesce("_circle", "to").alias("canonical")).where("alias <> canonical")


def _named(df: DataFrame, member: str, names: DataFrame) -> DataFrame:
    """df with _name and _moved: the canonical name, and whether it is another one."""
    side = names.select(F.col("alias").alias("_alias"), "canonical")
    return df.join(side, F.col(member) == F.col("_alias"), "left").withColumns({"_name": F.coalesce("canonical", member), "_moved": F.col("canonical").isNotNull()}).drop("_alias", "canonical")


def _renamed_by(choices: Column, known: Column) -> Column:
    """choices under the names of a map of aliases; maps without an alias stay as they are."""

    def under(known: Column) -> Column:
        entries = F.transform(F.map_entries(choices), lambda e: F.struct(F.coalesce(F.try_element_at(known, e["key"]), e["key"]).alias("name"), F.struct(F.map_contains_key(known, e["key"]).alias("moved"), e["key"].alias("m")).alias("at"), e["value"].alias("value")))
        best = lambda all: F.filter(all, lambda e: ~F.exists(all, lambda x: (x["name"] == e["name"]) & (x["at"] > e["at"])))
        return let(entries, lambda all: F.map_from_entries(F.sort_array(F.transform(best(all), lambda e: F.struct(e["name"], e["value"])))))

    return F.when(F.exists(F.map_keys(choices), lambda k: F.map_contains_key(known, k)), under(known)).otherwise(choices)


def ballots_renamed(ballots: DataFrame, names: DataFrame, key: list[str]) -> DataFrame:
    """Ballots with members renamed. Where several entries come to one name, a renamed one wins, of those the last by name. key:
    columns that name a ballot, not null. Up to FEW names go to all tasks as one map and ballots stay where they are."""
    few = names.limit(FEW + 1).count() <= FEW
    if few:
        known = names.agg(F.map_from_entries(F.collect_list(F.struct("alias", "canonical"))).alias("_known"))
        wide = ballots.crossJoin(F.broadcast(known))  # one row
        return wide.withColumn("choices", _renamed_by(F.col("choices"), F.col("_known"))).select(*ballots.columns)
    each = _named(ballots.select(*key, F.explode("choices").alias("_m", "_c")), "_m", names)
    touched = each.where("_moved").select(*key).distinct()
    new = each.join(touched, key, "left_semi").groupBy(*key, "_name").agg(F.max_by("_c", F.struct("_moved", "_m")).alias("_c"))
    maps = new.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_name", "_c")))).alias("_new"))
    return ballots.join(maps, key, "left").withColumn("choices", F.coalesce("_new", "choices")).select(*ballots.columns)


def roster_renamed(roster: DataFrame, names: DataFrame) -> DataFrame:
    """member: every canonical name once."""
    return _named(roster.select("member"), "member", names).select(F.col("_name").alias("member")).distinct()


def stats_renamed(stats: DataFrame, names: DataFrame) -> DataFrame:
    """Counters of members, those of one name added up."""
    measures = [c for c in stats.columns if c != "member"]
    return _named(stats, "member", names).groupBy(F.col("_name").alias("member")).agg(*[F.sum(m).alias(m) for m in measures])


def summaries_renamed(summaries: DataFrame, names: DataFrame) -> DataFrame:
    """member and summary: a member's own summary, if it has one, else the first by name of its aliases'."""
    rows = _named(summaries, "member", names).where("coalesce(summary, '') <> ''")
    return rows.groupBy(F.col("_name").alias("member")).agg(F.min_by("summary", F.struct("_moved", "member")).alias("summary"))
