"""Operators on choice maps, tallies and session counters. Whatever is inferred is flagged as imputed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import text as tx

from .reconcile import choice_by_outcome, outcome

#: Tokens that count in a tally (upper case), one set a policy.
FILLED = (("YES", "Y", "AYE"), ("NO", "N", "NAY"), ("ABSTAIN", "ABSTENTION"))
LISTED = (("YES", "AYE"), ("NO", "NAY"), ("ABSTAIN", "ABSTENTION"))
EXACT = (("YES",), ("NO",), ("ABSTAIN",))
#: Outcomes of a filled tally.
FILLED_OUTCOMES = ("Motion Passes", "Motion Fails", "Tie")


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys in which null equals null; the keys come from left."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def last_choices(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """keys and choices: the maps of a group merged in order, a later ballot's entry winning. Members are reduced first,
    so a group moves as one row a member and not as one a ballot."""
    each = df.select(*keys, *order, F.explode("choices").alias("member", "choice"))
    last = each.groupBy(*keys, "member").agg(F.max_by("choice", F.struct(*order)).alias("choice"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("member", "choice")))).alias("choices"))


def default_id(keys: list[str]) -> Column:
    """The id of a ballot without one: session and item joined by '_', None for a missing part."""
    return F.concat_ws("_", *[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys])


def merge_ballots(df: DataFrame, keys: list[str]) -> DataFrame:
    """One ballot a group: id, frame, marker and time of the ballot with the least frame (a missing one is 0; first place on
    ties), choices merged in place order, the merged ids in place order.

    A ballot gives a row for itself, without a member, and one for each member; these are reduced by member and then by group, so no
    join brings choices and ballots together again."""
    named = df.withColumns({"_id": F.coalesce("ballot_id", default_id(keys)), "_frame": F.coalesce("frame_number", F.lit(0))})
    own = F.array(F.struct(F.lit(None).cast("string").alias("member"), F.lit(None).cast("string").alias("choice")))
    entries = F.transform(F.coalesce(F.map_entries("choices"), F.array()), lambda e: F.struct(e["key"].alias("member"), e["value"].alias("choice")))
    each = named.select(*keys, "in_ord", "_id", "_frame", "marker_id", "video_ts", "ts_estimated", F.explode(F.concat(own, entries)).alias("_e"))
    is_own = F.col("_member").isNull()
    each = each.select(*keys, "in_ord", F.col("_e.member").alias("_member"), F.col("_e.choice").alias("choice"), F.when(F.col("_e.member").isNull(), F.struct("_frame", "in_ord", "_id", "marker_id", "video_ts", "ts_estimated")).alias("_own"))
    ids = F.transform(F.array_sort(F.collect_list(F.when(is_own, F.struct("in_ord", "_own._id")))), lambda x: x["_id"])
    first = F.min_by("_own", F.when(is_own, F.struct("_own._frame", "in_ord")))
    members = each.groupBy(*keys, "_member").agg(first.alias("_p"), ids.alias("_ids"), F.max_by("choice", "in_ord").alias("choice"))
    only = lambda c: F.max_by(c, F.when(is_own, 1))
    entry = F.when(~is_own, F.struct(F.col("_member").alias("member"), "choice"))
    rows = members.groupBy(*keys).agg(only("_p").alias("p"), only("_ids").alias("consolidated_from"), F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("choices"))
    return rows.select(
        *keys, F.col("p._id").alias("ballot_id"), F.col("p._frame").alias("frame_number"), "choices", "p.marker_id", "p.video_ts",
        F.coalesce("p.ts_estimated", F.lit(True)).alias("ts_estimated"), "consolidated_from",
    )


def tally_of(choices: Column, tokens: tuple = FILLED) -> Column:
    """Ayes, noes and abstentions of a choice map, by a policy's tokens."""
    count = lambda of: F.size(F.filter(F.map_values(choices), lambda v: F.upper(v).isin(*of)))
    return F.struct(*[F.coalesce(count(of), F.lit(0)).alias(c) for c, of in zip(("ayes", "noes", "abstentions"), tokens, strict=True)])


def merge_listed(df: DataFrame, keys: list[str]) -> DataFrame:
    """One ballot a group. A single ballot stays as it is. Of several the first is the base: the least frame and time that
    are not 0 and the first marker that is not empty replace its own, and where any has choices, all of them are counted
    anew and give tally and outcome. ts_estimated says whether the time is missing."""
    has = F.coalesce(F.size("choices"), F.lit(-1)) > 0
    t = tally_of(F.col("choices"), LISTED)
    rows = df.withColumn("_t", F.when(has, t))
    base = F.min_by(F.struct("ballot_id", "outcome", "tally", "frame_number", "video_ts", "marker_id"), "in_ord")
    marker = F.min_by("marker_id", F.when(F.coalesce(F.length("marker_id"), F.lit(0)) > 0, F.col("in_ord")))
    sums = [F.sum(f"_t.{c}").cast("int").alias(c) for c in ("ayes", "noes", "abstentions")]
    least = [F.min(F.nullif(c, F.lit(0))).alias(f"_{c}") for c in ("frame_number", "video_ts")]
    out = rows.groupBy(*keys).agg(base.alias("b"), marker.alias("_marker"), *sums, *least, F.count(F.lit(1)).alias("merged"))
    counted = (F.col("merged") > 1) & F.col("ayes").isNotNull()
    several = lambda new, old: F.when(F.col("merged") > 1, F.coalesce(new, old)).otherwise(F.col(old))
    tally = {c: F.when(counted, F.col(c)).otherwise(F.col(f"b.tally.{c}")) for c in ("ayes", "noes", "abstentions")}
    named = {"ballot_id": F.col("b.ballot_id"), "frame_number": several("_frame_number", "b.frame_number"), "video_ts": several("_video_ts", "b.video_ts"), "marker_id": several("_marker", "b.marker_id")}
    result = F.when(counted, outcome(F.col("ayes"), F.col("noes"))).otherwise(F.col("b.outcome"))
    out = out.select(*keys, "merged", result.alias("outcome"), *[e.alias(c) for c, e in (named | tally).items()])
    return out.withColumn("ts_estimated", F.col("video_ts").isNull())


def fill_tally(df: DataFrame) -> DataFrame:
    """Tally and outcome from choices where the tally is missing and there are choices."""
    missing = F.col("tally").isNull() & (F.coalesce(F.size("choices"), F.lit(0)) > 0)
    filled = df.withColumns({"tally_filled": missing, "_t": tally_of(F.col("choices"), FILLED)})
    passes, fails, tie = FILLED_OUTCOMES
    said = F.when(F.col("_t.ayes") > F.col("_t.noes"), passes).when(F.col("_t.ayes") < F.col("_t.noes"), fails).otherwise(tie)
    to = {"outcome": said, "tally": F.col("_t")}
    return filled.withColumns({c: F.when(F.col("tally_filled"), x).otherwise(F.col(c)) for c, x in to.items()}).drop("_t")


def by_majority(choices: Column, result: Column) -> Column:
    """YES on a pass, NO on a fail; on a tie what more members said, NO on equal numbers; else YES."""
    said = lambda word: F.contains(F.lower(F.coalesce(result, F.lit(""))), F.lit(word))
    count = lambda token: F.coalesce(F.size(F.filter(F.map_values(choices), lambda v: v == token)), F.lit(0))
    tie = F.when(count("YES") > count("NO"), "YES").otherwise("NO")
    return F.when(said("pass"), "YES").when(said("fail"), "NO").when(said("tie"), tie).otherwise("YES")


def impute_member(df: DataFrame, member: str, policy: str = "outcome", recount: bool = False) -> DataFrame:
    """Adds member's choice where the map lacks it; `imputed` names the member. Other rows stay as they are.

    'outcome': by the outcome's words, and the stored tally, where there is one, gets one more. 'majority': by_majority(); the
    tally stays, unless recount counts it anew from every ballot's choices, the added one among them."""
    if policy not in ("outcome", "majority"):
        raise ValueError("policy is outcome or majority")
    lacks = ~F.coalesce(F.map_contains_key("choices", F.lit(member)), F.lit(False))
    said = choice_by_outcome(F.col("outcome")) if policy == "outcome" else by_majority(F.col("choices"), F.col("outcome"))
    old = F.coalesce(F.col("choices"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    out = df.withColumns({"_lacks": lacks, "_said": said})
    none = F.array().cast("array<string>")
    more = {"choices": F.when(F.col("_lacks"), F.map_concat(old, F.create_map(F.lit(member), "_said"))).otherwise(F.col("choices")), "imputed": F.when(F.col("_lacks"), F.array(F.lit(member))).otherwise(none)}
    if policy == "outcome":
        field = lambda c, token: F.coalesce(F.col(f"tally.{c}"), F.lit(0)) + F.when(F.col("_said") == token, 1).otherwise(0)
        bumped = F.col("tally").withField("ayes", field("ayes", "YES")).withField("noes", field("noes", "NO"))
        more["tally"] = F.when(F.col("_lacks") & F.col("tally").isNotNull(), bumped).otherwise(F.col("tally"))
    out = out.withColumns(more).drop("_lacks", "_said")
    return out.withColumn("tally", tally_of(F.col("choices"), EXACT)) if recount else out


def correct_choice(df: DataFrame, member: str, new: str, where: Column) -> DataFrame:
    """Turns an abstention of member into new and moves one abstention of the tally over, never below 0."""
    hit = where & (F.col("choices")[member] == "ABSTAIN")
    field = {"YES": "ayes", "NO": "noes"}[new]
    t = F.col("tally").withField(field, F.col(f"tally.{field}") + 1).withField("abstentions", F.greatest(F.lit(0), F.col("tally.abstentions") - 1))
    moved = F.transform_values("choices", lambda k, v: F.when(k == member, F.lit(new)).otherwise(v))
    return df.withColumn("tally", F.when(hit, t).otherwise(F.col("tally"))).withColumn("choices", F.when(hit, moved).otherwise(F.col("choices")))


def _winners(entries: Column, beats) -> Column:
    """The map of entries (name, at, value): of each name the entry that no other of that name beats. The entries are worked out once."""
    best = lambda all: F.filter(all, lambda e: ~F.exists(all, lambda x: (x["name"] == e["name"]) & beats(x, e)))
    return tx.let(entries, lambda all: F.map_from_entries(F.transform(best(all), lambda e: F.struct(e["name"], e["value"]))))


def whitelisted(choices: Column, members: list[str]) -> Column:
    """The members that are known, in upper case; choices other than YES, NO and ABSTAIN abstain; the last entry of a name wins."""
    said = lambda v: F.when(F.upper(v).isin("YES", "NO", "ABSTAIN"), F.upper(v)).otherwise("ABSTAIN")
    entries = F.transform(F.map_entries(choices), lambda e, i: F.struct(F.upper(e["key"]).alias("name"), i.alias("at"), said(e["value"]).alias("value")))
    return _winners(F.filter(entries, lambda e: e["name"].isin(*[m.upper() for m in members])), lambda x, e: x["at"] > e["at"])


def renamed(choices: Column, alias: dict[str, str]) -> Column:
    """Members renamed; where the target is there already, the renamed entry wins, as the source overwrites it."""
    to = lambda k: F.coalesce(*[F.when(k == a, F.lit(b)) for a, b in alias.items()], k)
    rank = lambda e, i: F.struct((to(e["key"]) != e["key"]).alias("moved"), i.alias("i"))
    entries = F.transform(F.map_entries(choices), lambda e, i: F.struct(to(e["key"]).alias("name"), rank(e, i).alias("at"), e["value"].alias("value")))
    return _winners(entries, lambda x, e: x["at"] > e["at"])


def merged(a: Column, b: Column) -> Column:
    """Both maps; entries of b win."""
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)


def entries_text(choices: Column) -> Column:
    return F.array_join(F.sort_array(F.transform(F.map_entries(choices), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")


def participation(df: DataFrame) -> DataFrame:
    """session_id, member, n: ballots that a member took part in."""
    return df.select("session_id", F.explode(F.map_keys("choices")).alias("member")).groupBy("session_id", "member").agg(F.count(F.lit(1)).alias("n"))


def recurring(df: DataFrame) -> DataFrame:
    """session_id and n of sessions with recurring items."""
    return df.where(tx.contains_any(F.lower("item_text"), tx.RECURRING)).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))


def set_default(df: DataFrame, dimension: DataFrame, key: str, column: str, only_present: bool = True) -> DataFrame:
    """column from a dimension (key, column): only rows that it has are changed, or missing values take it as default."""
    side = dimension.select(key, F.col(column).alias("_v"))
    new = F.coalesce(F.col("_v"), F.col(column)) if only_present else F.coalesce(F.col(column), F.col("_v"))
    return df.join(side, key, "left").withColumn(column, new).drop("_v")


def issues_of_ballots(df: DataFrame) -> DataFrame:
    """Issue texts of ballots: fields that are required and missing."""
    wanted = F.array(*[F.when(F.col(c).isNull(), F.concat(F.lit("Vote "), F.col("place").cast("string"), F.lit(f": Missing required field '{name}'"))) for c, name in (("session_id", "meeting_id"), ("item_text", "agenda_item"))])
    return df.select(F.explode(F.filter(wanted, lambda x: x.isNotNull())).alias("issue"))


def issues_of_sessions(df: DataFrame) -> DataFrame:
    wanted = F.array(*[F.when(F.col(c).isNull(), F.concat(F.lit("Meeting "), "session_id", F.lit(f": Missing required field '{c}'"))) for c in ("title", "date")])
    return df.select(F.explode(F.filter(wanted, lambda x: x.isNotNull())).alias("issue"))


def is_valid(ballots: DataFrame) -> DataFrame:
    """One row, valid: whether every ballot has its session and item."""
    return ballots.agg((F.count_if(F.col("session_id").isNull() | F.col("item_text").isNull()) == 0).alias("valid"))


def session_counters(df: DataFrame) -> DataFrame:
    """session_id, total, passed, failed and the first three items. A ballot passes if more members said YES than NO, and fails
    otherwise, on a tie too. Only the first three rows of a session are gathered, so a large session stays small."""
    t = tally_of(F.col("choices"), EXACT)
    rows = df.withColumn("_p", t["ayes"] > t["noes"])
    counts = rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("total"), F.count_if("_p").alias("passed"))
    first = Window.partitionBy("session_id").orderBy("in_ord")
    three = df.select("session_id", "in_ord", "item_text").withColumn("_n", F.row_number().over(first)).where("_n <= 3")
    items = three.groupBy("session_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "item_text"))), lambda x: x["item_text"]).alias("key_items"))
    return same_keys(counts, items, ["session_id"], "left").withColumn("failed", F.col("total") - F.col("passed"))


def counters_text(session: Column, total: Column, passed: Column) -> Column:
    """Fixed wording of a session's summary."""
    text = lambda c: c.cast("string")
    parts = ["City Council meeting ", text(session), " with ", text(total), " votes recorded. ", text(passed), " votes passed, ", text(total - passed), " failed."]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
