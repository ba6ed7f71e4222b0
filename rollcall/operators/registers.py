"""Small parts of the record keeping as library functions: lists of addresses and members, projections and counts by rule, stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import text as tx

#: Answers of the subscription list.
SUBSCRIBED, KNOWN = "Successfully subscribed", "Email already subscribed"
UNSUBSCRIBED, UNKNOWN = "Successfully unsubscribed", "Email not found in subscriptions"


def valid_email(x: Column) -> Column:
    """Something, an @, something, a dot, something; no white space of any kind and no second @."""
    return F.coalesce(F.rlike(x, F.lit(r"(?U)^[^\s@]+@[^\s@]+\.[^\s@]+$")), F.lit(False))


def subscribe(emails: DataFrame, email: str) -> tuple[DataFrame, DataFrame]:
    """The list (email) with an address it does not hold yet, and one row: success and message."""
    spark, new = emails.sparkSession, emails.sparkSession.createDataFrame([(email,)], "email string")
    added = new.join(emails, "email", "left_anti")
    status = spark.range(1).select(F.lit(email).alias("email")).join(emails.where(F.col("email") == email).limit(1).withColumn("_known", F.lit(True)), "email", "left")
    known = F.coalesce("_known", F.lit(False))
    return emails.union(added), status.select((~known).alias("success"), F.when(known, KNOWN).otherwise(SUBSCRIBED).alias("message"))


def unsubscribe(emails: DataFrame, email: str) -> tuple[DataFrame, DataFrame]:
    """The list without an address, and one row: success and message."""
    found = emails.agg((F.count_if(F.col("email") == email) > 0).alias("success"))
    return emails.where(~F.col("email").eqNullSafe(F.lit(email))), found.withColumn("message", F.when(F.col("success"), UNSUBSCRIBED).otherwise(UNKNOWN))


def append_members(roster: DataFrame, *names: str) -> DataFrame:
    """The roster (member, ord) with names that it lacks at its end, in the order given."""
    spark = roster.sparkSession
    new = spark.createDataFrame([(n, k) for k, n in enumerate(dict.fromkeys(names))], "member string, _k long").join(roster.select("member"), "member", "left_anti")
    end = roster.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("_end"))
    return roster.select("member", "ord").union(new.join(F.broadcast(end)).select("member", (F.col("_end") + 1 + F.col("_k")).cast("long")))  # one row


def rows_of_lists(df: DataFrame, lists: str, key: str, value: str) -> DataFrame:
    """A row for each element of each list of a map of lists; the map's key becomes a column. Other columns stay."""
    rest = [c for c in df.columns if c != lists]
    return df.select(*rest, F.explode(lists).alias(key, "_list")).select(*rest, key, F.explode("_list").alias(value))


def envelope(page: DataFrame, filters: dict[str, str | None], limit: int) -> DataFrame:
    """One row: success, data (at most limit rows, in their order), count and filters, as the answer of an endpoint."""
    rows = page.limit(limit).agg(F.collect_list(F.struct(*page.columns)).alias("data"))
    given = F.create_map(*[x for k, v in filters.items() for x in (F.lit(k), F.lit(v).cast("string"))]) if filters else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return rows.select(F.lit(True).alias("success"), "data", F.size("data").alias("count"), given.alias("filters"))


def health(ballots: DataFrame, sessions: DataFrame, updated: str) -> DataFrame:
    """One row: status, totals and when the data were made."""
    counts = ballots.agg(F.count(F.lit(1)).alias("total_ballots")).crossJoin(sessions.agg(F.countDistinct("session_id").alias("total_sessions")))  # single rows
    return counts.select(F.lit("healthy").alias("status"), "total_ballots", "total_sessions", F.lit(updated).alias("last_updated"))


def member_detail(ballots: DataFrame, roster: DataFrame, stats: DataFrame, slug: str) -> tuple[DataFrame, DataFrame]:
    """The member whose name has this slug, with its counters (0 without any), and its ballots. An unknown slug has no rows."""
    named = roster.where(F.regexp_replace(F.lower("member"), r"\s+", "_") == slug).select("member")
    card = named.join(stats.select("member", "total", "yes", "no"), "member", "left").fillna(0)
    own = ballots.select("*", F.explode("choices").alias("member", "choice")).join(F.broadcast(named.limit(1)), "member", "left_semi")
    return card.withColumn("id", F.lit(slug)), own


def exclusive_counts(df: DataFrame, *keys: str) -> DataFrame:
    """keys, total, passed and failed, where a ballot that passes is not looked at for failing."""
    said = lambda w: F.contains(F.lower(F.coalesce("outcome", F.lit(""))), F.lit(w))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(said("pass")).alias("passed"), F.count_if(~said("pass") & said("fail")).alias("failed"))


def names_any(member: Column, *tokens: str) -> Column:
    """Whether a name holds one of the tokens, in any case."""
    return tx.contains_any(F.upper(F.coalesce(member, F.lit(""))), [t.upper() for t in tokens])


def alias_totals(df: DataFrame, *tokens: str) -> DataFrame:
    """One row: total, yes, no and abstain over all members whose name holds a token."""
    own = df.select(F.explode("choices").alias("member", "choice")).where(names_any(F.col("member"), *tokens))
    return own.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.upper("choice") == v).alias(n) for n, v in (("yes", "YES"), ("no", "NO"), ("abstain", "ABSTAIN"))])


def to_look_at_again(member: str) -> Column:
    """Ballots on which the member abstained and whose frame is there to be read again."""
    return F.coalesce((F.col("choices")[member] == "ABSTAIN") & F.col("frame_available") & (F.coalesce("frame_path", F.lit("")) != ""), F.lit(False))


def parsed_choices(text: Column, members: list[str]) -> Column:
    """Choices out of an answer that may stand in a fence: known members only, and what is not YES, NO or ABSTAIN abstains; null
    where the text holds no object."""
    from .choices import whitelisted

    held = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    parsed = F.from_json(held, "map<string,string>")
    return F.when(parsed.isNotNull(), whitelisted(parsed, members))


def linked(text: Column) -> Column:
    """Bare addresses as links."""
    return F.regexp_replace(text, r"(https?://[^\s]+)", '<a href="$1" target="_blank" class="link-style">$1</a>')


def made_up_frames_by_share(catalog: DataFrame, per_session: int = 100) -> DataFrame:
    """clip_id and frame_number: per_session frames for each votable chapter, numbered through from 0."""
    n = F.coalesce("votable_chapters", F.lit(0)) * per_session
    return catalog.where(n > 0).select("clip_id", F.explode(F.sequence(F.lit(0), n - 1)).alias("frame_number"))


def stamps(at: datetime) -> tuple[str, str]:
    """A run's stamps: ISO for documents, compact for names of versions. One run takes one time, so all it writes agrees."""
    return at.isoformat(), at.strftime("%Y%m%d_%H%M%S")


#: Items that are a code only, and what they stand for.
SHORT_CODES = (
    ("5A", "5A. Recognition and Proclamations"),
    ("5.A", "5A. Recognition and Proclamations"),
    ("9A", "9A. Public Hearings"),
    ("10B", "10B. Finance"),
    ("14", "14. Adjournment"),
)


def expanded(item: Column, codes: tuple[tuple[str, str], ...] = SHORT_CODES) -> Column:
    """An item that is a known code as a whole, written out; others as they are."""
    known = F.create_map(*[F.lit(x) for pair in codes for x in pair])
    return F.coalesce(F.element_at(known, item), item)


def frame_path(path: Column, session: Column, frame: Column, root: str) -> Column:
    """The path of a frame: the one that is there, else one made of session and frame; none without a frame."""
    made = F.concat(F.lit(f"{root}/votable_frames_"), session, F.lit("/frame_"), F.format_string("%06d", frame), F.lit(".jpg"))
    return F.when(F.coalesce(path, F.lit("")) != "", path).when(frame.isNotNull(), made).otherwise(path)


def match_rate(df: DataFrame, marker: str = "marker_id") -> DataFrame:
    """One row: matched, total and rate as a percent text; 0% where there are no rows."""
    counts = df.agg(F.count_if(F.coalesce(F.col(marker), F.lit("")) != "").alias("matched"), F.count(F.lit(1)).alias("total"))
    return counts.withColumn("rate", tx.percent(F.col("matched"), F.col("total")))


def likely_session(session: Column, prefix: str, below: int) -> Column:
    """Whether an id begins so and is a number under a bound."""
    number = F.when(F.rlike(session, F.lit("^[0-9]{1,18}$")), session.cast("long"))
    return F.coalesce(F.startswith(session, F.lit(prefix)) & (number < below), F.lit(False))


def added_members(stats: DataFrame, *members: str) -> DataFrame:
    """Counters with zeros for members that have none yet; those that are there keep theirs."""
    measures = [c for c in stats.columns if c != "member"]
    new = stats.sparkSession.createDataFrame([(m,) for m in dict.fromkeys(members)], "member string").join(stats.select("member"), "member", "left_anti")
    return stats.unionByName(new.select("member", *[F.lit(0).cast(stats.schema[c].dataType).alias(c) for c in measures]))


def audit(ballots: DataFrame, member: str, first: int = 10) -> DataFrame:
    """The first ballots, in order, that lack a member's choice, with the number of all such ballots beside each."""
    lacks = ~F.coalesce(F.map_contains_key("choices", F.lit(member)), F.lit(False))
    missing = ballots.where(lacks)
    n = missing.agg(F.count(F.lit(1)).alias("n_missing"))
    return missing.orderBy("session_id", "in_ord").limit(first).select("session_id", "in_ord", "item_text").crossJoin(n)  # one row beside ten
