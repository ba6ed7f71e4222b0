"""The query API over silver frames: ballots, sessions and members. Every function gives a DataFrame and runs nothing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import text as tx
from rollcall.functions import times as tm
from rollcall.operators import choices as ch

#: Columns of the CSV export.
CSV_HEADERS = ("Meeting ID", "Meeting Date", "Meeting Time", "Agenda Item", "Vote Result", "Ayes", "Noes", "Abstentions", "Recused", "Video Timestamp", "Video URL", "Agenda URL", "Meta ID", "Frame Number", "Timestamp Estimated")


def outcome_has(word: str) -> Column:
    return F.contains(F.lower(F.coalesce("outcome", F.lit(""))), F.lit(word))


def outcome_filter(result: str | None) -> Column | None:
    """'passed' and 'failed' are filters, anything else is none."""
    return {"passed": outcome_has("pass"), "failed": outcome_has("fail")}.get((result or "").lower())


def member_filter(term: str) -> Column:
    """Whether a key of the choice map holds the term, in any case."""
    return F.coalesce(F.exists(F.map_keys("choices"), lambda k: F.contains(F.lower(k), F.lit(term.lower()))), F.lit(False))


@dataclass(frozen=True)
class BallotQuery:
    member: str | None = None
    session_id: str | None = None
    item: str | None = None
    result: str | None = None
    date_from: str | None = None
    date_to: str | None = None
    limit: int | None = None
    offset: int | None = None
    text: str | None = None  # in the item or in the motion

    def __post_init__(self):
        if (self.limit or 0) < 0 or (self.offset or 0) < 0:
            raise ValueError("limit and offset are not negative")


def page(df: DataFrame, order: list[str], offset: int | None, limit: int | None) -> DataFrame:
    """Offset, then limit, over a total order; None and 0 are not applied."""
    if not offset and not limit:
        return df
    out = df.orderBy(*order)
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit else out


def ballots(df: DataFrame, q: BallotQuery, sessions: DataFrame | None = None) -> DataFrame:
    """Ballots that meet every filter given. Cheap filters come first and reach the scan."""
    conditions = [
        (F.col("session_id") == q.session_id) if q.session_id else None,
        outcome_filter(q.result),
        F.coalesce(F.contains(F.lower("item_text"), F.lit(q.item.lower())), F.lit(False)) if q.item else None,
        member_filter(q.member) if q.member else None,
    ]
    for c in conditions:
        df = df if c is None else df.where(c)
    df = search(df, q.text) if q.text else df
    if (q.date_from or q.date_to) and sessions is not None:
        held = sessions.where(F.col("date").between(q.date_from or "0000", q.date_to or "9999")).select("session_id")
        df = df.join(held, "session_id", "left_semi")
    return page(df, ["session_id", "in_ord"], q.offset, q.limit)


def search(df: DataFrame, term: str, fields: tuple[str, ...] = ("item_text", "motion_text")) -> DataFrame:
    """Ballots one of whose fields holds the term, in any case; each field is looked at by itself."""
    if not term or not fields:
        raise ValueError("a search needs a term and a field")
    hits = [F.coalesce(F.contains(F.lower(F.col(f).cast("string")), F.lit(term.lower())), F.lit(False)) for f in fields]
    return df.where(reduce(lambda a, b: a | b, hits))


def member_record(df: DataFrame, member: str) -> DataFrame:
    """The flattened ballots of a member: ballot, session, item, choice and outcome."""
    each = df.where(member_filter(member)).select("ballot_id", "session_id", "in_ord", "item_text", F.explode("choices").alias("member", "choice"), "outcome", "video_ts")
    return each.where(F.contains(F.lower("member"), F.lit(member.lower())))


def member_summary(df: DataFrame, member: str) -> DataFrame:
    """One row: total, passed, failed and abstentions of a member; zeros if there is none."""
    mine = df.where(member_filter(member)).agg(F.count(F.lit(1)).alias("total"), F.count_if(outcome_has("pass")).alias("passed"), F.count_if(outcome_has("fail")).alias("failed"))
    away = member_record(df, member).agg(F.count_if(F.lower("choice").isin("abstain", "abstention")).alias("abstentions"))
    return mine.crossJoin(away).select(F.lit(member).alias("member"), "total", "passed", "failed", "abstentions")  # two single rows


def session_summary(df: DataFrame, session_id: str) -> DataFrame:
    """A row an item: total, passed, and failed as all that did not pass; no item is 'Unknown'."""
    item = F.coalesce(F.nullif("item_text", F.lit("")), F.lit("Unknown"))
    return df.where(F.col("session_id") == session_id).groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("total"), F.count_if(outcome_has("pass")).alias("passed"), F.count_if(~outcome_has("pass")).alias("failed"))


def statistics(df: DataFrame) -> DataFrame:
    """One row: totals, outcomes and completeness as percent texts."""
    counted = df.agg(
        F.count(F.lit(1)).alias("ballots"), F.countDistinct("session_id").alias("sessions"), F.count_if(outcome_has("pass")).alias("passed"), F.count_if(outcome_has("fail")).alias("failed"),
        F.count_if(F.coalesce(F.size("choices"), F.lit(0)) > 0).alias("c"), F.count_if(F.col("item_text").isNotNull() & (F.col("item_text") != "") & ~F.contains("item_text", F.lit("Not available"))).alias("i"),
    )
    share = lambda c: tx.percent(F.col(c), F.col("ballots"))
    return counted.select("ballots", "sessions", "passed", "failed", share("passed").alias("pass_rate"), share("c").alias("with_choices"), share("i").alias("with_item"))


def members(df: DataFrame) -> DataFrame:
    return df.select(F.explode(F.map_keys("choices")).alias("member")).distinct()


def roster(df: DataFrame) -> DataFrame:
    """The members in order of their names."""
    return members(df).orderBy("member")


def member_stats(df: DataFrame, roster: DataFrame | None = None) -> DataFrame:
    """member, total, yes, no, abstain; with a roster its members only, absent ones with zeros."""
    each = df.select(F.explode("choices").alias("member", "c")).groupBy("member")
    stats = each.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.upper("c") == v).alias(x) for x, v in (("yes", "YES"), ("no", "NO"), ("abstain", "ABSTAIN"))])
    return stats if roster is None else roster.select("member").distinct().join(stats, "member", "left").fillna(0)


def items(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce(F.length("item_text"), F.lit(0)) > 0).select("item_text").distinct()


def ballot(df: DataFrame, ballot_id: str) -> DataFrame:
    """The first ballot with this id, or no row."""
    return df.where(F.col("ballot_id") == ballot_id).orderBy("session_id", "in_ord").limit(1)


def home(df: DataFrame, sessions: DataFrame, recent: int = 3) -> DataFrame:
    """The latest sessions with the number of all ballots, sessions and members beside them."""
    last = sessions.orderBy(F.col("date").desc(), F.col("session_id").desc()).limit(recent).select("session_id", "date")
    totals = df.agg(F.count(F.lit(1)).alias("ballots"))
    return last.crossJoin(totals).crossJoin(sessions.agg(F.count(F.lit(1)).alias("sessions"))).crossJoin(members(df).agg(F.count(F.lit(1)).alias("members")))  # single rows


def session_detail(df: DataFrame, session_id: str, summaries: DataFrame) -> DataFrame:
    """The session's ballots in order of their frames (none is 0), with running time and the session's summary."""
    own = df.where(F.col("session_id") == session_id).join(summaries, "session_id", "left")
    return own.withColumn("clock", tm.clock(tm.by_frame(F.col("video_ts"), F.col("frame_number")))).orderBy(F.coalesce("frame_number", F.lit(0)), "in_ord")


def year_page(df: DataFrame, sessions: DataFrame, year: int) -> DataFrame:
    """Sessions of a year that have ballots."""
    held = sessions.where(F.col("date").between(f"{year}-01-01", f"{year}-12-31"))
    return held.join(df.select("session_id"), "session_id", "left_semi")


def csv_rows(df: DataFrame, sessions: DataFrame) -> DataFrame:
    """session_id, in_ord and line: the fifteen fields of the CSV export; the item alone is quoted."""
    rows = df.join(sessions.select("session_id", "date", "time", "video_url", "agenda_url"), "session_id", "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    truthy = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(0)).cast("string"), F.lit(""))
    tally = [number(f"tally.{c}") for c in ("ayes", "noes", "abstentions")]
    fields = [text("session_id"), text("date"), text("time"), tx.csv_quote(text("item_text")), text("outcome"), *tally, number("recused"), truthy("video_ts"), text("video_url"), text("agenda_url"), text("marker_id"), truthy("frame_number"), F.when(F.col("ts_estimated"), "Yes").otherwise("No")]
    return rows.select("session_id", "in_ord", F.concat_ws(",", *fields).alias("line"))


def json_rows(df: DataFrame) -> DataFrame:
    """session_id, in_ord and doc: each ballot as one JSON object of the export."""
    fields = [F.col("session_id").alias("meeting_id"), F.col("item_text").alias("agenda_item"), F.col("outcome").alias("result"), F.col("tally").alias("vote_tally"), F.col("choices").alias("individual_votes"), F.col("video_ts").alias("video_timestamp"), F.col("marker_id").alias("meta_id"), "frame_number", F.col("ts_estimated").alias("timestamp_estimated")]
    return df.select("session_id", "in_ord", F.to_json(F.struct(*fields)).alias("doc"))


def session_reports(df: DataFrame, sessions: DataFrame) -> DataFrame:
    """session_id and report: opening, outcomes, up to five topics, up to three notable actions and the most active member.

    Topics are ranked by number and then by first appearance; a session moves as one row a topic, action or member."""
    # a ballot gives a row for its topic (0), one if it is notable (1) and one for each member (2); all are counted by one pass
    fact = lambda kind, at, text: F.struct(F.lit(kind).alias("kind"), at.cast("bigint").alias("at"), text.alias("text"))
    no, action = F.lit(None), tx.notable(F.col("item_text"), F.col("outcome"))
    members = F.transform(F.coalesce(F.map_keys("choices"), F.array()), lambda m: fact(2, no, m))
    told = F.filter(F.array(fact(0, no, tx.topic(F.col("item_text"))), fact(1, F.col("in_ord"), action)), lambda x: x["text"].isNotNull())
    each = df.select("session_id", "in_ord", outcome_has("pass").alias("p"), outcome_has("fail").alias("f"), F.explode(F.concat(told, members)).alias("x"))
    facts = each.groupBy("session_id", "x").agg(F.count(F.lit(1)).alias("k"), F.min("in_ord").alias("o"), F.count_if("p").alias("p"), F.count_if("f").alias("f"))
    of = lambda kind, x: F.when(F.col("x.kind") == kind, x)
    ranked, said = F.struct((-F.col("k")).alias("k"), "o", F.col("x.text").alias("text")), F.struct(F.col("x.at").alias("at"), F.col("x.text").alias("text"))
    rows = facts.groupBy("session_id").agg(
        *[F.sum(of(0, F.col(c))).alias(n) for c, n in (("k", "n"), ("p", "p"), ("f", "f"))], F.sort_array(F.collect_list(of(0, ranked))).alias("t"), F.sort_array(F.collect_list(of(1, said))).alias("a"), F.min(of(2, ranked)).alias("m")
    )
    topics = F.transform(F.slice("t", 1, 5), lambda x: F.concat(x["text"], F.lit(" ("), (-x["k"]).cast("string"), F.lit(" items)")))
    actions = F.transform(F.slice("a", 1, 3), lambda x: x["text"])
    rows = rows.select("session_id", "n", "p", "f", F.array_join(topics, ", ").alias("topics"), F.array_join(actions, "; ").alias("actions"), "m")
    rows = sessions.select("session_id", "date").join(rows, "session_id", "left")
    parts = [
        F.concat(F.lit("The council convened on "), F.coalesce("date", F.lit("Unknown date")), F.lit(" for a regular meeting.")),
        F.when(F.col("n") > 0, F.concat(F.lit("The council conducted "), F.col("n").cast("string"), F.lit(" votes, with "), F.col("p").cast("string"), F.lit(" motions passing and "), F.col("f").cast("string"), F.lit(" motions failing."))),
        F.when(F.col("topics") != "", F.concat(F.lit("Key agenda topics included: "), "topics", F.lit("."))),
        F.when(F.col("actions") != "", F.concat(F.lit("Notable actions included: "), "actions", F.lit("."))),
        F.when(F.col("m").isNotNull(), F.concat(F.lit("All councilmembers participated actively, with "), "m.text", F.lit(" voting on "), (-F.col("m.k")).cast("string"), F.lit(" items."))),
        F.lit("The meeting concluded with standard adjournment procedures."),
    ]
    return rows.select("session_id", F.concat_ws(" ", *parts).alias("report"))
