"""Queries of the meeting policies and of the query API, on ballots made from the driver's tables, each with its SQL.

A line item is a ballot of its order's session; item texts, outcomes, tallies, choices and markers follow from its keys,
so that both engines see the same meeting data.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall import api
from rollcall.functions import text as tx
from rollcall.functions import times as tm
from rollcall.operators import choices as ch
from rollcall.operators import linkage, policies

from .registry import count_if, n, query

HEADS = (
    "Consent Calendar", "ITEM  12 : Budget hearing", "No. 3 Adopt ordinance", "7A. Approve lease agreement for parks", "9A", "Oral Communications #2",
    "Adjournment", "b Administrative Matters", "Public Hearing of the Planning Commission", "Council Committee Meetings and Announcements", "Fire station contract and public safety", "Not visible in image",
)
TAILS = ("", " (For Adoption Only)", " Expenditure: $1,200.", "  (see  note)  ", " (For Discussion)", "...", " with the community services of a city")
MEMBERS = ("ada", "bo", "cy", "di", "ed")
PRESENT = [f"(l_suppkey + {k}) % 3 <> 0" for k in range(5)]
CHOICE = [f"CASE (l_partkey + {k}) % 4 WHEN 2 THEN 'NO' WHEN 3 THEN 'ABSTAIN' ELSE 'YES' END" for k in range(5)]
_case = lambda x, of: f"CASE {x} % {len(of)} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(of)) + " END"
COLUMNS = {
    "session_id": "CAST(l_orderkey AS STRING)",
    "frame_number": "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber * 2 AS INT) END",
    "item_text": f"CASE WHEN l_partkey % 13 = 5 THEN NULL ELSE concat({_case('l_partkey', HEADS)}, {_case('l_suppkey', TAILS)}) END",
    "outcome": "CASE l_returnflag WHEN 'R' THEN 'Motion Passes' WHEN 'A' THEN 'Motion Fails' ELSE CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'Tie' END END",
    "ballot_id": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) END",
    "frame_path": "CASE WHEN l_suppkey % 2 = 0 THEN concat('f/', CAST(l_linenumber AS STRING)) END",
    "motion_text": "CASE WHEN l_suppkey % 3 = 0 THEN 'Motion to Adopt' END",
    "marker_id": "CASE WHEN l_partkey % 9 = 0 THEN CAST(l_partkey AS STRING) WHEN l_partkey % 9 = 1 THEN '' END",
    "video_ts": "CASE WHEN l_partkey % 9 < 2 THEN CAST(l_partkey % 4 * 50 AS BIGINT) END",
    "ts_estimated": "l_suppkey % 4 = 0",
    "recused": "CAST(l_suppkey % 2 AS BIGINT)",
}
AYES, NOES, AWAY = "CAST(l_suppkey % 6 AS INT)", "CAST(l_partkey % 4 AS INT)", "CAST(l_linenumber % 2 AS INT)"
ORD = "CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT)"
B = (
    "b AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in COLUMNS.items()) + f", {AYES} AS ayes, {NOES} AS noes, {AWAY} AS abstentions, l_partkey % 8 = 0 AS untallied, {ORD} AS in_ord, l_orderkey, l_partkey, l_suppkey, "
    + " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in PRESENT) + " AS nc FROM lineitem)"
)
#: choices: a row a member
C = B + ", c AS (" + " UNION ALL ".join(f"SELECT *, {k} AS seat, '{m}' AS member, {CHOICE[k]} AS choice FROM b WHERE {PRESENT[k]}" for k, m in enumerate(MEMBERS)) + ")"
S = "s AS (SELECT CAST(o_orderkey AS STRING) AS session_id, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE o_orderpriority END AS title FROM orders)"


def lines(t):
    """The line items with session_id and in_ord. Only these few columns move, once, by session: whatever is made of them comes after,
    and what is grouped by session later finds its rows together."""
    rows = t("lineitem").selectExpr("CAST(l_orderkey AS STRING) AS session_id", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    return rows.selectExpr("*", ORD.replace("l_orderkey", "session_id") + " AS in_ord")


def made(rows, *more: str):
    """Ballots of lines(), with more columns."""
    map_of = "map_from_entries(filter(array(" + ", ".join(f"CASE WHEN {PRESENT[k]} THEN struct('{m}' AS member, {CHOICE[k]} AS choice) END" for k, m in enumerate(MEMBERS)) + "), x -> x IS NOT NULL)) AS choices"
    tally = f"CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE struct({AYES} AS ayes, {NOES} AS noes, {AWAY} AS abstentions) END AS tally"
    of = [f"{e.replace('CAST(l_orderkey AS STRING)', 'session_id')} AS {c}" for c, e in COLUMNS.items()]
    return rows.selectExpr(*of, map_of, tally, "in_ord", *more)


def ballots(t):
    return made(lines(t))


def sessions(t):
    return t("orders").select(F.col("o_orderkey").cast("string").alias("session_id"), F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.when(F.col("o_orderkey") % 15 != 0, F.col("o_orderpriority")).alias("title"), F.lit(None).cast("string").alias("time"), F.lit(None).cast("string").alias("video_url"), F.lit(None).cast("string").alias("agenda_url"))


# ---- scores and policies

AY = "CASE WHEN untallied THEN 0 ELSE ayes END"
PASSING = f"(CASE WHEN ballot_id IS NOT NULL THEN 100 ELSE 0 END + CASE WHEN contains(lower(coalesce(outcome, '')), 'pass') THEN 50 WHEN contains(lower(coalesce(outcome, '')), 'fail') THEN -50 ELSE 0 END - CASE WHEN contains(lower(coalesce(outcome, '')), 'pass') AND {AY} = 0 THEN 30 ELSE 0 END + 2 * nc)"
SC = {
    "complete": f"({PASSING} + CASE WHEN frame_path IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN motion_text IS NOT NULL THEN 5 ELSE 0 END)",
    "passing": PASSING,
    "tallied": f"({PASSING} + CASE WHEN untallied THEN 0 ELSE 3 END)",
    "frame": "(CASE WHEN ballot_id IS NOT NULL THEN 100 ELSE 0 END + 10 * nc + CASE WHEN untallied THEN 0 ELSE 5 * (ayes + noes + abstentions) END + coalesce(length(item_text), 0) + CASE WHEN frame_path IS NOT NULL THEN 20 ELSE 0 END)",
}
SC["whole"] = f"({SC['frame']} - CASE WHEN contains(item_text, '...') OR length(item_text) < 20 THEN 50 ELSE 0 END)"
SC["long"] = f"({SC['frame']} - CASE WHEN length(item_text) < 10 THEN 30 ELSE 0 END)"


@query(f"WITH {B} SELECT session_id, in_ord, " + ", ".join(f"CAST({e} AS BIGINT) AS {k}" for k, e in SC.items()) + " FROM b")
def ballot_scores(t):
    p = policies
    of = {"complete": p.complete_score(), "passing": p.passing_score(), "tallied": p.tallied_score(), "frame": p.frame_score(), "whole": p.whole_item_score(), "long": p.long_item_score()}
    return ballots(t).select("session_id", "in_ord", *[e.cast("bigint").alias(k) for k, e in of.items()])


def best_sql(keys: str, score: str, rest: str = "") -> str:
    return f"WITH {B}, {NORMAL} SELECT session_id, in_ord FROM (SELECT *, row_number() OVER (PARTITION BY session_id, {keys} ORDER BY {score} DESC, in_ord) AS rn FROM z) WHERE rn = 1 {rest}"


W = r"[ \t\n\x0B\f\r]"
re_ = lambda x, p, to="": f"regexp_replace({x}, '{p}', '{to}', 'g')"
_strip = lambda x: re_(x, f"^{W}+|{W}+$")


def _chain(x: str, patterns: tuple[str, ...]) -> str:
    for p in patterns:
        x = re_(x, p)
    return x


LIGHT = re_(_chain(_strip("lower(coalesce(x, ''))"), (r"^item\s+[0-9]+\s*:\s*", r"^no\.\s*[0-9]+\s*", r"\s*\(for adoption only\)\s*$", r"\s*\(for presentation\)\s*$", r"\s*expenditure:\s*none\.?\s*$", r"\s*expenditure:\s*\$[0-9,]+\.?\s*$")), W + "+", " ")
DISCUSS = _chain(re_(_strip("lower(coalesce(x, ''))"), W + "+", " "), (r"^item\s+[0-9]+\s*:\s*", r"^no\.\s*[0-9]+\s*", r"\s*\(for adoption only\)\s*$", r"\s*\(for presentation\)\s*$", r"\s*\(for discussion\)\s*$", r"\s*expenditure:\s*none\.?\s*$", r"\s*expenditure:\s*\$[0-9,]+\.?\s*$"))
#: of the ten phrases only these can occur in the texts of these tables
PHRASED = f"replace({DISCUSS}, 'council committee meetings and announcements', 'council committee meetings')"
AGGRESSIVE = _chain(re_(_chain(PHRASED, (r"^[0-9]+[a-z]?\s*\.?\s*", r"^[a-z]\s*\.?\s*")), r"\s*\(.*?\)\s*", " "), (r"\s*expenditure:.*$", r"\s*$"))
NORMAL = f"""z0 AS (SELECT *, item_text AS x FROM b), z1 AS (SELECT *, {LIGHT} AS light, {DISCUSS} AS discussion, {PHRASED} AS phrases, {AGGRESSIVE} AS aggressive, {_strip(re_("lower(coalesce(x, ''))", W + '+', ' '))} AS low FROM z0),
  z AS (SELECT *, CASE WHEN coalesce(item_text, '') = '' THEN '' WHEN starts_with(aggressive, 'consent calendar') THEN 'consent calendar' WHEN starts_with(aggressive, 'administrative matters') THEN 'administrative matters' WHEN starts_with(aggressive, 'oral communications') THEN 'oral communications'
    WHEN starts_with(aggressive, 'council committee meetings') THEN 'council committee meetings' WHEN starts_with(aggressive, 'hearings') THEN 'hearings' WHEN starts_with(aggressive, 'adjournment') THEN 'adjournment' WHEN length(aggressive) < 3 THEN 'generic item' ELSE aggressive END AS ultra,
    CASE WHEN contains(low, 'consent calendar') THEN 'consent calendar' WHEN contains(low, 'administrative matters') THEN 'administrative matters' WHEN contains(low, 'hearings') THEN 'hearings' WHEN contains(low, 'oral communications') THEN 'oral communications'
    WHEN contains(low, 'adjournment') THEN 'adjournment' WHEN contains(low, 'council committee meetings') THEN 'council committee meetings' ELSE low END AS category FROM z1)"""

for _k in ("light", "discussion", "phrases", "aggressive"):

    def _normal(t, k=_k):
        return ballots(t).select("session_id", "in_ord", getattr(tx, f"normalise_{k}")(F.col("item_text")).alias("item"))

    _normal.__name__ = f"normalize_{_k}"
    query(f"WITH {B}, {NORMAL} SELECT session_id, in_ord, {_k} AS item FROM z")(_normal)


@query(f"WITH {B}, {NORMAL} SELECT session_id, in_ord, ultra AS item FROM z")
def normalize_ultra(t):
    return tx.with_ultra(ballots(t), "item_text", "item").select("session_id", "in_ord", "item")


@query(f"WITH {B}, {NORMAL} SELECT session_id, in_ord, category AS item FROM z")
def normalize_category(t):
    return tx.with_category(ballots(t), "item_text", "item").select("session_id", "in_ord", "item")


STOP = "'', 'THE', 'A', 'AN', 'AND', 'OR', 'BUT', 'IN', 'ON', 'AT', 'TO', 'FOR', 'OF', 'WITH', 'BY'"
_flat = re_("upper(replace(coalesce(x, chr(32)), 'ß', 'SS'))", W + "+", " ")
MATCH = f"array_to_string(list_filter(string_split({re_(_flat, '[^\\p{L}\\p{N}_ ]')}, ' '), lambda w: w NOT IN ({STOP})), ' ')"


@query(f"SELECT doc_id, {MATCH} AS item FROM (SELECT doc_id, text AS x FROM documents)")
def normalize_match(t):
    return t("documents").select("doc_id", tx.normalise_match(F.col("text")).alias("item"))


@query(rf"""WITH {B}, p(o, p) AS (VALUES (1, 'PLANNING COMMISSION'), (2, 'COMMUNITY DEVELOPMENT'), (3, 'ORAL COMMUNICATIONS'), (4, 'ADJOURNMENT'), (5, 'CONSENT CALENDAR'), (6, 'HEARINGS'), (7, 'COUNCIL COMMITTEE'), (8, 'COMMUNITY SERVICES'), (9, 'RESOLUTION'), (10, 'ORDINANCE'), (11, 'PUBLIC HEARING'), (12, 'ACCEPT AND FILE')),
  f AS (SELECT session_id, in_ord, 0 AS o, regexp_extract(item_text, '^([0-9]+[A-Z]?)\s*\.', 1) AS p FROM b WHERE regexp_matches(item_text, '^[0-9]+[A-Z]?\s*\.') UNION ALL SELECT session_id, in_ord, o, p FROM b, p WHERE contains(upper(item_text), p))
  SELECT session_id, in_ord, string_agg(p, '|' ORDER BY o) AS phrases FROM f GROUP BY 1, 2""")
def key_phrases(t):
    return ballots(t).select("session_id", "in_ord", F.array_join(tx.key_phrases(F.col("item_text")), "|").alias("phrases")).where("phrases <> ''")


for _name, _keys, _score, _make in (
    ("policy_exact", "item_text", "complete", lambda b: policies.by_item(b)),
    ("policy_normalized", "phrases", "complete", lambda b: policies.by_item(b, tx.normalise_phrases(F.col("item_text")))),
    ("policy_aggressive", "aggressive", "complete", lambda b: policies.by_item(b, tx.normalise_aggressive(F.col("item_text")))),
    ("policy_ultra", "ultra", "complete", policies.by_ultra_item),
    ("policy_passing", "item_text", "passing", lambda b: policies.by_item(b, score=policies.passing_score())),
):

    def _policy(t, make=_make):
        return make(ballots(t)).select("session_id", "in_ord")

    _policy.__name__ = _name
    query(best_sql(_keys, SC[_score]))(_policy)


@query(best_sql("item_text", "CASE WHEN ballot_id IS NOT NULL THEN 1000000 ELSE nc END"))
def policy_first_id(t):
    return policies.by_first_id(ballots(t)).select("session_id", "in_ord")


@query(f"WITH {B}, {NORMAL}, r AS (SELECT *, row_number() OVER (PARTITION BY session_id, category ORDER BY {SC['tallied']} DESC, in_ord) AS rn, first_value(item_text) OVER (PARTITION BY session_id, category ORDER BY coalesce(length(item_text), 0) DESC, in_ord) AS longest FROM z) SELECT session_id, in_ord, longest AS item_text FROM r WHERE rn = 1")
def policy_category_carry(t):
    return policies.by_category(ballots(t)).select("session_id", "in_ord", "item_text")


@query(best_sql("frame_number, light", SC["frame"], "OR frame_number IS NULL"))
def policy_frame_item(t):
    return policies.by_frame(ballots(t), policies.frame_score(), tx.normalise_light(F.col("item_text"))).select("session_id", "in_ord")


@query(best_sql("frame_number", "coalesce(length(item_text), 0)", "OR frame_number IS NULL"))
def policy_frame_longest(t):
    return policies.longest_of_frame(ballots(t)).select("session_id", "in_ord")


@query(f"""WITH RECURSIVE {B}, f AS (SELECT *, {SC['whole']} AS sc, row_number() OVER (PARTITION BY session_id ORDER BY frame_number, in_ord) AS k, row_number() OVER (PARTITION BY session_id, frame_number ORDER BY {SC['whole']} DESC, in_ord) > 1 AS g FROM b WHERE frame_number IS NOT NULL),
  w AS (SELECT session_id, k, frame_number, sc, in_ord, g AS gone, CAST(NULL AS BIGINT) AS killed FROM f WHERE k = 1
    UNION ALL SELECT f.session_id, f.k, f.frame_number, f.sc, f.in_ord, f.g OR (NOT w.gone AND NOT f.g AND f.frame_number - w.frame_number <= 2 AND w.sc >= f.sc), CASE WHEN NOT w.gone AND NOT f.g AND f.frame_number - w.frame_number <= 2 AND w.sc < f.sc THEN w.in_ord END FROM w JOIN f ON f.session_id = w.session_id AND f.k = w.k + 1)
  SELECT session_id, in_ord FROM w WHERE NOT gone AND NOT EXISTS (SELECT 1 FROM w v WHERE v.session_id = w.session_id AND v.killed = w.in_ord) UNION ALL SELECT session_id, in_ord FROM b WHERE frame_number IS NULL""")
def policy_frame_neighbours(t):
    return policies.by_frame_then_neighbours(ballots(t)).select("session_id", "in_ord")


@query(f"WITH {B} SELECT session_id, in_ord FROM b WHERE NOT (session_id, in_ord) IN (SELECT (session_id, in_ord) FROM (SELECT *, row_number() OVER (ORDER BY length(item_text) DESC, in_ord) AS rn FROM b WHERE session_id = '1' AND contains(item_text, 'a')) WHERE rn = 2)")
def policy_drop_second(t):
    return policies.drop_second(ballots(t), "1", "a").select("session_id", "in_ord")


@query(f"WITH {B}, h AS (SELECT session_id, in_ord FROM b WHERE outcome = 'Tie' ORDER BY session_id, in_ord LIMIT 1) SELECT b.session_id, b.in_ord, CASE WHEN h.in_ord IS NOT NULL THEN 'Motion Passes' ELSE outcome END AS outcome FROM b LEFT JOIN h USING (session_id, in_ord)")
def patch_first(t):
    return policies.patch_first(ballots(t), F.col("outcome") == "Tie", "outcome", F.lit("Motion Passes")).select("session_id", "in_ord", "outcome")


# ---- topics, choices, merges

TOPIC = """CASE WHEN contains(x, 'consent calendar') THEN 'Consent Calendar' WHEN contains(x, 'administrative matters') THEN 'Administrative Matters' WHEN contains(x, 'planning') OR contains(x, 'development') THEN 'Planning & Development' WHEN contains(x, 'fire') OR contains(x, 'police') OR contains(x, 'public safety') THEN 'Public Safety'
  WHEN contains(x, 'finance') OR contains(x, 'budget') OR contains(x, 'appropriation') THEN 'Budget & Finance' WHEN contains(x, 'transit') OR contains(x, 'transportation') THEN 'Transportation' WHEN contains(x, 'community services') OR contains(x, 'parks') THEN 'Community Services' WHEN contains(x, 'environmental') OR contains(x, 'sustainability') THEN 'Environmental'
  WHEN contains(x, 'housing') THEN 'Housing' WHEN contains(x, 'honoring') OR contains(x, 'proclamation') OR contains(x, 'resolution') THEN 'Recognition & Proclamations' WHEN contains(x, 'hearing') THEN 'Public Hearings' WHEN contains(x, 'adjournment') THEN 'Adjournment' WHEN contains(x, 'oral communications') THEN 'Public Comment' ELSE 'Other Business' END"""
T = f"{B}, t AS (SELECT *, {TOPIC} AS topic FROM (SELECT *, lower(coalesce(item_text, '')) AS x FROM b))"


@query(f"WITH {T} SELECT topic, count(*)::BIGINT AS n FROM t GROUP BY 1")
def topic_histogram(t):
    return ballots(t).groupBy(tx.topic(F.col("item_text")).alias("topic")).agg(n().alias("n"))


@query(f"WITH {T}, g AS (SELECT session_id, topic, count(*) AS n, min(in_ord) AS f FROM t GROUP BY 1, 2) SELECT session_id, topic, n::BIGINT AS n, rank::BIGINT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, f) AS rank FROM g) WHERE rank <= 5")
def topic_top(t):
    g = ballots(t).groupBy("session_id", tx.topic(F.col("item_text")).alias("topic")).agg(n().alias("n"), F.min("in_ord").alias("f"))
    rank = F.row_number().over(Window.partitionBy("session_id").orderBy(F.desc("n"), "f"))
    return g.withColumn("rank", rank.cast("bigint")).where("rank <= 5").select("session_id", "topic", "n", "rank")


RAW_NAME = "CASE l_suppkey % 3 WHEN 0 THEN 'ada' WHEN 1 THEN 'bo' ELSE 'no9' END"
RAW_TOKEN = "CASE l_partkey % 12 WHEN 0 THEN 'Yea' WHEN 1 THEN 'nl' WHEN 2 THEN 'mal' WHEN 3 THEN 'ly' WHEN 4 THEN 'AI' WHEN 5 THEN 'y' WHEN 6 THEN 'N' WHEN 7 THEN 'a' WHEN 8 THEN 'mill' WHEN 9 THEN 'No!' WHEN 10 THEN 'recuse' ELSE 'yes' END"
RAW = f"concat(CASE l_partkey % 5 WHEN 0 THEN '  Councilmember ' WHEN 1 THEN 'Mayor ' ELSE 'Councilmember  ' END, {RAW_NAME}, ' ', {RAW_TOKEN})"


def raw_texts(t):
    rows = t("lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.expr(RAW).alias("line")).alias("r"))
    return rows.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["line"]), "\n").alias("raw"))


@query(rf"""WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i, lower({RAW}) AS line FROM lineitem), p AS (SELECT l_orderkey, i, regexp_extract(line, '^\s*councilmember\s+([a-z0-9_]+)\s+([a-z]+)', 1) AS m, regexp_extract(line, '^\s*councilmember\s+([a-z0-9_]+)\s+([a-z]+)', 2) AS v FROM l)
  SELECT l_orderkey, CASE m WHEN 'ada' THEN 'ADA LOVE' WHEN 'bo' THEN 'BO REED' ELSE upper(m) END AS member, CASE arg_max(v, i) WHEN 'yea' THEN 'YES' WHEN 'y' THEN 'YES' WHEN 'yes' THEN 'YES' WHEN 'ly' THEN 'YES' WHEN 'nay' THEN 'NO' WHEN 'n' THEN 'NO' WHEN 'no' THEN 'NO' WHEN 'nl' THEN 'NO' WHEN 'abstain' THEN 'ABSTAIN' WHEN 'a' THEN 'ABSTAIN' WHEN 'ai' THEN 'ABSTAIN' WHEN 'mal' THEN 'ABSTAIN' WHEN 'mill' THEN 'ABSTAIN' ELSE upper(arg_max(v, i)) END AS choice
  FROM p WHERE m <> '' GROUP BY l_orderkey, m""")
def choice_lines(t):
    names = F.create_map(*map(F.lit, ("ada", "ADA LOVE", "bo", "BO REED")))
    return tx.choice_rows(raw_texts(t), ["l_orderkey"], "raw", names)


@query(f"""WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i, lower({RAW}) AS line FROM lineitem), f AS (SELECT l_orderkey, arg_min(trim(split_part(line, 'bo', 2)), i) AS v FROM l WHERE contains(line, 'bo') GROUP BY 1)
  SELECT l_orderkey, CASE WHEN v IN ('nil', 'nl', 'n', 'na', 'nay') THEN 'NO' WHEN v IN ('yea', 'y', 'yes', 'ra', 'r') THEN 'YES' ELSE 'ABSTAIN' END AS choice FROM f""")
def single_member_choice(t):
    return raw_texts(t).select("l_orderkey", tx.one_choice(F.col("raw"), "bo").alias("choice")).where("choice IS NOT NULL")


MERGED = "SELECT session_id, item_text, string_agg(concat(member, '=', choice), ',' ORDER BY member) AS choices FROM (SELECT session_id, item_text, member, arg_max(choice, in_ord) AS choice FROM c GROUP BY 1, 2, 3) GROUP BY 1, 2"


@query(f"""WITH {C}, m AS ({MERGED}),
  i AS (SELECT *, coalesce(ballot_id, concat(session_id, '_', coalesce(item_text, 'None'))) AS id, coalesce(frame_number, 0) AS f,
               row_number() OVER (PARTITION BY session_id, item_text ORDER BY coalesce(frame_number, 0), in_ord) AS rn FROM b),
  g AS (SELECT session_id, item_text, string_agg(id, ',' ORDER BY in_ord) AS ids FROM i GROUP BY 1, 2)
  SELECT i.session_id, i.item_text, i.id AS ballot_id, CAST(i.f AS INTEGER) AS frame_number, i.marker_id, i.video_ts, coalesce(i.ts_estimated, true) AS ts_estimated, g.ids, coalesce(m.choices, '') AS choices
  FROM i JOIN g ON i.session_id = g.session_id AND i.item_text IS NOT DISTINCT FROM g.item_text
  LEFT JOIN m ON i.session_id = m.session_id AND i.item_text IS NOT DISTINCT FROM m.item_text WHERE i.rn = 1""")
def merge_ballots(t):
    merged = ch.merge_ballots(ballots(t), ["session_id", "item_text"])
    texts = {"ids": F.array_join("consolidated_from", ","), "choices": ch.entries_text(F.col("choices"))}
    return merged.withColumns(texts).select("session_id", "item_text", "ballot_id", "frame_number", "marker_id", "video_ts", "ts_estimated", "ids", "choices")


@query(f"""WITH {C},
  k AS (SELECT session_id, item_text, count_if(choice = 'YES') AS y, count_if(choice = 'NO') AS o, count_if(choice = 'ABSTAIN') AS a FROM c GROUP BY 1, 2),
  x AS (SELECT *, row_number() OVER w AS rn, count(*) OVER p AS m, min(nullif(frame_number, 0)) OVER p AS mf, min(nullif(video_ts, 0)) OVER p AS mt FROM b
        WINDOW p AS (PARTITION BY session_id, item_text), w AS (PARTITION BY session_id, item_text ORDER BY in_ord)),
  f AS (SELECT session_id, item_text, arg_min(marker_id, in_ord) AS mk FROM b WHERE marker_id <> '' GROUP BY 1, 2),
  r AS (SELECT x.*, y, o, a, mk, m > 1 AND y IS NOT NULL AS counted FROM x
        LEFT JOIN k ON x.session_id = k.session_id AND x.item_text IS NOT DISTINCT FROM k.item_text
        LEFT JOIN f ON x.session_id = f.session_id AND x.item_text IS NOT DISTINCT FROM f.item_text WHERE rn = 1),
  e AS (SELECT session_id, item_text, m::BIGINT AS merged, ballot_id,
               CASE WHEN NOT counted THEN outcome WHEN y > o THEN 'Passes' WHEN y < o THEN 'Fails' ELSE 'Tie' END AS outcome,
               CAST(CASE WHEN m > 1 THEN coalesce(mf, frame_number) ELSE frame_number END AS INTEGER) AS frame_number,
               CASE WHEN m > 1 THEN coalesce(mt, video_ts) ELSE video_ts END AS video_ts, CASE WHEN m > 1 THEN coalesce(mk, marker_id) ELSE marker_id END AS marker_id,
               CAST(CASE WHEN counted THEN y WHEN NOT untallied THEN ayes END AS INTEGER) AS ayes, CAST(CASE WHEN counted THEN o WHEN NOT untallied THEN noes END AS INTEGER) AS noes,
               CAST(CASE WHEN counted THEN a WHEN NOT untallied THEN abstentions END AS INTEGER) AS abstentions FROM r)
  SELECT *, video_ts IS NULL AS ts_estimated FROM e""")
def merge_listed(t):
    return ch.merge_listed(ballots(t), ["session_id", "item_text"])


K = C + ", k AS (SELECT session_id, in_ord, count_if(choice = 'YES')::BIGINT AS y, count_if(choice = 'NO')::BIGINT AS o, count_if(choice = 'ABSTAIN')::BIGINT AS a FROM c GROUP BY 1, 2)"


@query(f"""WITH {K} SELECT session_id, in_ord, CASE WHEN NOT untallied THEN ayes WHEN nc > 0 THEN y END::BIGINT AS ayes, CASE WHEN NOT untallied THEN noes WHEN nc > 0 THEN o END::BIGINT AS noes, untallied AND nc > 0 AS filled, CASE WHEN untallied AND nc > 0 THEN CASE WHEN y > o THEN 'Motion Passes' WHEN y < o THEN 'Motion Fails' ELSE 'Tie' END ELSE outcome END AS outcome FROM b LEFT JOIN k USING (session_id, in_ord)""")
def fill_tally(t):
    return ch.fill_tally(ballots(t)).select("session_id", "in_ord", F.col("tally.ayes").cast("bigint").alias("ayes"), F.col("tally.noes").cast("bigint").alias("noes"), F.col("tally_filled").alias("filled"), "outcome")


LACKS = "(l_suppkey + 2) % 3 = 0"
OUT = "lower(coalesce(outcome, ''))"


@query(f"""WITH {K}, i AS (SELECT *, {LACKS} AS lacks, CASE WHEN contains({OUT}, 'tie') THEN CASE WHEN coalesce(y, 0) > coalesce(o, 0) THEN 'YES' ELSE 'NO' END WHEN contains({OUT}, 'pass') THEN 'YES' WHEN contains({OUT}, 'fail') THEN 'NO' ELSE 'YES' END AS said FROM b LEFT JOIN k USING (session_id, in_ord))
  SELECT session_id, in_ord, lacks AS imputed, CASE WHEN lacks THEN said ELSE {CHOICE[2]} END AS choice, (coalesce(y, 0) + CASE WHEN lacks AND said = 'YES' THEN 1 ELSE 0 END)::BIGINT AS ayes, (coalesce(o, 0) + CASE WHEN lacks AND said = 'NO' THEN 1 ELSE 0 END)::BIGINT AS noes FROM i""")
def impute_member(t):
    out = ch.impute_member(ballots(t), "cy", "majority", recount=True)
    tally = [F.col(f"tally.{c}").cast("bigint").alias(c) for c in ("ayes", "noes")]
    return out.select("session_id", "in_ord", (F.size("imputed") > 0).alias("imputed"), F.col("choices")["cy"].alias("choice"), *tally)


@query(f"""WITH {B}, i AS (SELECT *, {LACKS} AS lacks, CASE WHEN regexp_matches({OUT}, 'pass|adopt|approve') THEN 'YES' WHEN regexp_matches({OUT}, 'fail|deny|reject') THEN 'NO' ELSE 'YES' END AS said FROM b)
  SELECT session_id, in_ord, lacks AS imputed, CASE WHEN lacks THEN said ELSE {CHOICE[2]} END AS choice,
         CASE WHEN NOT untallied THEN ayes + CASE WHEN lacks AND said = 'YES' THEN 1 ELSE 0 END END::BIGINT AS ayes,
         CASE WHEN NOT untallied THEN noes + CASE WHEN lacks AND said = 'NO' THEN 1 ELSE 0 END END::BIGINT AS noes FROM i""")
def impute_by_outcome(t):
    tally = [F.col(f"tally.{c}").cast("bigint").alias(c) for c in ("ayes", "noes")]
    return ch.impute_member(ballots(t), "cy").select("session_id", "in_ord", (F.size("imputed") > 0).alias("imputed"), F.col("choices")["cy"].alias("choice"), *tally)


@query(f"""WITH {K} SELECT session_id, in_ord, CASE WHEN NOT {LACKS} THEN {CHOICE[2]} WHEN contains({OUT}, 'pass') THEN 'YES' WHEN contains({OUT}, 'fail') THEN 'NO'
         WHEN contains({OUT}, 'tie') AND coalesce(y, 0) <= coalesce(o, 0) THEN 'NO' ELSE 'YES' END AS choice FROM b LEFT JOIN k USING (session_id, in_ord)""")
def impute_by_majority(t):
    return ch.impute_member(ballots(t), "cy", "majority").select("session_id", "in_ord", F.col("choices")["cy"].alias("choice"))


@query(f"""WITH {B}, h AS (SELECT *, coalesce(frame_path IS NOT NULL AND ({PRESENT[0]}) AND ({CHOICE[0]}) = 'ABSTAIN', false) AS hit FROM b) SELECT session_id, in_ord, CASE WHEN untallied THEN NULL ELSE noes + CASE WHEN hit THEN 1 ELSE 0 END END::BIGINT AS noes, CASE WHEN untallied THEN NULL WHEN hit THEN greatest(0, abstentions - 1) ELSE abstentions END::BIGINT AS abstentions, CASE WHEN hit THEN 'NO' WHEN {PRESENT[0]} THEN {CHOICE[0]} END AS choice FROM h""")
def correct_choice(t):
    out = ch.correct_choice(ballots(t), "ada", "NO", F.col("frame_path").isNotNull())
    return out.select("session_id", "in_ord", F.col("tally.noes").cast("bigint").alias("noes"), F.col("tally.abstentions").cast("bigint").alias("abstentions"), F.col("choices")["ada"].alias("choice"))


@query(f"""WITH {C} SELECT session_id, in_ord, string_agg(concat(m, '=', v), ',' ORDER BY m) AS choices FROM (SELECT session_id, in_ord, CASE member WHEN 'bo' THEN 'ada' ELSE member END AS m, arg_max(choice, member) AS v FROM c WHERE member <> 'ed' GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def rename_members(t):
    moved = ch.renamed(F.map_filter("choices", lambda k, v: k != "ed"), {"bo": "ada"})
    some = ballots(t).where(F.exists(F.map_keys("choices"), lambda k: k != "ed"))  # by its keys, so no text is made twice
    return some.select("session_id", "in_ord", ch.entries_text(moved).alias("choices"))


@query(f"""WITH {C} SELECT session_id, in_ord, string_agg(concat(upper(member), '=', CASE WHEN choice = 'ABSTAIN' THEN 'ABSTAIN' ELSE choice END), ',' ORDER BY member) AS choices FROM c WHERE member IN ('ada', 'cy', 'di') GROUP BY 1, 2""")
def whitelist_choices(t):
    known = ["ADA", "CY", "DI", "Zed"]
    some = ballots(t).where(F.exists(F.map_keys("choices"), lambda k: F.upper(k).isin(*map(str.upper, known))))
    return some.select("session_id", "in_ord", ch.entries_text(ch.whitelisted(F.col("choices"), known)).alias("choices"))


@query(f"""WITH {C}, m AS (SELECT session_id, in_ord, member, choice FROM c WHERE member <> 'di' UNION ALL SELECT session_id, in_ord, 'di', 'NEW' FROM b) SELECT session_id, in_ord, string_agg(concat(member, '=', choice), ',' ORDER BY member) AS choices FROM m GROUP BY 1, 2""")
def merge_maps(t):
    new = F.create_map(F.lit("di"), F.lit("NEW"))
    return ballots(t).select("session_id", "in_ord", ch.entries_text(ch.merged(F.col("choices"), new)).alias("choices"))


@query(f"WITH {C} SELECT session_id, member, count(*)::BIGINT AS n FROM c GROUP BY 1, 2")
def participation(t):
    return ch.participation(ballots(t)).select("session_id", "member", F.col("n").cast("bigint").alias("n"))


@query(f"WITH {T} SELECT session_id, count(*)::BIGINT AS n FROM t WHERE contains(x, 'consent calendar') OR contains(x, 'adjournment') OR contains(x, 'administrative matters') OR contains(x, 'oral communications') OR contains(x, 'council committee meetings') OR contains(x, 'hearings') GROUP BY 1")
def recurring_items(t):
    return ch.recurring(ballots(t)).select("session_id", F.col("n").cast("bigint").alias("n"))


@query(f"WITH {C} SELECT member, count(DISTINCT item_text)::BIGINT AS areas, count(*)::BIGINT AS total, count_if(choice = 'YES')::BIGINT AS yes FROM c WHERE contains(member, 'a') OR contains(member, 'bo') GROUP BY 1")
def member_areas(t):
    each = ballots(t).select("item_text", F.explode("choices").alias("member", "choice")).where(tx.contains_any(F.col("member"), ("a", "bo")))
    return each.groupBy("member").agg(F.countDistinct("item_text").cast("bigint").alias("areas"), n().alias("total"), count_if(F.col("choice") == "YES").alias("yes"))


@query(f"WITH {B}, {NORMAL}, w AS (SELECT session_id, item_text, row_number() OVER (PARTITION BY session_id, item_text ORDER BY in_ord) AS rn FROM b) SELECT count(*)::BIGINT AS before, count_if(rn = 1)::BIGINT AS after, (SELECT count_if(marker_id <> '') FROM b)::BIGINT AS matched FROM w")
def reduction_counters(t):
    b = ballots(t)
    after = policies.by_item(b).agg(n().alias("after"))
    return b.agg(n().alias("before"), count_if(F.col("marker_id") != "").alias("matched")).crossJoin(after).select("before", "after", "matched")  # single rows


@query(f"WITH {B} SELECT session_id, in_ord, contains(lower(item_text), 'oral communications') OR contains(lower(item_text), 'adjournment') OR contains(lower(item_text), 'announcement') OR contains(lower(item_text), 'council committee meetings') AS nv, length(coalesce(item_text, '')) <= 5 OR ends_with(coalesce(item_text, ''), '...') OR coalesce(item_text, '') IN ('None', 'Not visible in image', 'Not visible in the image', 'Unknown Agenda Item') AS cut FROM b".replace("adjournment') OR contains(lower(item_text), 'ann", "adjournment') OR contains(lower(item_text), 'presentation only') OR contains(lower(item_text), 'for presentation') OR contains(lower(item_text), 'ann").replace(" AS nv", " AS nv0").replace("SELECT session_id, in_ord, contains", "SELECT session_id, in_ord, coalesce(contains", 1).replace(" AS nv0", ", false) AS not_votable", 1))
def item_flags(t):
    return ballots(t).select("session_id", "in_ord", tx.not_votable(F.col("item_text")).alias("not_votable"), tx.truncated(F.col("item_text")).alias("cut"))


@query(f"WITH {B} SELECT session_id, in_ord, CASE WHEN contains({OUT}, 'pass') THEN concat('Approved ', substr(item_text, 1, 60), '...') ELSE concat('Rejected ', substr(item_text, 1, 60), '...') END AS action FROM b WHERE (contains({OUT}, 'pass') OR contains({OUT}, 'fail')) AND regexp_matches(lower(item_text), 'budget|appropriation|ordinance|resolution|contract|agreement')")
def notable_actions(t):
    return ballots(t).select("session_id", "in_ord", tx.notable(F.col("item_text"), F.col("outcome")).alias("action")).where("action is not null")


@query(f"WITH {B} SELECT concat('Vote ', in_ord, ': Missing required field ''agenda_item''') AS issue FROM b WHERE item_text IS NULL")
def validate_ballots(t):
    return ch.issues_of_ballots(ballots(t).withColumnRenamed("in_ord", "place"))


@query(f"WITH {S} SELECT concat('Meeting ', session_id, ': Missing required field ''title''') AS issue FROM s WHERE title IS NULL UNION ALL SELECT concat('Meeting ', session_id, ': Missing required field ''date''') FROM s WHERE date IS NULL")
def validate_sessions(t):
    return ch.issues_of_sessions(sessions(t))


@query(f"WITH {B} SELECT count_if(session_id IS NULL OR item_text IS NULL) = 0 AS valid FROM b")
def validate_all(t):
    return ch.is_valid(ballots(t))


@query(f"WITH {S}, d AS (SELECT session_id, '2024-02-03' AS date FROM s WHERE right(session_id, 1) = '4') SELECT s.session_id, coalesce(d.date, s.date) AS date FROM s LEFT JOIN d USING (session_id)")
def lookup_update(t):
    s = sessions(t)
    dates = s.where(F.substring("session_id", -1, 1) == "4").select("session_id", F.lit("2024-02-03").alias("date"))
    return ch.set_default(s.select("session_id", "date"), dates, "session_id", "date")


MARKERS = "m AS (SELECT l_orderkey AS s, l_partkey AS id, min(l_suppkey) * 10 AS seconds FROM lineitem WHERE l_partkey % 9 = 0 AND l_suppkey % 2 = 1 GROUP BY 1, 2)"


@query(f"WITH {B}, {MARKERS} SELECT session_id, in_ord, CASE WHEN coalesce(marker_id, '') = '' THEN video_ts WHEN seconds IS NOT NULL THEN seconds ELSE frame_number // 30 END::BIGINT AS video_ts, CASE WHEN coalesce(marker_id, '') = '' THEN ts_estimated ELSE seconds IS NULL END AS ts_estimated FROM b LEFT JOIN m ON l_orderkey = s AND marker_id = CAST(id AS STRING)")
def marker_times(t):
    marked = t("lineitem").where("l_partkey % 9 = 0 AND l_suppkey % 2 = 1").groupBy(F.col("l_orderkey").cast("string").alias("session_id"), F.col("l_partkey").cast("string").alias("marker_id")).agg((F.min("l_suppkey") * 10).alias("seconds"))
    return linkage.marker_times(ballots(t), marked).select("session_id", "in_ord", "video_ts", "ts_estimated")


# ---- the query API


@query(f"WITH {B}, {S} SELECT b.session_id, in_ord, item_text FROM b JOIN s USING (session_id) WHERE contains({OUT}, 'pass') AND contains(lower(item_text), 'calendar') AND ({PRESENT[1]}) AND date BETWEEN '1995-01-01' AND '1996-12-31' ORDER BY b.session_id, in_ord LIMIT 40 OFFSET 10")
def api_ballots(t):
    q = api.BallotQuery(member="BO", item="Calendar", result="passed", date_from="1995-01-01", date_to="1996-12-31", offset=10, limit=40)
    return api.ballots(ballots(t), q, sessions(t)).select("session_id", "in_ord", "item_text")


@query(f"WITH {C} SELECT session_id, in_ord, ballot_id, item_text, choice, outcome FROM c WHERE member = 'di'")
def api_member_record(t):
    return api.member_record(ballots(t), "Di").select("session_id", "in_ord", "ballot_id", "item_text", "choice", "outcome")


@query(f"WITH {C} SELECT 'Di' AS member, count(*)::BIGINT AS total, count_if(contains({OUT}, 'pass'))::BIGINT AS passed, count_if(contains({OUT}, 'fail'))::BIGINT AS failed, count_if(choice = 'ABSTAIN')::BIGINT AS abstentions FROM c WHERE member = 'di'")
def api_member_summary(t):
    return api.member_summary(ballots(t), "Di")


@query(f"WITH {B} SELECT coalesce(nullif(item_text, ''), 'Unknown') AS item, count(*)::BIGINT AS total, count_if(contains({OUT}, 'pass'))::BIGINT AS passed, count_if(NOT contains({OUT}, 'pass'))::BIGINT AS failed FROM b WHERE session_id = '7' GROUP BY 1")
def api_session_summary(t):
    return api.session_summary(ballots(t), "7")


@query(f"WITH {B} SELECT session_id, in_ord FROM b WHERE contains(lower(item_text), 'adopt') OR contains(lower(motion_text), 'adopt')")
def api_search(t):
    return api.search(ballots(t), "ADOPT").select("session_id", "in_ord")


_pct = lambda x: f"concat((((2000 * {x} + n) // (2 * n)) // 10)::BIGINT, '.', (((2000 * {x} + n) // (2 * n)) % 10)::BIGINT, '%')"


@query(f"WITH {B}, g AS (SELECT count(*)::BIGINT AS n, count(DISTINCT session_id)::BIGINT AS s, count_if(contains({OUT}, 'pass'))::BIGINT AS p, count_if(contains({OUT}, 'fail'))::BIGINT AS f, count_if(nc > 0)::BIGINT AS c, count_if(item_text <> '' AND NOT contains(item_text, 'Not available'))::BIGINT AS i FROM b) SELECT n AS ballots, s AS sessions, p AS passed, f AS failed, {_pct('p')} AS pass_rate, {_pct('c')} AS with_choices, {_pct('i')} AS with_item FROM g")
def api_statistics(t):
    return api.statistics(ballots(t))


@query(f"WITH {C} SELECT member, count(*)::BIGINT AS total, count_if(choice = 'YES')::BIGINT AS yes, count_if(choice = 'NO')::BIGINT AS no, count_if(choice = 'ABSTAIN')::BIGINT AS abstain FROM c WHERE member IN ('ada', 'ed') GROUP BY 1 UNION ALL SELECT 'zoe', 0, 0, 0, 0")
def api_member_stats(t):
    b = ballots(t)
    roster = b.sparkSession.createDataFrame([("ada",), ("ed",), ("zoe",)], "member string")
    return api.member_stats(b, roster)


@query(f"WITH {C} SELECT 'member' AS kind, member AS name FROM c GROUP BY 2 UNION ALL SELECT 'item', item_text FROM b WHERE item_text <> '' GROUP BY 2")
def api_lists(t):
    b = ballots(t)
    return api.members(b).select(F.lit("member").alias("kind"), F.col("member").alias("name")).union(api.items(b).select(F.lit("item"), "item_text"))


@query(f"WITH {B} SELECT session_id, in_ord, ballot_id FROM b WHERE ballot_id = '7_2' ORDER BY in_ord LIMIT 1")
def api_ballot(t):
    return api.ballot(ballots(t), "7_2").select("session_id", "in_ord", "ballot_id")


@query(f"WITH {C}, {S} SELECT session_id, date, (SELECT count(*) FROM b)::BIGINT AS ballots, (SELECT count(*) FROM s)::BIGINT AS sessions, (SELECT count(DISTINCT member) FROM c)::BIGINT AS members FROM s ORDER BY date DESC NULLS LAST, session_id DESC LIMIT 3")
def api_home(t):
    return api.home(ballots(t), sessions(t))


@query(f"WITH {B}, d AS (SELECT *, coalesce(video_ts, greatest(1, coalesce(frame_number, 0) * 2)) AS sec FROM b WHERE session_id = '7') SELECT in_ord, row_number() OVER (ORDER BY coalesce(frame_number, 0), in_ord)::BIGINT AS place, printf('%02d:%02d', sec // 60, sec % 60) AS clock, 'Summary' AS summary FROM d")
def api_session_detail(t):
    b = ballots(t)
    notes = b.sparkSession.createDataFrame([("7", "Summary")], "session_id string, summary string")
    out = api.session_detail(b, "7", notes)
    return out.select("in_ord", F.row_number().over(Window.orderBy(F.coalesce("frame_number", F.lit(0)), "in_ord")).cast("bigint").alias("place"), "clock", "summary")  # one session


@query(f"WITH {B}, {S} SELECT session_id, date FROM s WHERE date LIKE '1996-%' AND session_id IN (SELECT session_id FROM b)")
def api_year(t):
    return api.year_page(ballots(t), sessions(t), 1996).select("session_id", "date")


@query(f"""WITH {B}, {S} SELECT session_id, in_ord, concat_ws(',', session_id, coalesce(date, ''), '', concat('"', replace(coalesce(item_text, ''), '"', '""'), '"'), coalesce(outcome, ''), CASE WHEN untallied THEN 0 ELSE ayes END, CASE WHEN untallied THEN 0 ELSE noes END, CASE WHEN untallied THEN 0 ELSE abstentions END, recused, coalesce(CAST(nullif(video_ts, 0) AS STRING), ''), '', '', coalesce(marker_id, ''), coalesce(CAST(nullif(frame_number, 0) AS STRING), ''), CASE WHEN ts_estimated THEN 'Yes' ELSE 'No' END) AS line FROM b LEFT JOIN s USING (session_id)""")
def export_csv(t):
    return api.csv_rows(ballots(t), sessions(t))


@query(f"""WITH {B} SELECT session_id, in_ord, item_text, CAST(CASE WHEN untallied THEN NULL ELSE ayes END AS BIGINT) AS ayes, frame_number FROM b""")
def export_json(t):
    doc = api.json_rows(ballots(t))
    read = doc.select("session_id", "in_ord", F.from_json("doc", "agenda_item string, vote_tally struct<ayes: bigint>, frame_number int").alias("d"))  # parsed once
    return read.select("session_id", "in_ord", F.col("d.agenda_item").alias("item_text"), F.col("d.vote_tally.ayes").alias("ayes"), F.col("d.frame_number").alias("frame_number"))


REPORT = f"""WITH {C}, {S}, t AS (SELECT *, {TOPIC} AS topic FROM (SELECT *, lower(coalesce(item_text, '')) AS x FROM b)), g AS (SELECT session_id, count(*) AS n, count_if(contains({OUT}, 'pass')) AS p, count_if(contains({OUT}, 'fail')) AS f FROM b GROUP BY 1),
  k AS (SELECT session_id, topic, count(*) AS n, min(in_ord) AS o FROM t GROUP BY 1, 2), k5 AS (SELECT session_id, string_agg(concat(topic, ' (', n, ' items)'), ', ' ORDER BY n DESC, o) AS topics FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, o) AS r FROM k) WHERE r <= 5 GROUP BY 1),
  a AS (SELECT session_id, in_ord, concat(CASE WHEN contains({OUT}, 'pass') THEN 'Approved ' ELSE 'Rejected ' END, substr(item_text, 1, 60), '...') AS a FROM b WHERE (contains({OUT}, 'pass') OR contains({OUT}, 'fail')) AND regexp_matches(lower(item_text), 'budget|appropriation|ordinance|resolution|contract|agreement')),
  a3 AS (SELECT session_id, string_agg(a, '; ' ORDER BY in_ord) AS actions FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY in_ord) AS r FROM a) WHERE r <= 3 GROUP BY 1),
  v AS (SELECT session_id, member, count(*) AS n, min(in_ord) AS o FROM c GROUP BY 1, 2), v1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY n DESC, o, member) AS r FROM v) WHERE r = 1)
  SELECT s.session_id, concat_ws(' ', concat('The council convened on ', coalesce(date, 'Unknown date'), ' for a regular meeting.'), CASE WHEN g.n > 0 THEN concat('The council conducted ', g.n, ' votes, with ', p, ' motions passing and ', f, ' motions failing.') END, CASE WHEN topics <> '' THEN concat('Key agenda topics included: ', topics, '.') END, CASE WHEN actions <> '' THEN concat('Notable actions included: ', actions, '.') END,
    CASE WHEN v1.member IS NOT NULL THEN concat('All councilmembers participated actively, with ', v1.member, ' voting on ', v1.n, ' items.') END, 'The meeting concluded with standard adjournment procedures.') AS report FROM s LEFT JOIN g USING (session_id) LEFT JOIN k5 USING (session_id) LEFT JOIN a3 USING (session_id) LEFT JOIN v1 USING (session_id)"""


@query(REPORT)
def session_reports(t):
    return api.session_reports(ballots(t), sessions(t))
