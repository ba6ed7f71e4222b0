"""Queries of containment per session, clusters, counters, aliases and the import, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollcall.functions import times as tm
from rollcall.operators import aliases, catalog_run, choices, clusters, containment, counters, importing
from rollcall.shared import shared_folder

from .meetings import B, C, OUT, ballots
from .registry import query

# ---- containment: a session is a brand, an item a part's name and type, a key a part of such a text of another part

ITEM = "concat(p_name, ' ', lower(p_type))"
KEY = f"""CASE p_partkey % 5 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN p_name WHEN 2 THEN concat({ITEM}, ' x')
  WHEN 3 THEN {ITEM} ELSE upper(split_part(p_name, ' ', 2)) END"""


def _items(t):
    return t("part").selectExpr("p_partkey", "p_brand", f"{ITEM} AS item", "p_partkey * 7 % 1009 + p_partkey AS o", f"{KEY} AS key")


def _sides(t):
    rows = _items(t)
    return rows.select("p_partkey", "p_brand", "item"), rows.where("p_partkey % 3 = 0").select("p_brand", "o", "key")


def _containment_sql(order: str, where: str = "true") -> str:
    words = "len(list_intersect(list_distinct(string_split(lower(item), ' ')), list_distinct(string_split(lower(key), ' '))))"
    return f"""WITH p AS (SELECT p_partkey, p_brand, {ITEM} AS item, p_partkey * 7 % 1009 + p_partkey AS o, {KEY} AS key FROM part),
      k AS (SELECT p_brand, key, o FROM p WHERE p_partkey % 3 = 0),
      m AS (SELECT p_partkey, p.item, k.key, k.o, p.item = k.key AS same, {words.replace('item', 'p.item').replace('key', 'k.key')} AS score FROM p JOIN k ON p.p_brand = k.p_brand
            AND (contains(lower(p.item), lower(k.key)) OR contains(lower(k.key), lower(p.item))))
      SELECT p_partkey, key, o::BIGINT AS o FROM m WHERE {where} QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY {order}) = 1"""


def _contained(t, policy: str):
    left, keys = _sides(t)
    out = containment.match(left, keys, "p_brand", "item", "key", "o", policy)
    return out.select("p_partkey", "key", F.col("o").cast("bigint").alias("o"))


@query(_containment_sql("o"))
def containment_by_session(t):
    return _contained(t, "first")


@query(_containment_sql("NOT same, o"))
def containment_exact_by_session(t):
    return _contained(t, "exact")


@query(_containment_sql("NOT same, CASE WHEN same THEN 0 ELSE -score END, o", "same OR score > 0"))
def best_containment_by_session(t):
    return _contained(t, "best")


# ---- clusters: a frame is a brand and size, its ballots the parts

CLUSTER_ROWS = "SELECT p_partkey, p_brand, p_size, CASE WHEN p_partkey % 7 = 0 THEN split_part(p_name, ' ', 1) ELSE p_name END AS item, p_partkey * 13 % 17 AS score FROM part"
SEED = """list_filter(c.seeds, lambda x: x.t = s.item OR contains(x.t, s.item) OR contains(s.item, x.t))[1].o"""


@query(f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) AS k FROM ({CLUSTER_ROWS})),
  c AS (SELECT p_brand, p_size, p_partkey, score, k, p_partkey AS seed, [{{'o': p_partkey, 't': item}}] AS seeds FROM s WHERE k = 1
    UNION ALL SELECT s.p_brand, s.p_size, s.p_partkey, s.score, s.k, coalesce({SEED}, s.p_partkey),
      CASE WHEN {SEED} IS NULL THEN list_append(c.seeds, {{'o': s.p_partkey, 't': s.item}}) ELSE c.seeds END
    FROM c JOIN s ON s.p_brand = c.p_brand AND s.p_size = c.p_size AND s.k = c.k + 1)
  SELECT p_partkey FROM c QUALIFY row_number() OVER (PARTITION BY p_brand, p_size, seed ORDER BY score DESC, p_partkey) = 1""")
def best_of_clusters(t):
    item = F.when(F.col("p_partkey") % 7 == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.col("p_name"))
    rows = t("part").select("p_partkey", "p_brand", "p_size", item.alias("item"), (F.col("p_partkey") * 13 % 17).alias("score"))
    return clusters.keep_best_of_clusters(rows, ["p_brand", "p_size"], "item", "p_partkey", F.col("score")).select("p_partkey")


# ---- counters

PASS, FAIL = f"contains({OUT}, 'pass')", f"NOT contains({OUT}, 'pass') AND contains({OUT}, 'fail')"


@query(f"""WITH {C}, v AS (SELECT session_id, in_ord, count_if(choice = 'YES') > count_if(choice = 'NO') AS p FROM c GROUP BY 1, 2),
  n AS (SELECT b.session_id, count(*)::BIGINT AS total, count_if(coalesce(p, false))::BIGINT AS passed FROM b LEFT JOIN v USING (session_id, in_ord) GROUP BY 1),
  i AS (SELECT session_id, string_agg(coalesce(item_text, '-'), '|' ORDER BY in_ord) AS key_items FROM b WHERE in_ord <= 3 GROUP BY 1)
  SELECT session_id, total, passed, total - passed AS failed, key_items,
         concat('City Council meeting ', session_id, ' with ', total, ' votes recorded. ', passed, ' votes passed, ', total - passed, ' failed.') AS summary FROM n JOIN i USING (session_id)""")
def session_counters(t):
    out = choices.session_counters(ballots(t))
    text = choices.counters_text(F.col("session_id"), F.col("total"), F.col("passed"))
    return out.select("session_id", "total", "passed", "failed", F.array_join("key_items", "|", "-").alias("key_items"), text.alias("summary"))


FULL = f"SELECT session_id, count(*)::BIGINT AS total, count_if({PASS})::BIGINT AS passed, count_if({FAIL})::BIGINT AS failed FROM b GROUP BY 1"
EARLIER = "ballot_id IS NOT NULL AND frame_number IS NOT NULL"


@query(f"WITH {B} {FULL}")
def counters_by_delta(t):
    """Stored counters of the earlier ballots and the change by the others equal a full count."""
    rows, one = ballots(t), F.lit(1).alias("sign")
    stored = counters.session_delta(rows.where(EARLIER).select("*", one))
    delta = counters.session_delta(rows.where(f"NOT ({EARLIER})").select("*", one))
    return counters.applied(stored, delta, "session_id", ["total", "passed", "failed"])


@query(f"""WITH {C} SELECT member, count(*)::BIGINT AS total, count_if(choice = 'YES')::BIGINT AS yes, count_if(choice = 'NO')::BIGINT AS no, count_if(choice = 'ABSTAIN')::BIGINT AS abstain
  FROM c WHERE l_suppkey % 4 <> 0 GROUP BY 1""")
def member_counters_by_delta(t):
    """All ballots are stored; those with an estimated time are then taken away again."""
    rows = ballots(t)
    stored = counters.member_delta(rows.select("*", F.lit(1).alias("sign")))
    gone = counters.member_delta(rows.where("ts_estimated").select("*", F.lit(-1).alias("sign")))
    return counters.applied(stored, gone, "member", ["total", "yes", "no", "abstain"])


@query(f"""WITH {B}, f AS ({FULL}), e AS (SELECT session_id, count(*)::BIGINT AS total, count(*)::BIGINT AS passed, 0::BIGINT AS failed FROM b WHERE ballot_id IS NOT NULL GROUP BY 1)
  SELECT session_id, e.total <> f.total AS changed, f.total, CASE WHEN e.total <> f.total THEN f.passed ELSE e.passed END AS passed, CASE WHEN e.total <> f.total THEN f.failed ELSE e.failed END AS failed
  FROM e JOIN f USING (session_id)""")
def counters_refreshed(t):
    """Counters kept of the ballots with an id only, and with all of them as passed, beside a full count."""
    rows = ballots(t)
    stored = rows.where("ballot_id is not null").groupBy("session_id").agg(F.count(F.lit(1)).alias("total")).withColumns({"passed": F.col("total"), "failed": F.lit(0).cast("bigint")})
    return counters.refreshed(stored, counters.session_delta(rows.select("*", F.lit(1).alias("sign"))))


@query("""SELECT year(l_shipdate)::INTEGER AS year, count(DISTINCT l_partkey)::BIGINT AS members, true AS close FROM lineitem GROUP BY 1""")
def members_by_sketch(t):
    """Distinct members a year out of sketches kept by month, beside the exact numbers: within 7 per cent, four times the
    standard error."""
    rows = t("lineitem").select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), F.col("l_partkey").cast("bigint").alias("member"))
    rolled = counters.rolled_up(counters.sketches(rows, ["year", "month"], "member"), "year").withColumnRenamed("members", "guess")
    exact = rows.groupBy("year").agg(F.countDistinct("member").alias("members"))
    return exact.join(rolled, "year").select("year", "members", (F.abs(F.col("guess") - F.col("members")) <= 0.07 * F.col("members")).alias("close"))


# ---- aliases: a customer's alias is a customer with a smaller key

CHAIN = "CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 5 AND c_custkey % 4 = 1 THEN c_custkey - 5 ELSE c_custkey - 1 END"


@query(f"""WITH RECURSIVE a AS (SELECT c_custkey AS k, {CHAIN} AS up FROM customer), r AS (SELECT k, k AS root FROM a WHERE up IS NULL UNION ALL SELECT a.k, r.root FROM r JOIN a ON a.up = r.k)
  SELECT k::VARCHAR AS alias, root::VARCHAR AS canonical FROM r WHERE k <> root""")
def alias_closure(t):
    rows = t("customer").selectExpr("CAST(c_custkey AS STRING) AS alias", f"CAST({CHAIN} AS STRING) AS target", "1 AS priority")
    return aliases.closure(rows)


NAMES = [("bo", "ada", 1), ("cy", "bo", 1), ("cy", "di", 2), ("ed", "ed", 1)]
RENAMED = "CASE WHEN member IN ('bo', 'cy') THEN 'ada' ELSE member END"


def _names(t):
    return aliases.closure(t("region").sparkSession.createDataFrame(NAMES, "alias string, target string, priority int"))


@query(f"""WITH {C}, m AS (SELECT session_id, in_ord, {RENAMED} AS name, arg_max(choice, (member IN ('bo', 'cy'), member)) AS choice FROM c GROUP BY 1, 2, 3)
  SELECT session_id, in_ord, string_agg(concat(name, '=', choice), ',' ORDER BY name) AS choices FROM m GROUP BY 1, 2""")
def ballots_renamed(t):
    rows = ballots(t).where(F.size("choices") > 0)
    out = aliases.ballots_renamed(rows, _names(t), ["session_id", "in_ord"])
    return out.select("session_id", "in_ord", choices.entries_text(F.col("choices")).alias("choices"))


@query(f"WITH {C} SELECT {RENAMED} AS member, count(*)::BIGINT AS total, count_if(choice = 'YES')::BIGINT AS yes FROM c GROUP BY 1")
def stats_renamed(t):
    stats = counters.member_delta(ballots(t).select("*", F.lit(1).alias("sign"))).select("member", "total", "yes")
    return aliases.stats_renamed(stats, _names(t))


# ---- the import: ballots with a frame image are new, the others are there already

IS_NEW = "l_suppkey % 2 = 0"


def _new_sessions(t):
    date = F.when(F.col("o_orderkey") % 6 == 0, "").when(F.col("o_orderkey") % 6 == 1, tm.NO_DATE).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t("orders").where("o_orderkey % 4 < 3").select(F.col("o_orderkey").cast("string").alias("session_id"), F.lit("new").alias("title"), date.alias("date"))


def _old_sessions(t):
    return t("orders").where("o_orderkey % 4 > 1").select(F.col("o_orderkey").cast("string").alias("session_id"), F.lit("old").alias("title"), F.lit(None).cast("string").alias("date"))


def _imported(t):
    rows = ballots(t)
    is_new = F.col("frame_path").isNotNull()
    return importing.run_import(rows.where(is_new), _new_sessions(t), rows.where(~is_new), _old_sessions(t))


OFFSET = """CASE WHEN coalesce(item_text, '') = '' THEN 0 WHEN contains(lower(item_text), 'consent') THEN 300 WHEN contains(lower(item_text), 'public hearing') THEN 1800
  WHEN contains(lower(item_text), 'adjournment') THEN 3600 WHEN contains(lower(item_text), 'resolution') THEN 1200 WHEN contains(lower(item_text), 'ordinance') THEN 1500 ELSE 900 END"""


@query(f"""WITH {B}, i AS (SELECT *, coalesce(ballot_id, concat(session_id, '_', coalesce(item_text, 'None'))) AS id, coalesce(frame_number, 0) AS f,
         row_number() OVER (PARTITION BY session_id, item_text ORDER BY coalesce(frame_number, 0), in_ord) AS rn,
         coalesce(marker_id, '') = '' AND l_orderkey % 4 < 3 AS needs FROM b WHERE {IS_NEW})
  SELECT id AS ballot_id, session_id, item_text, CAST(f AS INTEGER) AS frame_number, CASE WHEN needs THEN concat(session_id, lpad(CAST(f AS VARCHAR), 4, '0')) ELSE marker_id END AS marker_id,
         CASE WHEN needs THEN f * 30 + {OFFSET} ELSE video_ts END::BIGINT AS video_ts, needs OR coalesce(ts_estimated, true) AS ts_estimated FROM i WHERE rn = 1
  UNION ALL SELECT ballot_id, session_id, item_text, CAST(frame_number AS INTEGER), marker_id, video_ts::BIGINT, ts_estimated FROM b WHERE NOT ({IS_NEW})""")
def import_ballots(t):
    return _imported(t).ballots.select("ballot_id", "session_id", "item_text", "frame_number", "marker_id", "video_ts", "ts_estimated")


MADE = """(WITH x AS (SELECT CASE WHEN starts_with(id, '15') THEN 2025 ELSE 2024 END AS y, CASE WHEN starts_with(id, '15') THEN 490 ELSE 243 END AS k,
    TRY_CAST(CASE WHEN id LIKE '14%' OR id LIKE '15%' THEN substr(id, 3) ELSE id END AS BIGINT) AS n)
  SELECT CASE WHEN n IS NULL THEN concat(y, '-01-01') ELSE concat(y, '-', lpad(CAST(((n - k) % 12 + 12) % 12 + 1 AS VARCHAR), 2, '0'), '-', lpad(CAST(((n - k) % 28 + 28) % 28 + 1 AS VARCHAR), 2, '0')) END FROM x)"""


@query(f"""WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
  SELECT id AS session_id, 'new' AS title, CASE WHEN k % 6 < 2 THEN {MADE} ELSE d END AS date FROM o WHERE k % 4 < 3
  UNION ALL SELECT id, 'old', NULL FROM o WHERE k % 4 = 3""")
def import_sessions(t):
    return _imported(t).sessions.select("session_id", "title", "date")


@query(f"""WITH {C}, m AS (SELECT session_id, item_text, member, arg_max(choice, in_ord) AS choice FROM c WHERE {IS_NEW} GROUP BY 1, 2, 3),
  u AS (SELECT member, choice FROM m UNION ALL SELECT member, choice FROM c WHERE NOT ({IS_NEW}))
  SELECT member, count(*)::BIGINT AS total, count_if(choice = 'YES')::BIGINT AS yes, count_if(choice = 'NO')::BIGINT AS no, count_if(choice = 'ABSTAIN')::BIGINT AS abstain FROM u GROUP BY 1""")
def import_member_stats(t):
    return _imported(t).member_stats


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'Date not available' WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%B %-d, %Y')
  ELSE concat(strftime(o_orderdate, '%B %-d, %Y'), ' at ', CASE WHEN o_orderkey % 24 % 12 = 0 THEN 12 ELSE o_orderkey % 24 % 12 END, ':', lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0'), CASE WHEN o_orderkey % 24 < 12 THEN ' AM PST' ELSE ' PM PST' END) END AS label FROM orders""")
def meeting_labels(t):
    date = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    clock = F.when(F.col("o_orderkey") % 5 != 0, F.concat_ws(":", F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")))
    return t("orders").select("o_orderkey", tm.meeting_label(date, clock).alias("label"))


# ---- a run over a catalog: a session is a source, a frame a document

FRAME_TEXT = "concat(text, CASE doc_id % 5 WHEN 0 THEN ' Voting results yea | 7| nay | 2' WHEN 1 THEN ' ayes: 4' ELSE '' END)"
HAS = "regexp_matches(lower(raw), 'voting results|yea|nay|abstain|recuse|motion|resolution|ordinance|passes|fails')"
TOLD = r"regexp_matches(lower(raw), '\b(?:yea|yeas|aye|ayes|nay|nays|no|noes)\b[^0-9a-z]*[0-9]+')"


@query(f"""WITH f AS (SELECT coalesce(source, 'none') AS session_id, {FRAME_TEXT} AS raw FROM documents)
  SELECT session_id, count(*)::BIGINT AS frames, count(raw)::BIGINT AS candidates, count_if({HAS})::BIGINT AS flagged, count_if({HAS} AND {TOLD})::BIGINT AS ballots FROM f GROUP BY 1""")
def catalog_run_results(t):
    """The run is made in two parts: the second takes up what the first left."""
    frames = t("documents").selectExpr("coalesce(source, 'none') AS session_id", f"{FRAME_TEXT} AS raw_text")
    catalog = frames.select("session_id").distinct().withColumn("place", F.xxhash64("session_id"))
    sink = f"{shared_folder(frames.sparkSession)}/catalog-run-{uuid.uuid4().hex}"
    catalog_run.run(catalog, frames, catalog_run.Run(sink, max_sessions=2))
    return catalog_run.run(catalog, frames, catalog_run.Run(sink)).drop("place")
