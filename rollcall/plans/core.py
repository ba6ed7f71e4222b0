"""Queries over the driver's tables, one for each operator group, each with its SQL.

Roles: a session is an order, a ballot a line item or an event, a member a supplier or a user, an outcome an order
status, an item a part name or a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.functions import text as tx
from rollcall.functions import times as tm
from rollcall.operators import clusters, dedupe, linkage, reconcile

from rollcall.shared import shared_folder

from .registry import LINE, ORACLES, QUERIES, count_if, n, query

# ---- filters, pages, projections


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_name, o_orderstatus FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  WHERE contains(lower(p_name), 'a') AND o_orderstatus = 'F' ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 50 OFFSET 20""")
def ballot_filter_page(t):
    rows = t("lineitem").join(t("part").where(F.contains(F.lower("p_name"), F.lit("a"))), F.col("l_partkey") == F.col("p_partkey")).join(t("orders").where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.orderBy("l_orderkey", "l_linenumber", *LINE).offset(20).limit(50).select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "o_orderstatus")


@query("""SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events WHERE contains(CAST(user_id AS VARCHAR), '12')""")
def member_filter_exists(t):
    some = t("events").where(F.contains(F.col("user_id").cast("string"), F.lit("12")))
    return some.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).distinct()


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'tion') OR contains(lower(source), 'src1')""")
def text_search_any_field(t):
    return t("documents").where(F.contains(F.lower("text"), F.lit("tion")) | F.contains(F.lower("source"), F.lit("src1"))).select("doc_id")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7")
def point_lookup(t):
    return t("orders").where("o_orderkey = 7").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%' AND coalesce(TRY_CAST(substr(p_brand, 7) AS INTEGER) BETWEEN 10 AND 14, false)""")
def prefix_and_range(t):
    return t("part").where(F.startswith("p_brand", F.lit("Brand#1")) & F.expr("coalesce(try_cast(substr(p_brand, 7) as int) between 10 and 14, false)")).select("p_partkey", "p_brand")


@query("""SELECT doc_id, f AS has_indicators, CASE WHEN f THEN 0.9 ELSE 0.3 END::DOUBLE AS confidence FROM
  (SELECT doc_id, contains(lower(text), 'vote') OR contains(lower(text), 'nay') OR contains(lower(text), 'abst') OR contains(lower(text), 'thes') AS f FROM documents)""")
def contains_any_filter(t):
    f = tx.contains_any(F.lower("text"), ("vote", "nay", "abst", "thes"))
    return t("documents").select("doc_id", f.alias("has_indicators")).withColumn("confidence", F.when(F.col("has_indicators"), F.lit(0.9)).otherwise(0.3).cast("double"))


@query("""SELECT doc_id FROM documents WHERE length(text) <= 60 OR text LIKE '%...' OR text IN ('None', '')""")
def truncated_filter(t):
    return t("documents").where((F.length("text") <= 60) | F.endswith("text", F.lit("...")) | F.col("text").isin("None", "")).select("doc_id")


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40)""")
def anti_id_removal(t):
    return t("orders").join(t("lineitem").where("l_quantity > 40"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND year(l_shipdate) = 1995)""")
def semi_sessions_with_ballots(t):
    return t("orders").join(t("lineitem").where(F.year("l_shipdate") == 1995), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("""SELECT event_id, concat(user_id, '_', event_id) AS ballot_id, concat('https://example.org/clip/', user_id) AS url,
  lower(regexp_replace(event_type, '[ \\t]+', '_', 'g')) AS slug, printf('votable_frames_%d/frame_%06d.jpg', user_id, event_id) AS frame_path FROM events""")
def derived_fields(t):
    u, e = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    return t("events").select(
        "event_id", F.concat_ws("_", u, e).alias("ballot_id"), F.concat(F.lit("https://example.org/clip/"), u).alias("url"),
        F.lower(F.regexp_replace("event_type", "[ \\t]+", "_")).alias("slug"), F.format_string("votable_frames_%d/frame_%06d.jpg", "user_id", "event_id").alias("frame_path"),
    )


@query("""SELECT doc_id, regexp_matches(concat(source, '@example.org'), '^[^ @]+@[^ @]+[.][^ @]+$') AS valid FROM documents""")
def email_validity(t):
    return t("documents").select("doc_id", F.concat("source", F.lit("@example.org")).rlike(r"^[^ @]+@[^ @]+[.][^ @]+$").alias("valid"))


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-03-01'""")
def date_range_filter(t):
    return t("orders").where("o_orderdate >= timestamp_ntz'1995-01-01' and o_orderdate < timestamp_ntz'1995-03-01'").select("o_orderkey", "o_orderdate")


# ---- joins


@query("""SELECT o_orderkey, coalesce(c, 0)::BIGINT AS n FROM orders LEFT JOIN (SELECT l_orderkey, count(*) c FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def left_default_counts(t):
    counts = t("lineitem").groupBy("l_orderkey").agg(n().alias("c"))
    return t("orders").join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("c", F.lit(0)).cast("bigint").alias("n"))


@query("""WITH b AS (SELECT l_orderkey k, l_linenumber f, l_returnflag v FROM lineitem WHERE l_quantity > 25
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, coalesce(v, l_returnflag) AS choice FROM lineitem LEFT JOIN b ON l_orderkey = k AND l_linenumber = f""")
def composite_equi_overwrite(t):
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*[F.col(c).desc() for c in LINE])
    b = t("lineitem").where("l_quantity > 25").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("v"))
    return t("lineitem").join(b, ["l_orderkey", "l_linenumber"], "left").select("l_orderkey", "l_linenumber", *LINE, F.coalesce("v", "l_returnflag").alias("choice"))


EVENT_SECONDS = "CAST(epoch(date_trunc('second', ts)) AS BIGINT)"


@query(f"""WITH l AS (SELECT event_id a, user_id u, {EVENT_SECONDS} s FROM events WHERE event_type = 'error'), r AS (SELECT event_id b, user_id u, {EVENT_SECONDS} s FROM events WHERE event_type = 'click')
  SELECT a, b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY CASE WHEN l.s = r.s THEN 0 ELSE 1 END, b) rn FROM l JOIN r ON l.u = r.u AND abs(l.s - r.s) <= 3600) WHERE rn = 1""")
def band_join_first(t):
    e = t("events").select("event_id", "user_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s"))
    left = e.where("event_type = 'error'").select(F.col("event_id").alias("a"), "user_id", F.col("s").alias("ls"))
    right = e.where("event_type = 'click'").select(F.col("event_id").alias("b"), "user_id", F.col("s").alias("rs"))
    return linkage.band_join(left, right, "user_id", "ls", "rs", 3600, "a", "b").select("a", "b")


KEYS = [(0, "economy"), (1, "standard anodized"), (2, "promo"), (3, "sm"), (4, "large brushed steel items"), (5, "a")]
KEY_SQL = "k(o, key) AS (VALUES " + ", ".join(f"({o}, '{k}')" for o, k in KEYS) + ")"


def seeds(t):
    return t("region").sparkSession.createDataFrame(KEYS, "o int, key string")


@query(f"""WITH {KEY_SQL} SELECT p_partkey, key FROM (SELECT p_partkey, key, row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN lower(p_type) = key THEN 0 ELSE 1 END, o) rn
  FROM part, k WHERE lower(p_type) = key OR (contains(concat(p_type, '. x'), '.') AND starts_with(key, lower(trim(split_part(p_type, '.', 1)))))) WHERE rn = 1""")
def prefix_join(t):
    found = linkage.prefix_join(t("part").withColumn("item", F.concat("p_type", F.lit(". x"))), seeds(t), "item", "key", "p_partkey", "o")
    return found.select("p_partkey", "key")


def _containment(first: str) -> str:
    return f"""WITH {KEY_SQL} SELECT p_partkey, key FROM (SELECT p_partkey, key, row_number() OVER (PARTITION BY p_partkey ORDER BY {first} o) rn
      FROM part, k WHERE contains(lower(p_type), key) OR contains(key, lower(p_type))) WHERE rn = 1"""


@query(_containment(""))
def containment_join(t):
    return linkage.containment_join(t("part"), seeds(t), "p_type", "key", "p_partkey", "o").select("p_partkey", "key")


@query(_containment("CASE WHEN lower(p_type) = key THEN 0 ELSE 1 END,"))
def containment_join_exact(t):
    return linkage.containment_join(t("part"), seeds(t), "p_type", "key", "p_partkey", "o", exact_first=True).select("p_partkey", "key")


OVERLAP_WORDS = "unnest(list_distinct(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '))) w"


@query(f"""WITH d AS (SELECT doc_id, {OVERLAP_WORDS} FROM documents), b AS (SELECT item_id, {OVERLAP_WORDS} FROM benchmark)
  SELECT doc_id, item_id, score FROM (SELECT doc_id, item_id, count(*)::BIGINT score, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, item_id) rn
    FROM d JOIN b ON d.w = b.w AND d.w <> '' GROUP BY 1, 2 HAVING count(*) >= 5) WHERE rn = 1""")
def overlap_join(t):
    return linkage.overlap_join(t("documents"), t("benchmark"), "text", "text", "doc_id", "item_id", 5)


@query("""SELECT n_nationkey, n_name, coalesce(r_name, 'UNKNOWN') AS region FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey""")
def lookup_default(t):
    r = t("region").where("r_regionkey < 3")
    return t("nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", F.coalesce("r_name", F.lit("UNKNOWN")).alias("region"))


@query("""SELECT c_custkey, CASE WHEN contains(lower(c_mktsegment), 'auto') THEN 'A' WHEN contains(lower(c_mktsegment), 'build') THEN 'B' WHEN contains(lower(c_mktsegment), 'm') THEN 'M' ELSE 'X' END AS alias FROM customer""")
def alias_case(t):
    s = F.lower("c_mktsegment")
    has = lambda w: F.contains(s, F.lit(w))
    return t("customer").select("c_custkey", F.when(has("auto"), "A").when(has("build"), "B").when(has("m"), "M").otherwise("X").alias("alias"))


# ---- aggregates


@query("""SELECT o_orderpriority, count(*)::BIGINT AS n, count_if(o_orderstatus = 'F')::BIGINT AS passed, count_if(o_orderstatus = 'O')::BIGINT AS failed,
  count_if(o_orderstatus <> 'F')::BIGINT AS not_passed, count_if(starts_with(lower(o_orderstatus), 'p'))::BIGINT AS by_prefix FROM orders GROUP BY 1""")
def outcome_counts_3way(t):
    s = F.col("o_orderstatus")
    return t("orders").groupBy("o_orderpriority").agg(n().alias("n"), count_if(s == "F").alias("passed"), count_if(s == "O").alias("failed"), count_if(s != "F").alias("not_passed"), count_if(F.startswith(F.lower(s), F.lit("p"))).alias("by_prefix"))


@query("""SELECT l_orderkey, count(*)::BIGINT AS total, count_if(l_returnflag = 'R')::BIGINT AS passed, count_if(l_returnflag = 'N')::BIGINT AS failed FROM lineitem GROUP BY 1""")
def session_rollup(t):
    return t("lineitem").groupBy("l_orderkey").agg(n().alias("total"), count_if(F.col("l_returnflag") == "R").alias("passed"), count_if(F.col("l_returnflag") == "N").alias("failed"))


@query("""SELECT s_suppkey, s_name, coalesce(total, 0)::BIGINT AS total, coalesce(yes, 0)::BIGINT AS yes, coalesce(no, 0)::BIGINT AS no, coalesce(abstain, 0)::BIGINT AS abstain FROM supplier LEFT JOIN
  (SELECT l_suppkey, count(*) total, count_if(l_returnflag = 'R') yes, count_if(l_returnflag = 'N') no, count_if(l_returnflag = 'A') abstain FROM lineitem WHERE l_quantity > 49 GROUP BY 1) ON s_suppkey = l_suppkey""")
def member_stats(t):
    f = F.col("l_returnflag")
    stats = t("lineitem").where("l_quantity > 49").groupBy("l_suppkey").agg(n().alias("total"), count_if(f == "R").alias("yes"), count_if(f == "N").alias("no"), count_if(f == "A").alias("abstain"))
    return t("supplier").join(stats, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", "s_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "yes", "no", "abstain")])


@query("SELECT event_type, count(DISTINCT user_id)::BIGINT AS members FROM events GROUP BY 1")
def roster_distinct(t):
    return t("events").groupBy("event_type").agg(F.countDistinct("user_id").cast("bigint").alias("members"))


@query("""SELECT l_orderkey, ayes, noes, abstentions, CASE WHEN ayes > noes THEN 'Passes' WHEN ayes < noes THEN 'Fails' ELSE 'Tie' END AS outcome FROM
  (SELECT l_orderkey, count_if(l_returnflag = 'R')::BIGINT ayes, count_if(l_returnflag = 'N')::BIGINT noes, count_if(l_returnflag = 'A')::BIGINT abstentions FROM lineitem GROUP BY 1)""")
def tally_from_choices(t):
    f = F.col("l_returnflag")
    return t("lineitem").groupBy("l_orderkey").agg(count_if(f == "R").alias("ayes"), count_if(f == "N").alias("noes"), count_if(f == "A").alias("abstentions")).withColumn("outcome", reconcile.outcome(F.col("ayes"), F.col("noes")))


@query("""SELECT coalesce(nullif(p_type, 'PROMO'), 'Unknown') AS item, count(*)::BIGINT AS total, count_if(l_returnflag = 'R')::BIGINT AS passed FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def item_rollup_unknown(t):
    item = F.coalesce(F.nullif("p_type", F.lit("PROMO")), F.lit("Unknown"))
    return t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(item.alias("item")).agg(n().alias("total"), count_if(F.col("l_returnflag") == "R").alias("passed"))


@query("""SELECT o_orderpriority, concat(x // 10, '.', x % 10, '%') AS pct FROM (SELECT o_orderpriority, CAST((2000 * count_if(o_orderstatus = 'F') + count(*)) // (2 * count(*)) AS BIGINT) x FROM orders GROUP BY 1)""")
def pct_format(t):
    g = t("orders").groupBy("o_orderpriority").agg(count_if(F.col("o_orderstatus") == "F").alias("p"), n().alias("c"))
    return g.select("o_orderpriority", tx.percent(F.col("p"), F.col("c")).alias("pct"))


@query("""SELECT year(o_orderdate)::BIGINT AS year, count(DISTINCT o_custkey)::BIGINT AS sessions, count(*)::BIGINT AS ballots, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY 1""")
def year_rollup(t):
    return t("orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(F.countDistinct("o_custkey").cast("bigint").alias("sessions"), n().alias("ballots"), F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderstatus, count(*)::BIGINT AS n, grouping(year(o_orderdate), o_orderstatus)::BIGINT AS level FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus)""")
def year_status_rollup(t):
    o = t("orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    return o.rollup("year", "o_orderstatus").agg(n().alias("n"), F.grouping_id().cast("bigint").alias("level"))


@query("""SELECT event_type, arg_max(user_id, (c, -user_id)) AS member FROM (SELECT event_type, user_id, count(*) c FROM events GROUP BY 1, 2) GROUP BY 1""")
def argmax_member(t):
    g = t("events").groupBy("event_type", "user_id").agg(n().alias("c"))
    return g.groupBy("event_type").agg(F.max_by("user_id", F.struct("c", -F.col("user_id"))).alias("member"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS frames, count_if(event_type = 'error')::BIGINT AS flagged, max(event_id) AS last_id, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def run_rollup(t):
    return t("events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(n().alias("frames"), count_if(F.col("event_type") == "error").alias("flagged"), F.max("event_id").alias("last_id"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT (SELECT count(*) FROM lineitem)::BIGINT AS ballots, (SELECT count(*) FROM orders)::BIGINT AS sessions, (SELECT count(*) FROM supplier)::BIGINT AS members, (SELECT count_if(o_orderstatus = 'F') FROM orders)::BIGINT AS passed""")
def statistics(t):
    orders = t("orders").agg(n().alias("sessions"), count_if(F.col("o_orderstatus") == "F").alias("passed"))
    one = t("lineitem").agg(n().alias("ballots")).crossJoin(orders).crossJoin(t("supplier").agg(n().alias("members")))  # three single rows
    return one.select("ballots", "sessions", "members", "passed")


@query("""SELECT count(*)::BIGINT AS total, count_if(p_name IS NOT NULL AND NOT contains(p_name, 'Not available'))::BIGINT AS with_item, count_if(len(string_split(p_name, ' ')) > 2)::BIGINT AS detailed FROM part""")
def completeness(t):
    return t("part").agg(n().alias("total"), count_if(F.col("p_name").isNotNull() & ~F.contains("p_name", F.lit("Not available"))).alias("with_item"), count_if(F.size(F.split("p_name", " ")) > 2).alias("detailed"))


# ---- merges and keep-best


@query("""SELECT l_orderkey, l_returnflag, min(l_linenumber)::BIGINT AS frame, count(*)::BIGINT AS merged,
  string_agg(concat(l_suppkey, ':', l_partkey), ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ids FROM lineitem GROUP BY 1, 2""")
def consolidate_group(t):
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", *LINE)))
    g = t("lineitem").groupBy("l_orderkey", "l_returnflag").agg(rows.alias("r"))
    return g.select("l_orderkey", "l_returnflag", F.col("r")[0]["l_linenumber"].cast("bigint").alias("frame"), F.size("r").cast("bigint").alias("merged"), F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["l_suppkey"].cast("string"), x["l_partkey"].cast("string"))), ",").alias("ids"))


@query("""SELECT l_orderkey, l_partkey % 3 AS item, min(nullif(l_linenumber, 1))::BIGINT AS frame, arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) FILTER (l_returnflag <> 'N') AS marker, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2""")
def consolidate_list(t):
    marked = F.when(F.col("l_returnflag") != "N", F.struct("l_linenumber", *LINE))
    return t("lineitem").groupBy("l_orderkey", (F.col("l_partkey") % 3).alias("item")).agg(F.min(F.nullif("l_linenumber", F.lit(1))).cast("bigint").alias("frame"), F.min(marked)["l_suppkey"].alias("marker"), n().alias("n"))


SCORE_SQL = "(CASE WHEN l_returnflag = 'R' THEN 50 WHEN l_returnflag = 'N' THEN -50 ELSE 0 END + 2 * l_linenumber + CASE WHEN l_discount > 0.05 THEN 10 ELSE 0 END)"


def line_score():
    return F.when(F.col("l_returnflag") == "R", 50).when(F.col("l_returnflag") == "N", -50).otherwise(0) + 2 * F.col("l_linenumber") + F.when(F.col("l_discount") > 0.05, 10).otherwise(0)


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {SCORE_SQL} DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""")
def keep_best_exact(t):
    return dedupe.keep_best(t("lineitem"), ["l_orderkey"], line_score(), ["l_linenumber", *LINE]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SCORE_SQL} DESC, l_partkey, l_suppkey, l_extendedprice) = 1""")
def keep_best_frame(t):
    return dedupe.keep_best(t("lineitem"), ["l_orderkey", "l_linenumber"], line_score(), LINE).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


NORM_SQL = "trim(regexp_replace(lower(text), '[ \\t\\n]+', ' ', 'g'))"


@query(f"""SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source, md5({NORM_SQL}) ORDER BY length(text) DESC, doc_id) = 1""")
def keep_best_normalized(t):
    key = F.md5(F.trim(F.regexp_replace(F.lower("text"), "[ \\t\\n]+", " ")).cast("binary"))
    return dedupe.keep_best(t("documents").withColumn("k", key), ["source", "k"], F.length("text"), ["doc_id"]).select("doc_id")


@query(f"""WITH r AS (SELECT *, {SCORE_SQL} s FROM lineitem JOIN part ON l_partkey = p_partkey),
  b AS (SELECT l_orderkey, l_returnflag, arg_max(p_name, (length(p_name), -l_linenumber, -l_partkey, -l_suppkey)) longest FROM r GROUP BY 1, 2)
  SELECT r.l_orderkey, r.l_returnflag, r.l_linenumber, longest AS item FROM r JOIN b ON r.l_orderkey = b.l_orderkey AND r.l_returnflag = b.l_returnflag
  QUALIFY row_number() OVER (PARTITION BY r.l_orderkey, r.l_returnflag ORDER BY s DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""")
def carry_longest(t):
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return dedupe.carry_longest(rows, ["l_orderkey", "l_returnflag"], "p_name", line_score(), ["l_linenumber", *LINE]).select("l_orderkey", "l_returnflag", "l_linenumber", F.col("p_name").alias("item"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, l_quantity < 10 AS o, sum(CASE WHEN l_quantity < 10 THEN 0 ELSE 1 END) OVER (PARTITION BY l_orderkey, l_linenumber) AS k FROM lineitem) WHERE NOT o OR k = 0""")
def conditional_group_drop(t):
    return dedupe.drop_obvious(t("lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_quantity") < 10).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_partkey) <> 2""")
def second_longest_drop(t):
    return t("part").withColumn("rn", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.length("p_name").desc(), "p_partkey"))).where("rn <> 2").select("p_partkey")


@query(f"""WITH RECURSIVE e AS (SELECT user_id % 7 AS g, event_id, {EVENT_SECONDS} s, value v, row_number() OVER (PARTITION BY user_id % 7 ORDER BY {EVENT_SECONDS}, event_id) rn FROM events),
  f AS (SELECT g, rn, event_id, s, v, false AS gone, CAST(NULL AS BIGINT) AS killed FROM e WHERE rn = 1 UNION ALL
    SELECT e.g, e.rn, e.event_id, e.s, e.v, (NOT f.gone AND e.s - f.s <= 60 AND NOT f.v < e.v), CASE WHEN NOT f.gone AND e.s - f.s <= 60 AND f.v < e.v THEN f.event_id END FROM f JOIN e ON e.g = f.g AND e.rn = f.rn + 1)
  SELECT g, event_id FROM f WHERE NOT gone AND event_id NOT IN (SELECT killed FROM f WHERE killed IS NOT NULL)""")
def adjacent_fold(t):
    e = t("events").select((F.col("user_id") % 7).alias("g"), "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s"), F.col("value").alias("v"))
    return dedupe.adjacent_fold(e, ["g"], "s", "v", "event_id", 60).select("g", "event_id")


FREE = """list_filter(c.seeds, lambda x: x.t = coalesce(s.p_name, '') OR (x.t <> '' AND s.p_name <> '' AND (contains(x.t, s.p_name) OR contains(s.p_name, x.t))))[1].o"""


@query(f"""WITH RECURSIVE r AS (SELECT DISTINCT l_orderkey, l_linenumber, p_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
  s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY p_partkey) AS k FROM r),
  c AS (SELECT l_orderkey, l_linenumber, p_partkey, p_name, k, p_partkey AS seed, [{{'o': p_partkey, 't': coalesce(p_name, '')}}] AS seeds FROM s WHERE k = 1
    UNION ALL SELECT s.l_orderkey, s.l_linenumber, s.p_partkey, s.p_name, s.k, coalesce({FREE}, s.p_partkey),
      CASE WHEN {FREE} IS NULL THEN list_append(c.seeds, {{'o': s.p_partkey, 't': coalesce(s.p_name, '')}}) ELSE c.seeds END
    FROM c JOIN s ON s.l_orderkey = c.l_orderkey AND s.l_linenumber = c.l_linenumber AND s.k = c.k + 1)
  SELECT l_orderkey, l_linenumber, p_partkey, p_name, CAST(seed AS BIGINT) AS seed FROM c""")
def seed_cluster(t):
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_partkey", "p_name").distinct()
    return clusters.seed_clusters(rows, ["l_orderkey", "l_linenumber"], "p_name", "p_partkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey >= coalesce((SELECT min(o_orderkey) FROM orders WHERE o_custkey = 5), 0)")
def resume_from(t):
    start = t("orders").where("o_custkey = 5").agg(F.coalesce(F.min("o_orderkey"), F.lit(0)).alias("s"))
    return t("orders").join(F.broadcast(start), F.col("o_orderkey") >= F.col("s")).select("o_orderkey")  # one row


# ---- order, sets


@query("""SELECT o_orderkey, l_linenumber, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(l_linenumber, 0), o_orderkey, coalesce(l_partkey, 0), coalesce(l_suppkey, 0), coalesce(l_extendedprice, 0))::BIGINT AS place FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def order_null_as_zero(t):
    rows = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    w = Window.partitionBy("o_custkey").orderBy(zero("l_linenumber"), "o_orderkey", *[zero(c) for c in LINE])
    return rows.select("o_orderkey", "l_linenumber", F.row_number().over(w).cast("bigint").alias("place"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 200000")
def union_all_overlap(t):
    return t("orders").where("o_orderstatus = 'F'").select("o_orderkey").unionByName(t("orders").where("o_totalprice > 200000").select("o_orderkey"))


@query("""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(b.v, a.v) AS v FROM (SELECT o_orderkey, o_orderstatus v FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT o_orderkey, o_orderpriority v FROM orders WHERE o_orderkey % 2 = 0) b ON a.o_orderkey = b.o_orderkey""")
def map_merge_right_wins(t):
    a = t("orders").where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("a"))
    b = t("orders").where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderpriority").alias("b"))
    return a.join(b, "o_orderkey", "full").select("o_orderkey", F.coalesce("b", "a").alias("v"))


@query("""SELECT s_name FROM supplier UNION ALL SELECT x FROM (VALUES ('Supplier#new'), ('Supplier#000000001')) v(x) WHERE x NOT IN (SELECT s_name FROM supplier)""")
def set_insert_absent(t):
    new = t("supplier").sparkSession.createDataFrame([("Supplier#new",), ("Supplier#000000001",)], "s_name string")
    own = t("supplier").select("s_name")
    return own.unionByName(new.join(own, "s_name", "left_anti"))


@query("""SELECT item_id, len(list_intersect(list_distinct(string_split(lower(text), ' ')), ['the', 'of', 'and', 'to']))::BIGINT AS common FROM benchmark""")
def word_intersection(t):
    words = F.array_distinct(F.split(F.lower("text"), " "))
    return t("benchmark").select("item_id", F.size(F.array_intersect(words, F.array(*map(F.lit, ("the", "of", "and", "to"))))).cast("bigint").alias("common"))


# ---- text and time

# items: part names with the decorations that the normalisers remove, by key
ITEM_SQL = "SELECT p_partkey, concat(CASE p_partkey % 6 WHEN 0 THEN 'Item 12: ' WHEN 1 THEN 'No. 3 ' WHEN 2 THEN '7A. ' WHEN 3 THEN 'Consent Calendar ' WHEN 4 THEN 'b. Motion to Adjourn  ' ELSE '' END, p_name, CASE p_partkey % 4 WHEN 0 THEN ' (For Adoption Only)' WHEN 1 THEN ' Expenditure: $1,200' WHEN 2 THEN ' (see note) ' ELSE '' END) AS x FROM part"


def items(t):
    head = "CASE p_partkey % 6 WHEN 0 THEN 'Item 12: ' WHEN 1 THEN 'No. 3 ' WHEN 2 THEN '7A. ' WHEN 3 THEN 'Consent Calendar ' WHEN 4 THEN 'b. Motion to Adjourn  ' ELSE '' END"
    tail = "CASE p_partkey % 4 WHEN 0 THEN ' (For Adoption Only)' WHEN 1 THEN ' Expenditure: $1,200' WHEN 2 THEN ' (see note) ' ELSE '' END"
    return t("part").selectExpr("p_partkey", f"concat({head}, p_name, {tail}) AS x")


@query(f"SELECT p_partkey, trim(split_part(x, '.', 1)) AS number FROM ({ITEM_SQL})")
def item_number(t):
    return items(t).select("p_partkey", tx.item_number(F.col("x")).alias("number"))


@query("""SELECT page_id, regexp_extract(html, 'href="([^"]*)"', 1) AS first_link, len(regexp_extract_all(html, 'href="([^"]*)"', 1))::BIGINT AS links FROM pages""")
def html_markers(t):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return t("pages").select("page_id", F.regexp_extract("html", 'href="([^"]*)"', 1).alias("first_link"), F.size(links).cast("bigint").alias("links"))


@query("""SELECT o_orderkey, coalesce(nullif(regexp_extract(x, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}', 0), ''), nullif(regexp_extract(x, '[0-9]{4}-[0-9]{2}-[0-9]{2}', 0), ''), nullif(regexp_extract(x, '[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}', 0), '')) AS found
  FROM (SELECT o_orderkey, concat('held ', CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%B %d, %Y') END, '.') x FROM orders)""")
def date_patterns(t):
    d = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "MMMM dd, yyyy"))
    x = F.concat(F.lit("held "), d, F.lit("."))
    found = [F.nullif(F.regexp_extract(x, p, 0), F.lit("")) for p in ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}")]
    return t("orders").select("o_orderkey", F.coalesce(*found).alias("found"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(regexp_extract(concat('```json ', props, ' ```'), '\\{.*\\}', 0), '$.k') AS BIGINT) AS fenced FROM events""")
def json_parse_validate(t):
    fenced = F.regexp_extract(F.concat(F.lit("```json "), "props", F.lit(" ```")), r"(?s)\{.*\}", 0)
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.from_json(fenced, "k bigint")["k"].alias("fenced"))


@query("""SELECT item_id, regexp_replace(concat('see [', substr(text, 1, 10), '](http://a/', item_id, ')'), '\\[([^\\]]+)\\]\\(([^)]+)\\)', '<a href="\\2">\\1</a>', 'g') AS link,
  concat('"', replace(concat('a "b" ', item_id), '"', '""'), '"') AS quoted, CASE WHEN length(text) > 60 THEN concat(substr(text, 1, 60), '...') ELSE text END AS short FROM benchmark""")
def display_text(t):
    i = F.col("item_id").cast("string")
    md = F.concat(F.lit("see ["), F.substring("text", 1, 10), F.lit("](http://a/"), i, F.lit(")"))
    return t("benchmark").select("item_id", tx.markdown_links(md).alias("link"), tx.csv_quote(F.concat(F.lit('a "b" '), i)).alias("quoted"), tx.truncate(F.col("text"), 60).alias("short"))


@query("""SELECT o_orderkey, concat_ws(' ', concat('Session ', o_orderkey, '.'), CASE WHEN n > 0 THEN concat(n, ' ballots.') END, CASE WHEN o_orderstatus = 'F' THEN 'Approved.' WHEN o_orderstatus = 'O' THEN 'Rejected.' END) AS report
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def report_text(t):
    rows = t("orders").join(t("lineitem").groupBy("l_orderkey").agg(n().alias("n")), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    said = F.when(F.col("o_orderstatus") == "F", "Approved.").when(F.col("o_orderstatus") == "O", "Rejected.")
    return rows.select("o_orderkey", F.concat_ws(" ", F.concat(F.lit("Session "), F.col("o_orderkey").cast("string"), F.lit(".")), F.when(F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" ballots."))), said).alias("report"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent matter' WHEN '5-LOW' THEN 'Low matter' ELSE o_orderpriority END AS item FROM orders""")
def short_code_map(t):
    p = F.col("o_orderpriority")
    return t("orders").select("o_orderkey", F.when(p == "1-URGENT", "Urgent matter").when(p == "5-LOW", "Low matter").otherwise(p).alias("item"))


@query("""SELECT event_id, concat(strftime(ts, '%B %-d, %Y'), ' at ', strftime(ts, '%-I:%M %p'), ' PST') AS label FROM events""")
def fmt_datetime(t):
    return t("events").select("event_id", tm.long_label(F.col("ts")).alias("label"))


@query("""SELECT event_id, CASE WHEN s < 3600 THEN printf('%02d:%02d', s // 60, s % 60) ELSE printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) END AS clock FROM (SELECT event_id, CAST(event_id * 7 % 9000 AS BIGINT) s FROM events)""")
def fmt_mmss(t):
    return t("events").select("event_id", tm.clock(F.col("event_id") * 7 % 9000).alias("clock"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('https://v/', user_id, '&meta_id=', event_id) WHEN event_id % 3 = 1 THEN concat('https://v/', user_id, '?t=', event_id // 60, 'm', event_id % 60, 's') ELSE concat('https://v/', user_id) END AS link FROM events""")
def deep_link(t):
    e = F.col("event_id")
    return t("events").select("event_id", tm.deep_link(F.lit("https://v/"), F.col("user_id"), F.when(e % 3 == 0, e), F.when(e % 3 == 1, e)).alias("link"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(greatest(1, l_linenumber * 2) AS BIGINT) AS by_frame, CAST(l_linenumber * 30 + CASE WHEN contains(lower(p_type), 'promo') THEN 900 ELSE 900 END AS BIGINT) AS by_content, CAST(floor(l_partkey / 30) AS BIGINT) AS by_rate FROM lineitem JOIN part ON l_partkey = p_partkey""")
def time_estimate_policies(t):
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    none = F.lit(None).cast("int")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", tm.by_frame(none, F.col("l_linenumber")).cast("bigint").alias("by_frame"), tm.by_content(F.col("p_type"), F.col("l_linenumber")).cast("bigint").alias("by_content"), tm.by_rate(F.col("l_partkey")).cast("bigint").alias("by_rate"))


@query("""SELECT o_orderkey, printf('2024-%02d-%02d', (o_orderkey - 243) % 12 + CASE WHEN (o_orderkey - 243) % 12 < 0 THEN 12 ELSE 0 END + 1, (o_orderkey - 243) % 28 + CASE WHEN (o_orderkey - 243) % 28 < 0 THEN 28 ELSE 0 END + 1) AS date FROM orders""")
def pmod_date(t):
    return t("orders").select("o_orderkey", tm.date_of_id(F.col("o_orderkey"), 2024, 243).alias("date"))


# ---- maps, reconciliation, validation


@query("""WITH c AS (SELECT event_id % 50 AS g, CASE event_type WHEN 'click' THEN 'press' ELSE event_type END AS k, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1, 2)
  SELECT g, string_agg(concat(k, '=', n), ',' ORDER BY k) AS entries FROM c GROUP BY 1""")
def key_rename_delete(t):
    c = t("events").groupBy((F.col("event_id") % 50).alias("g"), "event_type").agg(n().cast("string").alias("n"))
    m = c.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    m = m.select("g", F.transform_keys(F.map_filter("m", lambda k, v: k != "view"), lambda k, v: F.when(k == "click", "press").otherwise(k)).alias("m"))
    return m.select("g", F.array_join(F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("entries")).where("entries <> ''")


@query("""WITH x AS (SELECT l_orderkey, count_if(l_returnflag = 'R') a, count_if(l_returnflag = 'N') b, count_if(l_returnflag = 'A') c FROM lineitem GROUP BY 1)
  SELECT l_orderkey, seat::BIGINT AS seat, CASE WHEN seat < a THEN 'YES' WHEN seat < a + b THEN 'NO' ELSE 'ABSTAIN' END AS choice, true AS imputed FROM x, (SELECT unnest(range(5)) AS seat) WHERE seat < a + b + c""")
def seat_inference(t):
    f = F.col("l_returnflag")
    x = t("lineitem").groupBy("l_orderkey").agg(count_if(f == "R").alias("a"), count_if(f == "N").alias("b"), count_if(f == "A").alias("c"))
    seats = x.withColumn("seat", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(4).cast("bigint"))))
    return seats.select("l_orderkey", "seat", reconcile.seat_choice(F.col("seat"), F.col("a"), F.col("b"), F.col("c")).alias("choice"), F.lit(True).alias("imputed")).where("choice is not null")


@query("""SELECT o_orderkey, CASE WHEN contains(r, 'pass') THEN 'YES' WHEN contains(r, 'fail') THEN 'NO' ELSE 'YES' END AS choice, greatest(0, o_orderkey % 3 - 1)::BIGINT AS abstentions FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'passed' WHEN 'O' THEN 'failed' ELSE '' END r FROM orders)""")
def impute_by_outcome(t):
    r = F.when(F.col("o_orderstatus") == "F", "passed").when(F.col("o_orderstatus") == "O", "failed").otherwise("")
    return t("orders").select("o_orderkey", reconcile.choice_by_outcome(r).alias("choice"), F.greatest(F.lit(0), F.col("o_orderkey") % 3 - 1).cast("bigint").alias("abstentions"))


@query("""SELECT c_custkey, 'negative balance' AS issue FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'unknown nation' FROM customer WHERE c_nationkey > 20""")
def validate_issues(t):
    found = F.explode(reconcile.issues(**{"negative balance": F.col("c_acctbal") < 0, "unknown nation": F.col("c_nationkey") > 20}))
    return t("customer").select("c_custkey", found.alias("issue"))


@query("""SELECT count(*)::BIGINT AS ballots, count_if(l_suppkey IN (1, 2, 3))::BIGINT AS present, count_if(l_suppkey NOT IN (1, 2, 3))::BIGINT AS missing, count(DISTINCT CASE WHEN l_suppkey NOT IN (1, 2, 3) THEN l_orderkey END)::BIGINT AS sessions FROM lineitem""")
def missing_member_audit(t):
    here = F.col("l_suppkey").isin(1, 2, 3)
    return t("lineitem").agg(n().alias("ballots"), count_if(here).alias("present"), count_if(~here).alias("missing"), F.countDistinct(F.when(~here, F.col("l_orderkey"))).cast("bigint").alias("sessions"))


@query("""WITH c AS (SELECT doc_id, source, contains(lower(text), 'the') AND contains(lower(text), 'tion') AS f, CASE WHEN contains(lower(text), 'abst') THEN 5 ELSE 7 END AS ayes FROM documents)
  SELECT source, count(*)::BIGINT AS candidates, count_if(f)::BIGINT AS flagged, sum(CASE WHEN f THEN ayes END)::BIGINT AS ayes FROM c GROUP BY 1""")
def candidates_pipeline(t):
    low = F.lower("text")
    f = F.contains(low, F.lit("the")) & F.contains(low, F.lit("tion"))
    c = t("documents").select("source", f.alias("f"), F.when(F.contains(low, F.lit("abst")), 5).otherwise(7).alias("ayes"))
    return c.groupBy("source").agg(n().alias("candidates"), count_if(F.col("f")).alias("flagged"), F.sum(F.when(F.col("f"), F.col("ayes"))).cast("bigint").alias("ayes"))


# ---- streams


def _streamed(name: str, sql: str, build, mode: str):
    """A query that runs what is there through a file stream to its end and reads the sink."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        import uuid

        from rollcall.streaming import candidates as st

        out = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        df = build(st, spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*"))
        st.drain(df, f"{out}/rows", f"{out}/state", mode)
        return spark.read.schema(df.schema).parquet(f"{out}/rows")

    QUERIES[name], ORACLES[name] = run, sql


_streamed("stream_dedupe", "SELECT DISTINCT event_id, event_type FROM events", lambda st, e: st.distinct_within(e.withColumn("ts", F.col("ts").cast("timestamp")), ["event_id"], "ts", "1 day").select("event_id", "event_type"), "append")
_streamed("stream_flags", "SELECT event_id, value > 50 AS high FROM events WHERE event_type = 'error'", lambda st, e: e.where("event_type = 'error'").select("event_id", (F.col("value") > 50).alias("high")), "append")
