"""Queries of sources, small filters, linkage by score, sinks and streams, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall import api
from rollcall.functions import text as tx
from rollcall.functions import times as tm
from rollcall.operators import linkage, reconcile
from rollcall.shared import shared_folder
from rollcall.sources import pages as pg
from rollcall.streaming import candidates, merge, stateful

from .meetings import B, C, OUT, PRESENT, ballots, lines, made
from .registry import ORACLES, QUERIES, count_if, n, query

EXTRA = """concat(html, '<a class="x" href="/p?view=1&meta_id=', page_id, '"> Agenda item ', page_id, ' </a><a href="/c?clip_id=9">abc</a><a href="/p?meta_id=77">Long enough</a><b time="', page_id % 50, '">x</b><i time="7">',
  CASE page_id % 4 WHEN 0 THEN '{"file": "//cdn/a.m3u8?x=1"}' WHEN 1 THEN '<source src="/live/b.m3u8">' WHEN 2 THEN 'play(''https://v/c.m3u8'')' ELSE '' END)"""


@query(f"""WITH p AS (SELECT page_id, {EXTRA} AS h FROM pages), i AS (SELECT page_id, unnest(regexp_extract_all(h, '<a\\b[^>]*href="[^"]*\\bmeta_id=(\\d+)[^"]*"[^>]*>([^<]*)</a>', 1)) AS id, unnest(regexp_extract_all(h, '<a\\b[^>]*href="[^"]*\\bmeta_id=(\\d+)[^"]*"[^>]*>([^<]*)</a>', 2)) AS t FROM p) SELECT page_id, id, trim(t) AS text FROM i WHERE length(trim(t)) > 5""")
def page_anchors(t):
    p = t("pages").selectExpr("page_id", f"{EXTRA} AS h")
    return p.select("page_id", F.inline(pg.anchors(F.col("h"), "meta_id", 5)))


@query(f"""WITH p AS (SELECT page_id, {EXTRA} AS h FROM pages) SELECT page_id, array_to_string(list_sort(list_transform(regexp_extract_all(h, 'time="(\\d+)"', 1), lambda x: CAST(x AS INT))), ',') AS times FROM p""")
def page_times(t):
    p = t("pages").selectExpr("page_id", f"{EXTRA} AS h")
    return p.select("page_id", F.array_join(F.transform(pg.times(F.col("h")), lambda x: x.cast("string")), ",").alias("times"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://cdn/a.m3u8?x=1' WHEN 1 THEN 'https://site/live/b.m3u8' WHEN 2 THEN 'https://v/c.m3u8' END AS stream FROM pages")
def stream_urls(t):
    return t("pages").selectExpr("page_id", f"{EXTRA} AS h").select("page_id", pg.stream_url(F.col("h"), "https://site").alias("stream"))


@query("SELECT doc_id, text FROM documents")
def bytes_to_text(t):
    broken = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("C3")))
    return t("documents").select("doc_id", pg.text_of_bytes(broken).alias("text"))


@query("SELECT CAST(p_partkey AS STRING) AS clip_id, CAST(c * 1000 + f * 100 AS INT) AS frame_number FROM part, (SELECT unnest(range(1, 4)) AS c), (SELECT unnest(range(10)) AS f) WHERE c <= p_size % 4")
def made_up_frames(t):
    rows = t("part").select(F.col("p_partkey").cast("string").alias("clip_id"), (F.col("p_size") % 4).cast("int").alias("votable_chapters")).where("votable_chapters > 0")
    return pg.made_up_frames(rows)


@query(f"WITH {B} SELECT session_id, in_ord, CAST(frame_number AS BIGINT) * 30 + CASE WHEN item_text IS NULL THEN 0 WHEN contains(lower(item_text), 'consent') THEN 300 WHEN contains(lower(item_text), 'public hearing') THEN 1800 WHEN contains(lower(item_text), 'adjournment') THEN 3600 WHEN contains(lower(item_text), 'resolution') THEN 1200 WHEN contains(lower(item_text), 'ordinance') THEN 1500 ELSE 900 END AS video_ts FROM b")
def content_times(t):
    return ballots(t).select("session_id", "in_ord", tm.by_content(F.col("item_text"), F.col("frame_number")).cast("bigint").alias("video_ts"))


# ---- filters


@query(f"WITH {B} SELECT session_id, in_ord, ({PRESENT[1]}) AS has_bo, coalesce(({PRESENT[0]}) AND (CASE l_partkey % 4 WHEN 3 THEN true ELSE false END) AND frame_path IS NOT NULL, false) AS away_on_frame, ({PRESENT[0]}) OR ({PRESENT[4]}) AS alias FROM b")
def choice_filters(t):
    c = F.col("choices")
    away = F.coalesce((c["ada"] == "ABSTAIN") & F.col("frame_path").isNotNull(), F.lit(False))
    alias = F.exists(F.map_keys(c), lambda k: F.contains(F.upper(k), F.lit("ADA")) | F.contains(F.upper(k), F.lit("ED")))
    return ballots(t).select("session_id", "in_ord", F.map_contains_key(c, F.lit("bo")).alias("has_bo"), away.alias("away_on_frame"), alias.alias("alias"))


@query(f"WITH {B} SELECT 'passed' AS asked, count_if(contains({OUT}, 'pass'))::BIGINT AS n FROM b UNION ALL SELECT 'failed', count_if(contains({OUT}, 'fail'))::BIGINT FROM b UNION ALL SELECT 'other', count(*)::BIGINT FROM b")
def outcome_filters(t):
    b = ballots(t)
    one = lambda asked: api.ballots(b, api.BallotQuery(result=asked)).agg(n().alias("n")).select(F.lit(asked).alias("asked"), "n")
    return one("passed").union(one("failed")).union(one("other"))


@query("SELECT CASE WHEN contains(t, 'voting results') OR contains(t, 'yea') OR contains(t, 'nay') OR contains(t, 'abstain') OR contains(t, 'recuse') OR contains(t, 'motion') OR contains(t, 'resolution') OR contains(t, 'ordinance') OR contains(t, 'passes') OR contains(t, 'fails') THEN 'text' ELSE 'none' END AS detection_method, count(*)::BIGINT AS kept, count_if(length(t) > 1000)::BIGINT AS long FROM (SELECT lower(coalesce(text, '')) AS t FROM documents) GROUP BY 1")
def indicator_flags(t):
    low = F.lower(F.coalesce("text", F.lit("")))
    flag = tx.contains_any(low, tx.INDICATORS)
    rows = t("documents").select(F.when(flag, 0.9).otherwise(0.3).alias("confidence"), F.length(low).alias("k"))
    return rows.groupBy(F.when(F.col("confidence") > 0.7, "text").otherwise("none").alias("detection_method")).agg(n().alias("kept"), count_if(F.col("k") > 1000).alias("long"))


@query(f"WITH {B} SELECT count_if(coalesce(skip, false))::BIGINT AS skipped, count_if(NOT coalesce(skip, false))::BIGINT AS kept FROM (SELECT contains(lower(item_text), 'oral communications') OR contains(lower(item_text), 'adjournment') OR contains(lower(item_text), 'announcement') AS skip FROM b)")
def skip_counter(t):
    skip = tx.not_votable(F.col("item_text"))
    return ballots(t).agg(count_if(skip).alias("skipped"), count_if(~skip).alias("kept"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'none' WHEN event_id % 3 = 1 THEN NULL ELSE CAST(event_id AS STRING) END AS x FROM events")
def absent_or_null(t):
    """A default where a key is absent; a null that is there stays null."""
    e = F.col("event_id")
    doc = F.when(e % 3 == 0, F.lit("{}")).when(e % 3 == 1, F.lit('{"x": null}')).otherwise(F.format_string('{"x": "%d"}', e))
    v = F.parse_json(doc)
    absent = F.try_variant_get(v, "$.x", "variant").isNull()
    return t("events").select("event_id", F.when(absent, F.lit("none")).otherwise(F.try_variant_get(v, "$.x", "string")).alias("x"))


@query("SELECT event_type AS item, event_id FROM events")
def map_of_lists(t):
    """A map of lists back to rows, the key as a column."""
    groups = t("events").groupBy((F.col("event_id") % 97).alias("g"), "event_type").agg(F.collect_list("event_id").alias("ids"))
    maps = groups.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "ids"))).alias("m"))
    return maps.select(F.explode("m").alias("item", "ids")).select("item", F.explode("ids").alias("event_id"))


@query(f"WITH {B} SELECT true AS success, count(*)::BIGINT AS count, 'passed' AS result FROM b WHERE contains({OUT}, 'pass')")
def envelope(t):
    rows = api.ballots(ballots(t), api.BallotQuery(result="passed")).agg(n().alias("count"))
    doc = rows.select(F.to_json(F.struct(F.lit(True).alias("success"), "count", F.struct(F.lit("passed").alias("result")).alias("filters"))).alias("d"))
    return doc.select(F.get_json_object("d", "$.success").cast("boolean").alias("success"), F.get_json_object("d", "$.count").cast("bigint").alias("count"), F.get_json_object("d", "$.filters.result").alias("result"))


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS passed, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus IN ('O', 'P') THEN 1 ELSE 0 END AS failed, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2")
def exclusive_outcomes(t):
    o = F.when(F.col("o_orderstatus") == "F", "pass, not fail").when(F.col("o_orderstatus").isin("O", "P"), "fail").otherwise("")
    passed = F.contains(o, F.lit("pass"))
    return t("orders").groupBy(F.when(passed, 1).otherwise(0).alias("passed"), F.when(passed, 0).when(F.contains(o, F.lit("fail")), 1).otherwise(0).alias("failed")).agg(n().alias("n"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderkey AS STRING))::BIGINT AS as_text, row_number() OVER (ORDER BY o_orderkey)::BIGINT AS as_number FROM orders ORDER BY o_orderkey LIMIT 25")
def sorted_ids(t):
    first = t("orders").select("o_orderkey").orderBy("o_orderkey").limit(25)  # the catalog's limit is the feature
    smaller = t("orders").select(F.col("o_orderkey").cast("string").alias("s"))
    rank = first.join(F.broadcast(first.select(F.col("o_orderkey").alias("k"))), F.col("k") <= F.col("o_orderkey")).groupBy("o_orderkey").agg(n().alias("as_number"))
    text = smaller.join(F.broadcast(first.select("o_orderkey", F.col("o_orderkey").cast("string").alias("t"))), F.col("s") <= F.col("t")).groupBy("o_orderkey").agg(n().alias("as_text"))
    return rank.join(text, "o_orderkey").select("o_orderkey", "as_text", "as_number")


@query("SELECT event_type, array_to_string(list_slice(ids, 1, 3), ',') || ' +' || (len(ids) - 3) || ' more' AS first_ids FROM (SELECT event_type, list(event_id ORDER BY event_id) AS ids FROM events GROUP BY 1)")
def first_and_more(t):
    """The first three ids of a kind and how many more there are; kinds move as three ids and a count."""
    k = F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))
    three = t("events").withColumn("k", k).where("k <= 3").groupBy("event_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("ids"))
    total = t("events").groupBy("event_type").agg(n().alias("n"))
    return three.join(total, "event_type").select("event_type", F.concat("ids", F.lit(" +"), (F.col("n") - 3).cast("string"), F.lit(" more")).alias("first_ids"))


# ---- linkage, members, imports

MARKED = "m AS (SELECT session_id, in_ord AS o, CAST(l_partkey AS STRING) AS marker_id, item_text AS marker_text FROM b WHERE l_suppkey % 2 = 1 AND item_text IS NOT NULL)"
_n6 = lambda x: f"array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^A-Za-z0-9_ ]', '', 'g'), ' +', ' ', 'g')), ' '), lambda w: w NOT IN ('', 'the', 'a', 'an', 'and', 'or', 'but', 'in', 'on', 'at', 'to', 'for', 'of', 'with', 'by')), ' ')"
PHRASES_SQL = "['PLANNING COMMISSION', 'COMMUNITY DEVELOPMENT', 'ORAL COMMUNICATIONS', 'ADJOURNMENT', 'CONSENT CALENDAR', 'HEARINGS', 'COUNCIL COMMITTEE', 'COMMUNITY SERVICES', 'RESOLUTION', 'ORDINANCE', 'PUBLIC HEARING', 'ACCEPT AND FILE']"


@query(rf"""WITH {B}, {MARKED}, j AS (SELECT b.session_id, in_ord, item_text, o, m.marker_id, {_n6('item_text')} AS x, {_n6('marker_text')} AS y, regexp_extract(item_text, '^([0-9]+[A-Z]?)\s*\.', 1) AS num FROM b JOIN m USING (session_id)),
  k AS (SELECT *, 10 * (len(list_filter({PHRASES_SQL}, lambda p: contains(upper(item_text), p) AND contains(y, lower(p)))) + CASE WHEN num <> '' AND contains(y, lower(num)) THEN 1 ELSE 0 END) + 2 * len(list_intersect(list_filter(string_split(x, ' '), lambda w: w <> ''), list_filter(string_split(y, ' '), lambda w: w <> ''))) + CASE WHEN abs(length(x) - length(y)) < 50 THEN 1 ELSE 0 END AS score FROM j)
  SELECT session_id, in_ord, marker_id, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY session_id, in_ord ORDER BY score DESC, o) AS rn FROM k WHERE score >= 5) WHERE rn = 1""")
def scored_join(t):
    b = made(lines(t), "CASE WHEN l_suppkey % 2 = 1 THEN CAST(l_partkey AS STRING) END AS own_marker").where("item_text is not null")
    markers = b.where("own_marker is not null").select("session_id", F.col("in_ord").alias("o"), F.col("own_marker").alias("marker_id"), F.col("item_text").alias("marker_text"))
    return linkage.scored_join(b.select("session_id", "in_ord", "item_text"), markers, "session_id", ["session_id", "in_ord"], "o").select("session_id", "in_ord", "marker_id", F.col("score").cast("bigint").alias("score"))


@query("SELECT s_name AS member, CASE WHEN s_suppkey = 3 THEN 'New' WHEN s_suppkey % 2 = 0 THEN concat('Summary ', s_suppkey) ELSE concat('Generated for ', s_name) END AS summary FROM supplier UNION ALL SELECT 'Zoe', 'New'")
def upsert_members(t):
    own = t("supplier").select(F.col("s_name").alias("member"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Summary "), F.col("s_suppkey").cast("string"))).alias("summary"))
    three = t("supplier").where("s_suppkey = 3").select(F.col("s_name").alias("member"), F.lit("New").alias("summary"))
    new = three.union(t("supplier").sparkSession.createDataFrame([("Zoe", "New")], "member string, summary string"))
    return reconcile.fill_summaries(reconcile.upsert(own, new, "member"), F.concat(F.lit("Generated for "), F.col("member")))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN concat('Bo wrote ', s_suppkey - 1) ELSE concat('Own ', s_suppkey) END AS summary FROM supplier ORDER BY s_suppkey")
def move_summaries(t):
    """A summary that begins with the next member's name is moved to that member."""
    s = t("supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("Bo wrote "), F.col("s_suppkey").cast("string"))).otherwise(F.concat(F.lit("Own "), F.col("s_suppkey").cast("string"))).alias("summary"))
    return reconcile.move_summaries(s, "s_suppkey", "summary", "Bo ", F.col("s_suppkey") + 1)


DRAWN = "CAST(('0x' || substr(md5(concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '|7')), 1, 8)) AS BIGINT) / 4294967296"


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'R' THEN CASE WHEN {DRAWN} < 0.7 THEN 'ABSTAIN' ELSE 'YES' END
         WHEN 'A' THEN CASE WHEN {DRAWN} < 0.3 THEN 'NO' ELSE 'ABSTAIN' END ELSE 'ABSTAIN' END AS choice FROM lineitem""")
def seeded_draw(t):
    """Choices drawn by outcome for a member who mostly abstains."""
    outcome = F.when(F.col("l_returnflag") == "R", "Motion Passes").when(F.col("l_returnflag") == "A", "Motion Fails").otherwise("Tie")
    row = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", reconcile.drawn(outcome, row, 7).alias("choice"))


# ---- streams


def _streamed(name: str, sql: str, build):
    """A query over the events as a stream, run to its end in a folder of its own; build gives the result's frame."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
        rows = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
        return build(rows.withColumn("ts", F.col("ts").cast("timestamp")), out, spark)

    QUERIES[name], ORACLES[name] = run, sql


def _to_the_end(events, out, spark, form):
    """Two runs from one checkpoint: what is there, then the end of the input."""
    df = form(stateful.with_end(events, f"{out}/marks", "ts", "1 second"))
    with stateful.rocks(spark):
        stateful.drain(df, f"{out}/rows", f"{out}/state")
        stateful.mark_end(spark, f"{out}/marks", "ts")
        stateful.drain(df, f"{out}/rows", f"{out}/state")
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


def _windows(events, out, spark):
    rows = _to_the_end(events, out, spark, lambda e: stateful.windowed(e, "ts", "1 hour", "event_type"))
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


_streamed(
    "stream_window",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*)::BIGINT AS n FROM events
       WHERE ts IS NOT NULL GROUP BY 1, 2""",
    _windows,
)


def _sessions(events, out, spark):
    rows = _to_the_end(events, out, spark, lambda e: stateful.sessions(e, "ts", "30 minutes", "user_id"))
    return rows.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


_streamed(
    "stream_sessions",
    """WITH e AS (SELECT user_id, epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL),
            g AS (SELECT *, CASE WHEN us < lag(us) OVER w + 1800000000 THEN 0 ELSE 1 END AS begins FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us)),
            i AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY us RANGE UNBOUNDED PRECEDING) AS island FROM g)
       SELECT user_id, min(us) AS start_us, max(us) + 1800000000 AS end_us, count(*)::BIGINT AS n FROM i GROUP BY user_id, island""",
    _sessions,
)


def _upserted(events, out, spark):
    rows = events.select("event_id", "event_type", "value")
    for _ in range(2):  # the second run finds nothing new
        candidates.upsert(rows, f"{out}/rows", f"{out}/state", ["event_id"], "value")
    return candidates.latest(spark, f"{out}/rows", ["event_id"], "value").select("event_id", "event_type")


_streamed("stream_upsert", "SELECT DISTINCT event_id, event_type FROM events", _upserted)


def _merged(events, out, spark):
    """The events come in several files, so keys repeat inside and across batches."""
    schema = "event_id long, user_id long, event_type string, value double"
    table = merge.MergedTable(spark, f"{out}/table", ["user_id"], "event_id", 8)
    batches = events.select("event_id", "user_id", "event_type", "value")
    parts = batches.writeStream.foreachBatch(lambda df, k: df.repartition(4, "event_id").write.mode("overwrite").parquet(f"{out}/parts"))
    parts.option("checkpointLocation", f"{out}/split").trigger(availableNow=True).start().awaitTermination()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/parts")
    table.follow(stream, f"{out}/state")
    return table.read()


_streamed(
    "stream_merge",
    "SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    _merged,
)


def _neighbours(events, out, spark):
    rows = _to_the_end(events, out, spark, lambda e: stateful.neighbours(e, "event_type", "ts", "value", "event_id", 60))
    return rows.select(F.col("key").alias("event_type"), F.col("ord").alias("event_id"))


_streamed(
    "stream_neighbours",
    """WITH RECURSIVE f AS (SELECT event_type AS g, epoch_us(ts) AS pos, event_id AS o, value AS s,
                                   row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
            w AS (SELECT g, k, pos, s, o, false AS gone, CAST(NULL AS BIGINT) AS killed FROM f WHERE k = 1
                  UNION ALL
                  SELECT f.g, f.k, f.pos, f.s, f.o, NOT w.gone AND f.pos - w.pos <= 60000000 AND w.s >= f.s,
                         CASE WHEN NOT w.gone AND f.pos - w.pos <= 60000000 AND w.s < f.s THEN w.o END
                  FROM w JOIN f ON f.g = w.g AND f.k = w.k + 1)
       SELECT g AS event_type, o AS event_id FROM w
       WHERE NOT gone AND NOT EXISTS (SELECT 1 FROM w v WHERE v.g = w.g AND v.killed = w.o)""",
    _neighbours,
)
