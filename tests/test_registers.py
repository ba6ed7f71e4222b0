"""The small record-keeping functions on rows worked out by hand."""

from datetime import datetime

from pyspark.sql import functions as F

from rollcall import api
from rollcall.functions import text as tx
from rollcall.functions import times as tm
from rollcall.operators import linkage, registers


def test_addresses(spark):
    good = ["a@b.c", "x.y@z.org.uk"]
    bad = ["a@b", "a b@c.d", "a\t@b.c", "a@b@c.d", "@b.c", "a@.", "", None, "a b@c.d"]
    df = spark.createDataFrame([(x,) for x in good + bad], "e string")
    assert [r[0] for r in df.select(registers.valid_email(F.col("e"))).collect()] == [True] * 2 + [False] * len(bad)
    emails = spark.createDataFrame([("a@b.c",)], "email string")
    now, status = registers.subscribe(emails, "n@b.c")
    assert sorted(r.email for r in now.collect()) == ["a@b.c", "n@b.c"] and tuple(status.collect()[0]) == (True, registers.SUBSCRIBED)
    again, status = registers.subscribe(now, "n@b.c")
    assert again.count() == 2 and tuple(status.collect()[0]) == (False, registers.KNOWN)
    less, status = registers.unsubscribe(now, "a@b.c")
    assert [r.email for r in less.collect()] == ["n@b.c"] and tuple(status.collect()[0]) == (True, registers.UNSUBSCRIBED)
    assert tuple(registers.unsubscribe(less, "a@b.c")[1].collect()[0]) == (False, registers.UNKNOWN)
    assert tuple(registers.subscribe(emails.limit(0), "q@b.c")[1].collect()[0]) == (True, registers.SUBSCRIBED)


def test_roster_lists_and_answers(spark):
    roster = spark.createDataFrame([("A", 0), ("B", 1)], "member string, ord long")
    assert [r.member for r in registers.append_members(roster, "C", "A", "C", "D").orderBy("ord").collect()] == ["A", "B", "C", "D"]
    assert [r.member for r in registers.append_members(roster.limit(0), "Z").collect()] == ["Z"]
    lists = spark.createDataFrame([(1, {"x": ["a", "b"], "y": [], "z": None})], "n int, m map<string,array<string>>")
    assert sorted(map(tuple, registers.rows_of_lists(lists, "m", "item", "ballot").collect())) == [(1, "x", "a"), (1, "x", "b")]
    one = registers.envelope(roster.orderBy("ord"), {"member": "A", "result": None}, 10).collect()[0]
    assert one.success and [r.member for r in one.data] == ["A", "B"] and one["count"] == 2 and one.filters == {"member": "A", "result": None}
    assert registers.envelope(roster.limit(0), {}, 10).collect()[0]["count"] == 0
    assert registers.stamps(datetime(2024, 3, 4, 5, 6, 7)) == ("2024-03-04T05:06:07", "20240304_050607")


def test_counts_by_rule(spark):
    rows = [("1", "passed after it failed", {"ANN STONE": "YES", "B": "no"}, True, "f"), ("1", "Failed", {"stone": "ABSTAIN"}, True, ""), ("2", None, {"MARA": "x", "B": "ABSTAIN"}, True, "g"), ("2", "", None, None, "g")]
    df = spark.createDataFrame(rows, "session_id string, outcome string, choices map<string,string>, frame_available boolean, frame_path string")
    assert sorted(map(tuple, registers.exclusive_counts(df, "session_id").collect())) == [("1", 2, 1, 1), ("2", 2, 0, 0)]
    assert tuple(registers.alias_totals(df, "Stone", "mara").collect()[0]) == (3, 1, 0, 1)
    assert [r[0] for r in df.select(registers.to_look_at_again("B")).collect()] == [False, False, True, False]
    sessions = spark.createDataFrame([("1",), ("2",), ("2",)], "session_id string")
    assert tuple(registers.health(df, sessions, "2024").collect()[0]) == ("healthy", 4, 2, "2024")
    roster = spark.createDataFrame([("ANN  STONE",), ("B",)], "member string")
    stats = spark.createDataFrame([("B", 2, 0, 1)], "member string, total long, yes long, no long")
    card, own = registers.member_detail(df, roster, stats, "b")
    assert card.collect()[0].asDict() == {"member": "B", "total": 2, "yes": 0, "no": 1, "id": "b"} and own.count() == 2
    assert [r.total for r in registers.member_detail(df, roster, stats, "ann_stone")[0].collect()] == [0]
    assert registers.member_detail(df, roster, stats, "nobody")[0].collect() == []


def test_texts(spark):
    answers = [('```json\n{"Ada": "yes", "Bo": "maybe", "Zed": "NO"}\n```', {"ADA": "YES", "BO": "ABSTAIN"}), ("no object", None), (None, None), ("{}", {})]
    df = spark.createDataFrame([(a,) for a, _ in answers], "t string")
    assert [r[0] for r in df.select(registers.parsed_choices(F.col("t"), ["Ada", "Bo"])).collect()] == [w for _, w in answers]
    links = spark.createDataFrame([("see https://a.b/c?d now",)], "t string").select(registers.linked(F.col("t"))).collect()[0][0]
    assert links == 'see <a href="https://a.b/c?d" target="_blank" class="link-style">https://a.b/c?d</a> now'
    catalog = spark.createDataFrame([("1", 2), ("2", 0), ("3", None)], "clip_id string, votable_chapters int")
    assert [tuple(r) for r in registers.made_up_frames_by_share(catalog, 3).collect()] == [("1", k) for k in range(6)]


def test_markers_are_given_only_where_their_time_is_known(spark):
    ballots = spark.createDataFrame(
        [("1", 0, "5A. Public hearing on the lease of land", None, None, True), ("1", 1, "5A. Public hearing on the lease of land", "old", 7, False), ("1", 2, "Budget for parks and recreation services", "old", 9, True), ("1", 3, None, None, None, None), ("2", 0, "5A. Public hearing on the lease of land", None, None, None)],
        "session_id string, in_ord long, item_text string, marker_id string, video_ts long, ts_estimated boolean",
    )
    markers = spark.createDataFrame([("1", "m1", "Public hearing on the lease of land", 100, 0), ("1", "m2", "Budget for parks and recreation services", None, 1)], "session_id string, marker_id string, marker_text string, seconds int, ord int")
    got = sorted((r.session_id, r.in_ord, r.marker_id, r.video_ts, r.ts_estimated) for r in linkage.timed_markers(ballots, markers, "session_id", ["session_id", "in_ord"]).collect())
    assert got == [("1", 0, "m1", 100, False), ("1", 1, "old", 7, False), ("1", 2, "old", 9, True), ("1", 3, None, None, None), ("2", 0, None, None, None)]


def test_search_looks_at_each_field_by_itself(spark):
    df = spark.createDataFrame([(0, "Lease", "adopt"), (1, None, "lease it"), (2, "x", None)], "in_ord long, item_text string, motion_text string").withColumn("session_id", F.lit("1"))
    find = lambda term: sorted(r.in_ord for r in api.search(df, term).collect())
    assert find("LEASE") == [0, 1] and find("lease\nadopt") == [] and find("none") == []
    q = api.BallotQuery(text="lease")
    assert sorted(r.in_ord for r in api.ballots(df.withColumns({"outcome": F.lit(None).cast("string")}), q).collect()) == [0, 1]
    labels = spark.createDataFrame([(5,), (0,), (None,)], "s int").select(tm.frame_label(F.col("s"))).collect()
    assert [r[0] for r in labels] == ["actual", "estimated", "estimated"]
    roster = spark.createDataFrame([({"b": "x", "a": "y"},), ({"a": "z"},)], "choices map<string,string>")
    assert [r.member for r in api.roster(roster).collect()] == ["a", "b"]


def test_codes_paths_rates_and_audits(spark):
    items = spark.createDataFrame([("5.A",), ("14",), ("5A.",), (None,), ("Lease",)], "i string").select(registers.expanded(F.col("i"))).collect()
    assert [r[0] for r in items] == ["5A. Recognition and Proclamations", "14. Adjournment", "5A.", None, "Lease"]
    paths = spark.createDataFrame([("own", "7", 3), ("", "7", 3), (None, "7", None), (None, "7", 1234567)], "p string, s string, f int")
    got = [r[0] for r in paths.select(registers.frame_path(F.col("p"), F.col("s"), F.col("f"), "d")).collect()]
    assert got == ["own", "d/votable_frames_7/frame_000003.jpg", None, "d/votable_frames_7/frame_1234567.jpg"]
    rate = lambda *m: tuple(registers.match_rate(spark.createDataFrame([(x,) for x in m], "marker_id string")).collect()[0])
    assert rate("a", "", None) == (1, 3, "33.3%") and rate() == (0, 0, "0%")
    ids = spark.createDataFrame([("14399",), ("14400",), ("14x",), ("2",), (None,)], "s string").select(registers.likely_session(F.col("s"), "14", 14400)).collect()
    assert [r[0] for r in ids] == [True, False, False, False, False]
    stats = spark.createDataFrame([("A", 3, 1)], "member string, total long, yes long")
    assert sorted(map(tuple, registers.added_members(stats, "A", "B", "B").collect())) == [("A", 3, 1), ("B", 0, 0)]
    df = spark.createDataFrame([("1", k, "x", {"m": "YES"} if k % 3 == 0 else {"o": "NO"}) for k in range(30)], "session_id string, in_ord long, item_text string, choices map<string,string>")
    rows = registers.audit(df, "m", 3).collect()
    assert [(r.in_ord, r.n_missing) for r in rows] == [(1, 20), (2, 20), (4, 20)] and registers.audit(df, "nobody").count() == 10


def test_every_phrase_is_replaced(spark):
    rows = [(f"Item 3: {long.upper()} after", f"{short} after") for long, short in tx.PHRASES]
    df = spark.createDataFrame(rows, "t string, want string")
    assert len(rows) >= 9 and all(r.got == r.want for r in df.select("want", tx.normalise_phrases(F.col("t")).alias("got")).collect())
