"""Tallies, merges, imputation and the import on rows worked out by hand; counters, aliases, dates, validation."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions import text as tx
from rollcall.functions import times as tm
from rollcall.operators import aliases, choices, counters, importing, reconcile
from rollcall.sources import pages

BALLOT = "ballot_id string, session_id string, item_text string, frame_number int, outcome string, tally struct<ayes:int,noes:int,abstentions:int>, choices map<string,string>, marker_id string, video_ts int, ts_estimated boolean, in_ord long"


def ballots(spark, *rows):
    names = [c.split()[0] for c in BALLOT.replace("struct<ayes:int,noes:int,abstentions:int>", "t").replace("map<string,string>", "m").split(", ")]
    return spark.createDataFrame([tuple(({"in_ord": k, "session_id": "14520"} | r).get(n) for n in names) for k, r in enumerate(rows)], BALLOT)


def test_tokens_of_each_policy(spark):
    df = spark.createDataFrame([({"a": "YES", "b": "y", "c": "Aye", "d": "YEA", "e": "n", "f": "NAY", "g": "A", "h": "abstention"},)], "c map<string,string>")
    got = df.select(*[choices.tally_of(F.col("c"), p).alias(n) for n, p in (("filled", choices.FILLED), ("listed", choices.LISTED), ("exact", choices.EXACT))]).collect()[0]
    assert tuple(got.filled) == (3, 2, 1) and tuple(got.listed) == (2, 1, 1) and tuple(got.exact) == (1, 0, 0)


def test_tally_is_filled_only_where_it_is_missing(spark):
    df = ballots(spark, {"choices": {"a": "YES"}, "outcome": "x"}, {"choices": {"a": "NO"}, "tally": (4, 1, 0), "outcome": "kept"}, {"choices": {}, "outcome": "kept"}, {"outcome": "kept"}, {"choices": {"a": "N"}}, {"choices": {"a": "YEA"}})
    rows = choices.fill_tally(df).orderBy("in_ord").collect()
    assert [r.outcome for r in rows] == ["Motion Passes", "kept", "kept", "kept", "Motion Fails", "Tie"]
    assert [tuple(r.tally) if r.tally else None for r in rows] == [(1, 0, 0), (4, 1, 0), None, None, (0, 1, 0), (0, 0, 0)]


def test_imputing_adds_one_to_the_stored_tally(spark):
    df = ballots(
        spark,
        {"choices": {"x": "YES"}, "tally": (4, 1, 0), "outcome": "Motion Passes"}, {"choices": {"m": "NO"}, "tally": (1, 4, 0), "outcome": "Motion Fails"},
        {"choices": {"x": "NO"}, "tally": (1, 4, 0), "outcome": "Denied"}, {"choices": None, "tally": None, "outcome": "Adopted"}, {"choices": {"x": "YES"}, "tally": (0, None, 0), "outcome": "rejected"}, {"choices": {}, "tally": (1, 1, 0), "outcome": None},
    )
    rows = choices.impute_member(df, "m").orderBy("in_ord").collect()
    assert [r.choices["m"] for r in rows] == ["YES", "NO", "YES", "YES", "NO", "YES"]  # 'denied' holds none of the words
    assert [tuple(r.tally) if r.tally else None for r in rows] == [(5, 1, 0), (1, 4, 0), (2, 4, 0), None, (0, 1, 0), (2, 1, 0)]
    assert [r.imputed for r in rows] == [["m"], [], ["m"], ["m"], ["m"], ["m"]]


def test_imputing_can_count_every_tally_anew(spark):
    df = ballots(spark, {"choices": {"x": "YES"}, "tally": (9, 9, 9), "outcome": "Motion Passes"}, {"choices": {"m": "NO", "x": "ABSTAIN"}, "tally": (1, 4, 0)}, {"choices": {"x": "NO"}, "outcome": "Tie"}, {"choices": None})
    rows = choices.impute_member(df, "m", "majority", recount=True).orderBy("in_ord").collect()
    assert [tuple(r.tally) for r in rows] == [(2, 0, 0), (0, 1, 1), (0, 2, 0), (1, 0, 0)]


def test_imputing_by_majority_asks_pass_and_fail_first(spark):
    ties = {"x": "YES", "y": "YES", "z": "NO"}
    df = ballots(spark, {"choices": ties, "outcome": "Tie - fails"}, {"choices": ties, "outcome": "Tie"}, {"choices": {"x": "YES", "z": "NO"}, "outcome": "tie"}, {"choices": {}, "outcome": "adopted"}, {"choices": {"x": "yes"}, "outcome": "Tie"}, {"choices": {"m": "ABSTAIN"}, "outcome": "Tie", "tally": (1, 1, 1)})
    rows = choices.impute_member(df, "m", "majority").orderBy("in_ord").collect()
    assert [r.choices["m"] for r in rows] == ["NO", "YES", "NO", "YES", "NO", "ABSTAIN"]
    assert tuple(rows[-1].tally) == (1, 1, 1)


def test_listed_merge_keeps_what_it_has_no_better_for(spark):
    df = ballots(
        spark,
        {"item_text": "one", "choices": {"a": "NO"}, "tally": (5, 0, 0), "outcome": "Passed", "frame_number": 0, "video_ts": 7, "marker_id": "", "ballot_id": "b0"},
        {"item_text": "bare", "outcome": "Passed", "tally": (3, 0, 0), "frame_number": 9, "ballot_id": "b1"}, {"item_text": "bare", "outcome": "Fails", "frame_number": 0, "video_ts": 0, "ballot_id": "b2"},
        {"item_text": "two", "choices": {"a": "YES", "b": "nay"}, "outcome": "x", "frame_number": 8, "video_ts": 50, "ballot_id": "b3"}, {"item_text": "two", "choices": {"a": "aye", "c": "YEA"}, "frame_number": 4, "video_ts": 20, "marker_id": "m", "ballot_id": "b4"},
    )
    rows = {r.item_text: r for r in choices.merge_listed(df, ["session_id", "item_text"]).collect()}
    pick = lambda r: (r.merged, r.ballot_id, r.outcome, r.ayes, r.noes, r.abstentions, r.frame_number, r.video_ts, r.marker_id, r.ts_estimated)
    assert pick(rows["one"]) == (1, "b0", "Passed", 5, 0, 0, 0, 7, "", False)
    assert pick(rows["bare"]) == (2, "b1", "Passed", 3, 0, 0, 9, None, None, True)
    assert pick(rows["two"]) == (2, "b3", "Passes", 2, 1, 0, 4, 20, "m", False)


def test_merge_keeps_id_marker_and_time_of_the_least_frame(spark):
    df = ballots(
        spark,
        {"item_text": "i", "frame_number": 5, "choices": {"a": "YES"}, "marker_id": "m5", "video_ts": 77, "ts_estimated": False, "ballot_id": "b5"},
        {"item_text": "i", "frame_number": 3, "choices": {"a": "NO", "b": "YES"}, "marker_id": "m3", "video_ts": 33, "ts_estimated": False},
        {"item_text": "none", "marker_id": "m", "ballot_id": "x", "video_ts": 9}, {"item_text": None, "frame_number": 2, "ballot_id": "n"}, {"item_text": None, "frame_number": 2},
    )
    rows = {r.item_text: r for r in choices.merge_ballots(df, ["session_id", "item_text"]).collect()}
    pick = lambda r: (r.ballot_id, r.frame_number, r.choices, r.marker_id, r.video_ts, r.ts_estimated, r.consolidated_from)
    assert pick(rows["i"]) == ("14520_i", 3, {"a": "NO", "b": "YES"}, "m3", 33, False, ["b5", "14520_i"])
    assert pick(rows["none"]) == ("x", 0, {}, "m", 9, True, ["x"])
    assert pick(rows[None]) == ("n", 2, {}, None, None, True, ["n", "14520_None"])


def test_the_import_as_a_whole(spark):
    new = ballots(
        spark,
        {"item_text": "Consent Calendar", "frame_number": 2, "choices": {"a": "YES"}, "ballot_id": "n1"}, {"item_text": "Lease", "frame_number": 3, "choices": {"a": "NO", "b": "NO"}, "marker_id": "m", "video_ts": 77, "ts_estimated": False, "ballot_id": "n2"},
        {"item_text": "Other", "session_id": "9", "ballot_id": "n3"}, {"item_text": "Hearing", "frame_number": 12345, "ballot_id": "n4", "choices": {"b": "yes"}}, {"item_text": "x", "session_id": None},
    )
    old = ballots(spark, {"item_text": "old", "ballot_id": "n1", "choices": {"a": "YES", "c": "other"}})
    session = "session_id string, title string, date string"
    sessions, known = spark.createDataFrame([("14520", "T", tm.NO_DATE)], session), spark.createDataFrame([("14520", "old", "2024-05-05"), ("1", "o", None)], session)
    got = importing.run_import(new, sessions, old, known)
    rows = {(r.ballot_id, r.item_text): r for r in got.ballots.collect()}
    pick = lambda r: (r.marker_id, r.video_ts, r.ts_estimated)
    assert len(rows) == 5 and pick(rows["n1", "old"]) == (None, None, None)
    assert pick(rows["n1", "Consent Calendar"]) == ("145200002", 360, True) and pick(rows["n2", "Lease"]) == ("m", 77, False)
    assert pick(rows["n3", "Other"]) == (None, None, True) and pick(rows["n4", "Hearing"]) == ("1452012345", 12345 * 30 + 900, True)
    assert sorted(map(tuple, got.sessions.collect())) == [("1", "o", None), ("14520", "T", "2024-02-26")]
    assert {r.member: tuple(r)[1:] for r in got.member_stats.collect()} == {"a": (3, 2, 1, 0), "b": (2, 1, 1, 0), "c": (1, 0, 0, 0)}
    s = got.session_summaries.collect()[0]
    assert (s.total, s.passed, s.failed, s.key_items) == (3, 2, 1, ["Consent Calendar", "Lease", "Hearing"])
    assert s.summary == "City Council meeting 14520 with 3 votes recorded. 2 votes passed, 1 failed."
    matched = spark.createDataFrame([("14520", "n1", "k", 5, False)], "session_id string, ballot_id string, marker_id string, seconds int, estimated boolean")
    again = importing.run_import(new, sessions, old, known, matched)
    assert ("k", 5, False) in {pick(r) for r in again.ballots.collect()}


def test_dates_of_ids_and_labels(spark):
    ids = {"14243": "2024-01-01", "14244": "2024-02-02", "15490": "2025-01-01", "15100": "2025-07-03", "9": "2024-07-19", "14x": "2024-01-01", "15": "2025-01-01", "x": "2024-01-01"}
    for i, want in list(ids.items()):  # worked out as whole numbers are in the source
        for prefix, year, k in tm.YEARS:
            if i.startswith(prefix) and i[2:].isdigit():
                ids[i] = f"{year}-{(int(i[2:]) - k) % 12 + 1:02d}-{(int(i[2:]) - k) % 28 + 1:02d}"
        if i == "9":
            ids[i] = f"2024-{(9 - 243) % 12 + 1:02d}-{(9 - 243) % 28 + 1:02d}"
    df = spark.createDataFrame(list(ids.items()), "i string, want string")
    assert all(r.got == r.want for r in df.select("want", tm.estimated_date(F.col("i")).alias("got")).collect())
    kept = spark.createDataFrame([(None, "14243"), ("", "14243"), (tm.NO_DATE, "14243"), ("2023-01-09", "14243")], "d string, i string")
    assert [r[0] for r in kept.select(tm.date_or_estimate(F.col("d"), F.col("i"))).collect()] == ["2024-01-01"] * 3 + ["2023-01-09"]
    labels = [(None, None, "Date not available"), ("", "18:30", "Date not available"), ("2024-01-02", None, "January 2, 2024"), ("2024-01-02", "18:30", "January 2, 2024 at 6:30 PM PST"), ("2024-01-02", "00:05", "January 2, 2024 at 12:05 AM PST"), ("2024-01-02", "12:00", "January 2, 2024 at 12:00 PM PST"), ("soon", "9:15", "soon at 9:15")]
    df = spark.createDataFrame(labels, "d string, t string, want string")
    assert all(r.got == r.want for r in df.select("want", tm.meeting_label(F.col("d"), F.col("t")).alias("got")).collect())


def test_texts(spark):
    rows = [("Café on the Straße!", "CAFÉ STRASSE"), ("the  A an", ""), ("lease, land_9 (x)", "LEASE LAND_9 X"), (None, ""), ("ÉTÉ\x0bof мир", "ÉTÉ МИР")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert all(r.got == r.want for r in df.select("want", tx.normalise_match(F.col("t")).alias("got")).collect())
    ultra = tx.with_ultra(spark.createDataFrame([(None, ""), ("", ""), ("  ", "generic item"), ("9A", "generic item"), ("Consent calendar of today", "onsent calendar of today")], "t string, want string"), "t", "got")
    assert all(r.got == r.want for r in ultra.collect())
    raw = [(b"ok", "ok"), (b"a\xff\xfeb", "ab"), ("a�b".encode() + b"\xff", "a�b"), ("﷐﷐a﷐b�".encode(), "﷐﷐a﷐b�")]
    df = spark.createDataFrame([(bytearray(b), t) for b, t in raw], "b binary, want string")
    assert all(r.got == r.want for r in df.select("want", pages.text_of_bytes(F.col("b")).alias("got")).collect())


def test_draws_follow_the_outcome(spark):
    df = spark.range(4000).select(F.explode(F.array(*map(F.lit, ("Passed", "Failed", "Tie")))).alias("o"), "id")
    got = {(r.o, r.c): r.n for r in df.groupBy("o", reconcile.drawn(F.col("o"), F.col("id"), 7).alias("c")).agg(F.count("*").alias("n")).collect()}
    assert got.keys() == {("Passed", "ABSTAIN"), ("Passed", "YES"), ("Failed", "NO"), ("Failed", "ABSTAIN"), ("Tie", "ABSTAIN")}
    assert 2650 < got["Passed", "ABSTAIN"] < 2950 and 1050 < got["Failed", "NO"] < 1350


def test_counters_by_deltas_equal_a_recount(spark):
    rows = [("1", "Passed", {"a": "YES"}), ("1", "Failed", {"a": "NO", "b": "x"}), ("2", "pass and fail", {"b": "yes"}), ("3", None, None), (None, "Passed", {"a": "YES"})]
    df = spark.createDataFrame(rows, "session_id string, outcome string, choices map<string,string>")
    plus, minus = F.lit(1).alias("sign"), F.lit(-1).alias("sign")
    for make, key, measures in ((counters.session_delta, "session_id", ["total", "passed", "failed"]), (counters.member_delta, "member", ["total", "yes", "no", "abstain"])):
        stored = make(df.limit(2).select("*", plus))
        both = counters.applied(stored, make(df.offset(2).select("*", plus)), key, measures)
        assert sorted(map(tuple, both.collect())) == sorted(map(tuple, make(df.select("*", plus)).collect()))
        gone = counters.applied(both, make(df.where("session_id = '1'").select("*", minus)), key, measures)
        assert sorted(map(tuple, gone.collect())) == sorted(map(tuple, make(df.where("session_id <> '1' or session_id is null").select("*", plus)).collect()))


def test_counters_are_rewritten_only_where_the_total_changed(spark):
    stored = spark.createDataFrame([("1", 2, 2, 0), ("2", 5, 1, 1), ("3", 1, 1, 0), ("4", None, None, None)], "session_id string, total long, passed long, failed long")
    counts = spark.createDataFrame([("1", 2, 1, 1), ("2", 1, 1, 0), ("9", 1, 1, 0)], "session_id string, total long, passed long, failed long")
    got = sorted(map(tuple, counters.refreshed(stored, counts).collect()))
    assert got == [("1", 2, 2, 0, False), ("2", 1, 1, 0, True), ("3", 0, 0, 0, True), ("4", None, None, None, False)]


def test_sketches_roll_up_without_the_rows(spark):
    df = spark.range(30_000).select((F.col("id") % 40).alias("s"), (F.col("id") % 4).alias("y"), (F.col("id") % 9000).alias("m"))
    kept = counters.sketches(df, ["s", "y"], "m")
    year = {r.y: r.members for r in counters.rolled_up(kept, "y").collect()}
    direct = {r.y: r.members for r in df.groupBy("y").agg(F.hll_sketch_estimate(F.hll_sketch_agg("m", counters.SKETCH_BITS)).alias("members")).collect()}
    exact = {r.y: r.n for r in df.groupBy("y").agg(F.countDistinct("m").alias("n")).collect()}
    assert all(abs(year[y] - exact[y]) < 0.07 * exact[y] and abs(year[y] - direct[y]) < 0.02 * exact[y] for y in exact)
    assert abs(counters.rolled_up(kept).collect()[0].members - 9000) < 630


@pytest.fixture(scope="module")
def names(spark):
    rows = [(f"n{k:03d}", f"n{k + 1:03d}", 1) for k in range(100)]  # a chain of a hundred
    rows += [("c", "d", 1), ("d", "e", 1), ("e", "c", 1), ("into", "e", 1), ("self", "self", 1), ("two", "far", 2), ("two", "near", 1), ("two", "also", 1), (None, "x", 1), ("x", None, 1), ("p", "q", 1), ("q", "p", 1)]
    return aliases.closure(spark.createDataFrame(rows, "alias string, target string, priority int"))


def test_aliases_are_followed_through_chains_and_circles(names):
    got = {r.alias: r.canonical for r in names.collect()}
    assert {got[f"n{k:03d}"] for k in range(100)} == {"n100"}
    assert {k: v for k, v in got.items() if k[0] != "n"} == {"d": "c", "e": "c", "into": "c", "two": "also", "q": "p"}


def test_many_names_and_few_give_the_same(spark, names, monkeypatch):
    maps = [None, {}, {"a": "1"}, {"q": "1", "w": "2"}, {k: str(n) for n, k in enumerate("abcdefgxyz")}, {k: str(n) for n, k in enumerate("zyxcba")}]
    df = ballots(spark, *[{"ballot_id": str(k), "choices": m} for k, m in enumerate(maps)])
    read = lambda: {r.ballot_id: r.choices for r in aliases.ballots_renamed(df, names, ["ballot_id"]).collect()}
    few = read()
    monkeypatch.setattr(aliases, "FEW", 0)
    assert read() == few and few["0"] is None and few["1"] == {}


def test_aliases_reach_every_section(spark, names):
    df = ballots(spark, {"choices": {"d": "YES", "c": "NO", "z": "NO"}, "ballot_id": "1"}, {"choices": {"z": "YES"}, "ballot_id": "2"}, {"ballot_id": "3"}, {"choices": {"d": "NO", "e": "YES"}, "ballot_id": "4"})
    got = {r.ballot_id: r.choices for r in aliases.ballots_renamed(df, names, ["ballot_id"]).collect()}
    assert got == {"1": {"c": "YES", "z": "NO"}, "2": {"z": "YES"}, "3": None, "4": {"c": "YES"}}
    roster = spark.createDataFrame([("d",), ("c",), ("z",)], "member string")
    assert sorted(r.member for r in aliases.roster_renamed(roster, names).collect()) == ["c", "z"]
    stats = spark.createDataFrame([("d", 1, 2), ("c", 3, 4), ("z", 5, 6)], "member string, total long, yes long")
    assert sorted(map(tuple, aliases.stats_renamed(stats, names).collect())) == [("c", 4, 6), ("z", 5, 6)]
    said = spark.createDataFrame([("d", "of d"), ("c", ""), ("e", "of e"), ("z", "of z")], "member string, summary string")
    assert sorted(map(tuple, aliases.summaries_renamed(said, names).collect())) == [("c", "of d"), ("z", "of z")]
