"""Ordered documents byte by byte, runs that break off, and validation."""

import csv
import io
import json

import pytest
from pyspark.sql import functions as F

from rollcall import api
from rollcall.operators import catalog_run
from rollcall.sources import exports, validation, variants

BALLOT = "session_id string, in_ord long, item_text string, outcome string, tally struct<ayes:int,noes:int,abstentions:int>, choices map<string,string>, recused int, video_ts long, marker_id string, frame_number int, ts_estimated boolean"
SESSION = "session_id string, date string, time string, video_url string, agenda_url string"


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


@pytest.fixture(scope="module")
def rows(spark):
    held = [(str(s), k, f'Item "{k}", a\\b é' if k % 3 else None, "Passed", (k, 1, 0) if k % 2 else None, {"A B": "YES", "C": "NO"} if k % 4 else ({} if k % 8 else None), k % 2, 5 * k, "m" if k else None, k, k % 2 == 0) for s in (3, 1, 2) for k in range(9)]
    in_order = F.create_map(*map(F.lit, ("A B", "YES", "C", "NO")))  # a map made of a dict has no order
    ballots = spark.createDataFrame(held, BALLOT).withColumn("choices", F.when(F.size("choices") > 0, in_order).otherwise(F.col("choices")))
    return held, ballots.repartition(3), spark.createDataFrame([("1", "2024-01-02", "18:30", "v", None)], SESSION)


def test_json_document_is_its_definition(rows, tmp_path):
    held, ballots, sessions = rows
    exports.write_document(exports.json_document(ballots, sessions, "2024-05-05T00:00:00Z"), str(tmp_path / "j"), 4)
    assert len(list((tmp_path / "j").glob("part-*"))) > 1
    votes = []
    for s, _, item, outcome, tally, choices, _, ts, marker, frame, guess in sorted(held, key=lambda r: r[:2]):
        known = s == "1"
        votes.append({"meeting_id": s, "date": "2024-01-02" if known else None, "time": "18:30" if known else None, "agenda_item": item, "result": outcome, "vote_tally": tally and dict(zip(("ayes", "noes", "abstentions"), tally, strict=True)), "individual_votes": choices, "video_timestamp": ts, "video_url": "v" if known else None, "agenda_url": None, "meta_id": marker, "frame_number": frame, "timestamp_estimated": guess})
    want = json.dumps({"export_date": "2024-05-05T00:00:00Z", "total_votes": len(votes), "votes": votes}, indent=2, ensure_ascii=False)
    assert text_of(tmp_path / "j") == want + "\n"
    exports.write_document(exports.json_document(ballots.limit(0), sessions, "d"), str(tmp_path / "none"))
    assert text_of(tmp_path / "none") == json.dumps({"export_date": "d", "total_votes": 0, "votes": []}, indent=2) + "\n"


def test_csv_document_has_its_header_first(rows, tmp_path):
    held, ballots, sessions = rows
    exports.write_document(exports.csv_document(ballots, sessions), str(tmp_path / "c"), 3)
    table = list(csv.reader(io.StringIO(text_of(tmp_path / "c"))))
    assert table[0] == list(api.CSV_HEADERS) and len(table) == 28
    assert [r[0] for r in table[1:]] == [s for s in "123" for _ in range(9)]
    assert table[2][:9] == ["1", "2024-01-02", "18:30", 'Item "1", a\\b é', "Passed", "1", "1", "0", "1"] and table[2][-1] == "No"


@pytest.fixture
def parts(spark):
    catalog = spark.createDataFrame([(f"s{k}", k) for k in range(7)], "session_id string, place long")
    texts = ["voting results yea | 7| nay | 2", "public comment", "motion to adopt", None]
    frames = spark.createDataFrame([(f"s{k}", f, texts[(k + f) % 4]) for k in range(6) for f in range(5)], "session_id string, frame_number int, raw_text string")
    return catalog, frames


def ordered(df):
    return sorted(map(tuple, df.collect()))


def test_a_run_that_breaks_off_ends_like_an_unbroken_one(spark, parts, tmp_path, monkeypatch):
    catalog, frames = parts
    whole = ordered(catalog_run.run(catalog, frames, catalog_run.Run(str(tmp_path / "a"), batch=2)))
    assert len(whole) == 7 and whole[6] == ("s6", 6, 0, 0, 0, 0) and whole[0] == ("s0", 0, 5, 4, 3, 2)
    broken = catalog_run.Run(str(tmp_path / "b"), batch=2)
    seen = []

    def lost(found, *a):
        seen.append(1)
        if len(seen) == 3:
            raise OSError("lost")
        return kept(found, *a)

    kept = catalog_run.extracted
    monkeypatch.setattr(catalog_run, "extracted", lost)
    with pytest.raises(OSError):
        catalog_run.run(catalog, frames, broken)
    assert len(ordered(catalog_run.results(spark, broken.sink))) == 4
    assert ordered(catalog_run.run(catalog, frames, broken)) == whole and len(seen) == 5  # the first two were not done again
    one = catalog_run.summary(catalog_run.results(spark, broken.sink)).collect()[0]
    assert (one.sessions, one.completed, one.frames, one.current) == (7, sum(r[5] > 0 for r in whole), 30, "s6")
    assert {r.status for r in catalog_run.session_status(catalog_run.results(spark, broken.sink)).collect()} == {"completed", "failed"}


def test_limit_then_resume(spark, parts, tmp_path):
    catalog, frames = parts
    pick = lambda *a: sorted(r.session_id for r in catalog_run.selected(catalog, *a).collect())
    assert pick(3) == ["s0", "s1", "s2"] and pick(4, "s2") == ["s2", "s3"] and pick(2, "s5") == ["s0", "s1"] and pick(None, "s5") == ["s5", "s6"]
    sink = str(tmp_path / "r")
    assert len(ordered(catalog_run.run(catalog, frames, catalog_run.Run(sink, max_sessions=3)))) == 3
    rest = ordered(catalog_run.run(catalog, frames, catalog_run.Run(sink)))  # sessions that are there are not done again
    assert [r[0] for r in rest] == [f"s{k}" for k in range(7)]


def test_tallies_told_by_texts(spark):
    rows = [("yea | 7| nay! | abstain", (7, None)), ("yea | 5| nay | 2| abstain | 0", (5, 2)), ("AYES: 4, NOES: 1", (4, 1)), ("nothing 5", None), (None, None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    assert [tuple(r[0]) if r[0] else None for r in df.select(catalog_run.tally_in_text(F.col("t"))).collect()] == [w for _, w in rows]


def test_issues_and_faults(spark, tmp_path):
    def put(name, value):
        (tmp_path / name).write_text(json.dumps(value))

    put("a.json", {"votes": [{"meeting_id": None, "agenda_item": "x"}, {"meeting_id": "1"}, "text"], "meetings": {"1": {"title": "t"}, "2": {}}})
    put("b.json", {"meetings": [], "metadata": 1})
    put("c.json", {"votes": {}, "meetings": {}, "metadata": None})
    put("d.json", {"votes": [{"meeting_id": "1", "agenda_item": None}], "meetings": {}, "metadata": {}})
    docs = variants.variants(spark, str(tmp_path))
    got = sorted((r.file[-6:], r.issue) for r in validation.issues(docs).collect())
    of_a = ["Meeting 1: Missing required field 'date'", "Meeting 2: Missing required field 'date'", "Meeting 2: Missing required field 'title'", "Vote 1: Missing required field 'agenda_item'", "Vote 2: Missing required field 'agenda_item'", "Vote 2: Missing required field 'meeting_id'"]
    assert got == [("a.json", i) for i in of_a] + [("b.json", "Missing required field: votes")]
    faults = {r.file[-6:]: r.fault for r in validation.first_fault(docs).collect()}
    assert faults == {"a.json": "Missing required key: metadata", "b.json": "Missing required key: votes", "c.json": "Votes must be a list", "d.json": None}
    put("a.json", {"votes": [{"meeting_id": 1, "agenda_item": 2}, {"meeting_id": "1"}, "text"], "meetings": {}, "metadata": 1})
    spark.catalog.clearCache()
    assert {r.fault for r in validation.first_fault(variants.variants(spark, str(tmp_path / "a.json"))).collect()} == {"Vote 1 missing required key: agenda_item"}
