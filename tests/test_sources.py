"""Sources and sinks on files that the tests write."""

import json

import pytest
from pyspark.errors import PySparkException

from rollcall.sources import documents, pages, variants

GOOD = {
    "votes": [
        {"id": "b1", "meeting_id": "14520", "agenda_item": {"number": "5A", "description": "Lease"}, "frame_number": "12", "individual_votes": {"A B": "YES"}, "result": "Passed", "confidence": 0.5},
        {"id": "b2", "meeting_id": "14520", "agenda_item": {"description": "Only text"}, "frame_number": "N/A", "individual_votes": [{"council_member": "A B", "vote": "YES"}, {"name": "A B", "vote": "NO"}]},
        {"id": "b3", "meeting_id": "14521", "agenda_item": None, "individual_votes": None, "confidence": {"overall": 0.25}, "vote_tally": {"ayes": 1, "recusals": 2}},
    ],
    "meetings": {"14520": {"id": "14520", "title": "T", "date": "2024-02-01"}},
}


def put(folder, name, value):
    path = folder / name
    path.write_text(value if isinstance(value, str) else json.dumps(value))
    return str(path)


def test_documents_and_their_ballots(spark, tmp_path):
    put(tmp_path, "a.json", GOOD)
    docs = documents.read_document(spark, str(tmp_path))
    rows = documents.ballots(docs).orderBy("in_ord").collect()
    assert [r.item_text for r in rows] == ["5A. Lease", ". Only text", None]
    assert [r.frame_number for r in rows] == [12, None, None] and [r.recused for r in rows] == [None, None, 2]
    assert [r.choices for r in rows] == [{"A B": "YES"}, {"A B": "NO"}, None]
    assert [r.confidence for r in rows] == [0.5, None, 0.25]
    assert documents.sessions(docs).collect()[0].asDict() == {"session_id": "14520", "title": "T", "date": "2024-02-01", "time": None, "video_url": None, "agenda_url": None}


def test_a_broken_file_fails_beside_a_good_one(spark, tmp_path):
    put(tmp_path, "a.json", GOOD)
    put(tmp_path, "b.json", {"meetings": {}})
    for read in (lambda: documents.read_document(spark, str(tmp_path)).collect(), lambda: variants.with_sections(variants.variants(spark, str(tmp_path)), "votes", "meetings").collect()):
        with pytest.raises(PySparkException, match="b.json lacks votes"):
            read()
    put(tmp_path, "c.json", "{ no json")
    with pytest.raises(PySparkException, match="no JSON document: .*c.json"):
        variants.variants(spark, str(tmp_path)).collect()
    with pytest.raises(PySparkException):
        variants.variants(spark, str(tmp_path / "none.json")).collect()


def test_missing_document_is_empty(spark, tmp_path):
    empty = documents.read_or_empty(spark, str(tmp_path / "none.json"))
    assert empty.collect() == [] and documents.ballots(empty).collect() == []
    assert documents.read_or_empty(spark, put(tmp_path, "a.json", GOOD)).count() == 1


def test_candidates_come_in_file_and_place_order(spark, tmp_path):
    put(tmp_path, "votable_vote_candidates_2.json", [{"frame_number": 7, "raw_text": "x", "meeting_id": "2"}, {"frame_number": "no", "confidence": 1, "meeting_id": "2"}])
    put(tmp_path, "votable_vote_candidates_1.json", [{"frame_number": k, "meeting_id": "1"} for k in range(3)])
    put(tmp_path, "votable_vote_candidates_3.json", [])
    put(tmp_path, "other.json", {"votes": 1})
    rows = variants.candidate_rows(spark, f"{tmp_path}/votable_vote_candidates_*.json").repartition(3).orderBy("in_ord").collect()
    assert [(r.meeting_id, r.frame_number, r.in_ord.place) for r in rows] == [("1", 0, 0), ("1", 1, 1), ("1", 2, 2), ("2", 7, 0), ("2", None, 1)]
    put(tmp_path, "votable_vote_candidates_4.json", {"votes": []})
    with pytest.raises(PySparkException, match="votable_vote_candidates_4.json holds no list"):
        variants.candidate_rows(spark, f"{tmp_path}/votable_vote_candidates_*.json").collect()


def test_sections_entries_and_types(spark, tmp_path):
    docs = variants.variants(spark, put(tmp_path, "a.json", GOOD | {"metadata": None}))
    assert variants.with_sections(docs, "metadata").count() == 1  # an explicit null is there
    v = variants.elements(docs, "votes").orderBy("in_ord")
    assert [r[0] for r in v.select(variants.shown_item(variants.F.try_variant_get("v", "$.agenda_item", "variant"))).collect()] == ["Lease", "Only text", variants.NO_ITEM]
    counted = v.select(variants.counted_choices(variants.F.try_variant_get("v", "$.individual_votes", "variant")))
    assert [r[0] for r in counted.collect()] == [{"A B": "YES"}, {}, {}]
    kept = v.select(variants.defaulted(variants.F.col("v"), "agenda_item", "string", "none"), variants.defaulted(variants.F.col("v"), "result", "string", "none"))
    assert [tuple(r) for r in kept.collect()][1:] == [('{"description":"Only text"}', "none"), (None, "none")]
    assert [(r.key, r.file[-6:]) for r in variants.entries(docs, "meetings").collect()] == [("14520", "a.json")]
    with pytest.raises(PySparkException, match="holds no object votes"):
        variants.entries(docs, "votes").collect()


def test_shown_items(spark):
    rows = [('"text"', "text"), ('""', variants.NO_ITEM), ("null", variants.NO_ITEM), ('{"number":"5A"}', "5A"), ('{"number":"5A","description":""}', "5A"), ("{}", variants.NO_ITEM), ('{"description":"d","number":"1"}', "d")]
    df = spark.createDataFrame(rows, "j string, want string").withColumn("v", variants.F.parse_json("j"))
    assert all(r.got == r.want for r in df.select("want", variants.shown_item(variants.F.col("v")).alias("got")).collect())


def test_frames_and_sessions_of_folders(spark, tmp_path):
    for s, numbers in (("14520", (3, 12)), ("14521", (1,))):
        folder = tmp_path / f"votable_frames_{s}"
        folder.mkdir()
        for k in numbers:
            (folder / f"frame_{k:06d}.jpg").write_bytes(b"x")
    (tmp_path / "votable_frames_14521" / "note.txt").write_text("x")
    assert sorted((r.session_id, r.frame_number) for r in documents.frames(spark, str(tmp_path)).collect()) == [("14520", 3), ("14520", 12), ("14521", 1)]
    assert sorted(r.session_id for r in documents.framed_sessions(spark, str(tmp_path)).collect()) == ["14520", "14521"]


def test_catalog_falls_back(spark, tmp_path):
    sample = [("1", "sample", None, None, None, 1, 1, False)]
    assert pages.catalog(spark, str(tmp_path / "none.json"), sample=sample).collect()[0].title == "sample"
    path = put(tmp_path, "c.json", [{"clip_id": "9", "title": "file"}])
    assert [r.title for r in pages.catalog(spark, str(tmp_path / "none.json"), path, sample=sample).collect()] == ["file"]


def test_catalog_of_listing_pages(spark, tmp_path):
    html = '<a href="/p?clip_id=14001&x=1"> Council </a><a href="/p?clip_id=14001">Again</a><a href="/p?clip_id=99">no</a><a href="/p?clip_id=14002"></a><a href="/p?meta_id=14003">m</a>'
    listing = spark.createDataFrame([(html,), (None,)], "html string")
    got = pages.catalog(spark, str(tmp_path / "none.json"), pages=listing, sample=[("1", "sample", None, None, None, 1, 1, False)])
    assert sorted((r.clip_id, r.title) for r in got.collect()) == [("14001", "Again")] and got.columns == [c.split()[0] for c in pages.CATALOG.split(", ")]
    none = spark.createDataFrame([("no links",)], "html string")
    assert [r.title for r in pages.catalog(spark, pages=none, sample=[("1", "sample", None, None, None, 1, 1, False)]).collect()] == ["sample"]


def test_versions_dry_runs_and_the_latest(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "id int, t string"
    one, two = (spark.createDataFrame([(k, f"v{k}")], schema) for k in (1, 2))
    assert documents.read_version(spark, path, schema).collect() == []
    documents.write_document(one, path, "20240101_000000", dry_run=True)
    assert documents.versions(spark, path) == []
    documents.write_document(one, path, "20240101_000000")
    documents.write_document(two, path, "20240102_000000")
    with pytest.raises(PySparkException):
        documents.write_document(one, path, "20240101_000000")
    (tmp_path / "out" / "v=20240103_000000").mkdir()  # a run that broke off
    assert documents.versions(spark, path) == ["20240101_000000", "20240102_000000"]
    assert documents.read_version(spark, path, schema).collect()[0].id == 2
    assert documents.read_version(spark, path, schema, "20240101_000000").collect()[0].id == 1


def test_session_files_and_mirror(spark, tmp_path):
    df = spark.createDataFrame([("1", 5), ("2", 6), ("2", 7)], "session_id string, n int")
    pages.write_sessions(df, str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["session_id=1", "session_id=2"]
    got = pages.mirror(df, str(tmp_path / "m"), "session_id").collect()[0]
    assert (got.rows_copy, got.keys_copy, got.agree) == (3, 2, True)


def test_markers_of_a_page(spark):
    html = '<a time="5" x\n data-id="7">a</a> <a time="9" data-id="8">b</a> <a time="11" data-id="7">c</a>'
    df = spark.createDataFrame([(html,), ("none",)], "html string")
    assert [r[0] for r in df.select(documents.markers(df["html"])).collect()] == [{"7": 11, "8": 9}, {}]
