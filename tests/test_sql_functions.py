"""Every table function, called from SQL."""

import pytest
from pyspark.errors import PySparkException

from rollcall import sql


@pytest.fixture(scope="module")
def call(spark):
    rows = [
        ("1_1", "1", 0, "Budget 50%", "Motion Passes", "Motion to adopt", {"Ada Love": "YES", "Bo": "NO"}), ("1_2", "1", 1, None, "Motion Fails", None, {"Ada Love": "ABSTAIN"}),
        ("2_1", "2", 0, "Lease", "passed", "adopt", None), ("1_1", "3", 0, "", None, None, {"Cy": "YES"}),
    ]
    ballots = spark.createDataFrame(rows, "ballot_id string, session_id string, in_ord long, item_text string, outcome string, motion_text string, choices map<string,string>")
    sessions = spark.createDataFrame([("1", "2024-01-05"), ("2", "2024-03-01"), ("3", None)], "session_id string, date string")
    sql.register(spark, ballots, sessions)
    return lambda text: sorted((tuple(r) for r in spark.sql(text).collect()), key=repr)


def test_filters(call):
    ids = lambda args: [(s, k) for _, s, k, *_ in call(f"SELECT * FROM find_ballots({args})")]
    assert len(ids("")) == 4
    assert ids("p_member => 'ADA'") == [("1", 0), ("1", 1)] and ids("p_member => 'ada', p_result => 'failed'") == [("1", 1)]
    assert ids("p_item => '0%'") == [("1", 0)] and ids("p_session => '2'") == [("2", 0)] and len(ids("p_result => 'other'")) == 4
    assert ids("p_from => DATE'2024-02-01'") == [("2", 0)] and ids("p_to => DATE'2024-02-01'") == [("1", 0), ("1", 1)]
    assert len(call("SELECT * FROM find_ballots(p_result => 'passed') ORDER BY session_id, in_ord LIMIT 1 OFFSET 1")) == 1


def test_search_and_lookups(call):
    assert [r[1] for r in call("SELECT * FROM search_ballots('ADOPT')")] == ["1", "2"]
    assert call("SELECT session_id FROM ballot_details('1_1')") == [("1",)] and call("SELECT * FROM ballot_details('none')") == []
    assert [r[3:5] for r in call("SELECT * FROM member_record('ada')")] == [("Ada Love", "YES"), ("Ada Love", "ABSTAIN")]
    assert call("SELECT * FROM member_summary('ada')") == [(2, 1, 1)] and call("SELECT * FROM member_summary('nobody')") == [(0, 0, 0)]
    assert call("SELECT * FROM session_summary('1')") == [("Budget 50%", 1, 1, 0), ("Unknown", 1, 0, 1)]
    assert call("SELECT * FROM ballot_statistics()") == [(4, 3, 2, 1)]
    assert call("SELECT * FROM member_names()") == [("Ada Love",), ("Bo",), ("Cy",)] and call("SELECT * FROM items_of_ballots()") == [("Budget 50%",), ("Lease",)]


def test_extraction(call):
    assert call("SELECT t.* FROM VALUES ('Councilmember Ada yea\nnoise\ncouncilmember bo  nl\ncouncilmember ada NO') v(raw), LATERAL choice_lines(v.raw) t") == [("ada", "no"), ("bo", "nl")]
    html = '<a time="5" data-id="7"></a><b time="9" data-id="8"></b><a time="11" data-id="7"></a>'
    assert call(f"SELECT * FROM page_markers('{html}')") == [("7", 11), ("8", 9)]
    assert call("SELECT * FROM ballots_of_items(map('a', array('1', '2'), 'b', array('3')))") == [("a", "1"), ("a", "2"), ("b", "3")]


def test_parameters_are_checked(call):
    passed = []
    for text in ("search_ballots('')", "search_ballots(NULL)", "member_record('')", "find_ballots(p_from => 'soon')", "member_summary()"):
        try:
            passed.append((text, call(f"SELECT * FROM {text}")))
        except PySparkException:
            pass
    assert passed == []
