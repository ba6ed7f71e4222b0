"""The query API as SQL table functions over two views, and extraction functions over texts.

register() creates them in a session; parameters are typed, and what must be given is checked. Pages are a matter of the calling
query: SELECT * FROM find_ballots(result => 'passed') ORDER BY session_id, in_ord LIMIT 20 OFFSET 40.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROW = "ballot_id STRING, session_id STRING, in_ord BIGINT, item_text STRING, outcome STRING"
COLUMNS = "b.ballot_id, b.session_id, b.in_ord, b.item_text, b.outcome"


def said(word: str, outcome: str = "b.outcome") -> str:
    return f"contains(lower(coalesce({outcome}, '')), '{word}')"


def given(parameter: str, message: str, condition: str) -> str:
    """The condition; an error where the parameter is missing or empty."""
    return f"CASE WHEN coalesce({parameter}, '') = '' THEN raise_error('{message}') ELSE {condition} END"


def members_like(term: str) -> str:
    return f"contains(lower(concat_ws('\\n', map_keys(b.choices))), lower({term}))"


FOUND = "contains(lower(coalesce(b.item_text, '')), lower(p_term)) OR contains(lower(coalesce(b.motion_text, '')), lower(p_term))"

FUNCTIONS = {
    # filters; one that is null is not applied, and a result other than passed and failed is none
    "find_ballots": (
        "p_member STRING DEFAULT NULL, p_session STRING DEFAULT NULL, p_item STRING DEFAULT NULL, p_result STRING DEFAULT NULL, p_from DATE DEFAULT NULL, p_to DATE DEFAULT NULL",
        ROW,
        f"""SELECT {COLUMNS} FROM ballot_rows b LEFT JOIN session_rows s ON b.session_id = s.session_id
            WHERE (p_member IS NULL OR {members_like('p_member')}) AND (p_session IS NULL OR b.session_id = p_session)
              AND (p_item IS NULL OR contains(lower(b.item_text), lower(p_item)))
              AND CASE lower(p_result) WHEN 'passed' THEN {said('pass')} WHEN 'failed' THEN {said('fail')} ELSE true END
              AND (p_from IS NULL OR try_to_date(s.date) >= p_from) AND (p_to IS NULL OR try_to_date(s.date) <= p_to)""",
    ),
    "search_ballots": (
        "p_term STRING",
        ROW,
        f"""SELECT {COLUMNS} FROM ballot_rows b WHERE {given('p_term', 'a search needs a term', FOUND)}""",
    ),
    "ballot_details": ("p_id STRING", ROW, f"SELECT {COLUMNS} FROM ballot_rows b WHERE b.ballot_id = p_id ORDER BY b.session_id, b.in_ord LIMIT 1"),
    "member_record": (
        "p_member STRING",
        "ballot_id STRING, session_id STRING, item_text STRING, member STRING, choice STRING, outcome STRING",
        f"""SELECT b.ballot_id, b.session_id, b.item_text, c.member, c.choice, b.outcome FROM ballot_rows b LATERAL VIEW explode(b.choices) c AS member, choice
            WHERE {given('p_member', 'a record needs a member', 'contains(lower(c.member), lower(p_member))')}""",
    ),
    "member_summary": (
        "p_member STRING",
        "total BIGINT, passed BIGINT, failed BIGINT",
        f"""SELECT count(*), count_if({said('pass')}), count_if({said('fail')}) FROM ballot_rows b
            WHERE {given('p_member', 'a summary needs a member', members_like('p_member'))}""",
    ),
    "session_summary": (
        "p_session STRING",
        "item STRING, total BIGINT, passed BIGINT, failed BIGINT",
        f"""SELECT coalesce(nullif(b.item_text, ''), 'Unknown') AS item, count(*), count_if({said('pass')}), count_if(NOT {said('pass')}) FROM ballot_rows b
            WHERE b.session_id = p_session GROUP BY coalesce(nullif(b.item_text, ''), 'Unknown')""",
    ),
    "ballot_statistics": (
        "",
        "ballots BIGINT, sessions BIGINT, passed BIGINT, failed BIGINT",
        f"SELECT count(*), count(DISTINCT b.session_id), count_if({said('pass')}), count_if({said('fail')}) FROM ballot_rows b",
    ),
    "member_names": ("", "member STRING", "SELECT DISTINCT explode(map_keys(b.choices)) AS member FROM ballot_rows b"),
    "items_of_ballots": ("", "item STRING", "SELECT DISTINCT b.item_text FROM ballot_rows b WHERE b.item_text <> ''"),
    # extraction: the last choice of a name and the last time of a marker win
    "choice_lines": (
        "p_raw STRING",
        "member STRING, token STRING",
        r"""SELECT member, max_by(token, pos) FROM (SELECT pos, regexp_extract(lower(col), '^\\s*councilmember\\s+(\\w+)\\s+([a-z]+)', 1) AS member,
              regexp_extract(lower(col), '^\\s*councilmember\\s+(\\w+)\\s+([a-z]+)', 2) AS token FROM posexplode(split(p_raw, '\n'))) WHERE member <> '' GROUP BY member""",
    ),
    "page_markers": (
        "p_html STRING",
        "marker_id STRING, seconds INT",
        r"""SELECT id, CAST(max_by(t, pos) AS INT) FROM (SELECT pos, col.`0` AS id, col.`1` AS t FROM posexplode(arrays_zip(
              regexp_extract_all(p_html, '(?s)time="(\\d+)".*?data-id="(\\d+)"', 2), regexp_extract_all(p_html, '(?s)time="(\\d+)".*?data-id="(\\d+)"', 1)))) GROUP BY id""",
    ),
    "ballots_of_items": (
        "p_lists MAP<STRING, ARRAY<STRING>>",
        "item STRING, ballot STRING",
        "SELECT k.key, v.col FROM explode(p_lists) AS k(key, value), LATERAL explode(k.value) AS v",
    ),
}


def register(spark: SparkSession, ballots: DataFrame, sessions: DataFrame) -> None:
    """Creates the views ballot_rows and session_rows and the functions on them."""
    ballots.createOrReplaceTempView("ballot_rows")
    sessions.createOrReplaceTempView("session_rows")
    for name, (parameters, columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}")
