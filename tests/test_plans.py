"""How often the rows of a query move: a sharp bound on the exchanges of its plan, so that its shuffle grows as its input does."""

import pytest

from rollcall.plans import registry

QUERIES, _ = registry.load()
SF = "/root/testdata/sf0.001"

#: exchanges by hash that a query may have
MOST = {"merge_ballots": 1, "policy_category_carry": 1, "policy_aggressive": 1, "policy_ultra": 1, "policy_frame_item": 2, "session_reports": 2, "scored_join": 2, "ballots_renamed": 1, "import_member_stats": 3}


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(MOST))
def test_rows_move_once(spark, name):
    assert plan(spark, name).count("Exchange hashpartitioning") <= MOST[name]


@pytest.mark.parametrize("name, word, most", [("export_json", "get_json_object", 0), ("whitelist_choices", "map_entries", 2), ("rename_members", "map_entries", 2), ("alias_closure", "Broadcast", 0)])
def test_costly_steps_stand_once(spark, name, word, most):
    assert plan(spark, name).count(word) <= most


def test_scored_join_sends_common_texts_to_all_tasks(spark):
    """Both sides look up the words and phrases of common texts, with no further move of rows."""
    p = plan(spark, "scored_join")
    assert p.count("BroadcastHashJoin") == 2 and p.count("Exchange hashpartitioning") <= MOST["scored_join"]


def test_cheap_tests_before_patterns_change_no_text(spark):
    """The normalisers against their patterns alone, on texts with white space and line ends of every kind."""
    from itertools import product

    from pyspark.sql import functions as F

    from rollcall.functions import text as tx

    heads, bodies = ("", " ", "Item 3 : ", "no. 4", "ITEM 1:no.2 ", "7a. ", "\x0b", "\u2028"), ("", "Lease  (see\tnote) of", "a", "Council Committee Meetings and Announcements")
    tails = ("", " (For Adoption Only) ", "(for presentation)\n", " expenditure: $1,2.", "expenditure: none \x85", " Expenditure: x\ny", "\t\r\n", " \u2029", " (for discussion) (for adoption only)")
    df = spark.createDataFrame([("".join(x),) for x in product(heads, bodies, tails)] + [(None,)], "x string")
    plain = lambda a, ps, to="": a if not ps else plain(F.regexp_replace(a, ps[0], to), ps[1:], to)
    sides, low = (f"^{tx.SPACES}|{tx.SPACES}$",), F.lower(F.coalesce("x", F.lit("")))
    light = plain(plain(plain(low, sides), (*tx.PREFIXES, *tx.LIGHT_SUFFIXES)), (tx.SPACES,), " ")
    phrases = plain(plain(plain(low, sides), (tx.SPACES,), " "), (*tx.PREFIXES, *tx.SUFFIXES))
    for a, b in tx.PHRASES:
        phrases = F.replace(phrases, F.lit(a), F.lit(b))
    aggressive = plain(plain(plain(phrases, (r"^[0-9]+[a-z]?\s*\.?\s*", r"^[a-z]\s*\.?\s*")), (r"\s*\(.*?\)\s*",), " "), (r"\s*expenditure:.*$", r"\s*$"))
    x = F.col("x")
    got = df.select("x", F.struct(tx.normalise_light(x), tx.normalise_phrases(x), tx.normalise_aggressive(x)).alias("got"), F.struct(light, phrases, aggressive).alias("want")).collect()
    assert len(got) == 289 and all(tuple(r.got) == tuple(r.want) for r in got)
