"""Linkage joins against plain loops, each also beyond the size that is sent to all tasks."""

import random

import pytest

from rollcall.operators import linkage

KEYS = ["1. approve budget", "1a. lease", "", "lease", "approve", "1. approve", "a", "2. hearing on the lease of land", "lease"]
ITEMS = ["1. Approve budget", "1. other", "1A. x", "LEASE", "the lease of land", ". none", "no number", "", "hearing", None, "2. Hearing", "9. nothing"]


def first(hits):
    return min(hits)[-1] if hits else None


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(list(enumerate(ITEMS)), "i int, item string"), spark.createDataFrame(list(enumerate(KEYS)), "o int, key string")


def test_prefix_join(sides):
    left, keys = sides
    got = {r.i: r.o for r in linkage.prefix_join(left, keys, "item", "key", "i", "o").collect()}
    for i, t in enumerate(ITEMS):
        low = None if t is None else t.lower()
        number = low.split(".")[0].strip() if t and "." in t else None
        hits = [(low != k, o, o) for o, k in enumerate(KEYS) if low is not None and (low == k or (number is not None and k.startswith(number)))]
        assert got.get(i) == first(hits), t


@pytest.mark.parametrize("most", [0, 100])
@pytest.mark.parametrize("exact_first", [False, True])
def test_containment_join(sides, most, exact_first):
    left, keys = sides
    got = {r.i: r.o for r in linkage.containment_join(left, keys, "item", "key", "i", "o", exact_first, most).collect()}
    for i, t in enumerate(ITEMS):
        hits = [(exact_first and t.lower() != k, o, o) for o, k in enumerate(KEYS) if t is not None and (k in t.lower() or t.lower() in k)]
        assert got.get(i) == first(hits), t


@pytest.mark.parametrize("least", [1, 3, 5])
@pytest.mark.parametrize("most", [0, 100])
def test_overlap_join(spark, least, most):
    rng = random.Random(least)
    draw = lambda n: [" ".join(f"w{int(rng.expovariate(0.2))}" for _ in range(rng.randrange(12))) for _ in range(n)]
    a, b = draw(40) + [None, "", "!"], draw(30) + [None]
    got = linkage.overlap_join(spark.createDataFrame(list(enumerate(a)), "a int, x string"), spark.createDataFrame(list(enumerate(b)), "b int, y string"), "x", "y", "a", "b", least, most)
    want = []
    for i, x in enumerate(a):
        scores = [(-len(set(x.split()) & set((y or "").split()) - {"!"}), j) for j, y in enumerate(b)] if x else []
        if scores and -min(scores)[0] >= least:
            want.append((i, min(scores)[1], -min(scores)[0]))
    assert sorted(tuple(r) for r in got.collect()) == want


def _score(item, marker):
    """The score of scored_join by plain code."""
    import re

    stop = "THE A AN AND OR BUT IN ON AT TO FOR OF WITH BY".split()
    words = lambda x: [w for w in re.sub(r"[^\w ]", "", re.sub(r"\s", " ", (x or "").upper())).split(" ") if w and w not in stop]
    a, b = words(item), words(marker)
    number = re.match(r"([0-9]+[A-Z]?)\s*\.", item or "", re.ASCII)
    known = [p for p in linkage.tx.KEY_PHRASES if p in (item or "").upper()] + ([number[1]] if number else [])
    return 10 * sum(p in " ".join(b) for p in known) + 2 * len(set(a) & set(b)) + (abs(len(" ".join(a)) - len(" ".join(b))) < 50)


@pytest.mark.parametrize("seen, short", [(0, 500), (20_000, 500), (40, 20)])
def test_scored_join_with_common_texts_worked_out_ahead(spark, monkeypatch, seen, short):
    monkeypatch.setattr(linkage, "SEEN", seen)
    monkeypatch.setattr(linkage, "SHORT", short)
    rng = random.Random(7)
    texts = [None, "", "...", "7A. Approve lease for the parks", "7A . approve lease", "12. Resolution, 7A", "resolution\tof the Planning Commission", "Public Hearing: ordinance", "straße à la carte", "STRASSE  A LA", "lease lease", "ordinance " * 60, "9", "Consent Calendar (see note)", "consent-calendar"]
    draw = lambda n: [(rng.choice("ab"), i, rng.choice(texts) if i % 4 else f"lease {i} approve hearings") for i in range(n)]
    items, markers = draw(60) + [("c", 60, "lease"), (None, 61, "lease")], draw(30) + [("d", 30, "lease"), (None, 31, "lease")]
    left, right = spark.createDataFrame(items, "k string, i int, item_text string"), spark.createDataFrame(markers, "k string, o int, marker_text string")
    want = {}
    for k, i, x in items:
        hits = [(-_score(x, y), o) for m, o, y in markers if k is not None and m == k]
        if hits and -min(hits)[0] >= 5:
            want[i] = (min(hits)[1], -min(hits)[0])
    found = linkage.scored_join(left, right, "k", ["k", "i"], "o")
    rows = found.select("i", "o", "score").collect()
    assert {r.i: (r.o, r.score) for r in rows} == want and len(rows) == len(want) > 30
    assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == (seen > 0)


@pytest.mark.parametrize("paired", [0, 3, 128])
def test_scored_join_with_pairs_of_common_texts_scored_ahead(spark, monkeypatch, paired):
    """Pairs of which both, one or no text is among the most common of its side, on sides whose common texts differ."""
    monkeypatch.setattr(linkage, "PAIRED", paired)
    monkeypatch.setattr(linkage, "SEEN", 60)
    rng = random.Random(9)
    texts = ["", "7A. Approve lease", 'he said "no" \\ {7A}', "Resolution 7A\tof the Planning Commission", "Public Hearing: ordinance", "straße à la\u2003carte", "9", "the of", "12. Consent Calendar"]
    draw = lambda n, of: [(rng.choice("ab"), i, rng.choice(of) if i % 3 else f"lease {i} 7A hearings") for i in range(n)]
    items, markers = draw(90, texts) + [("a", 90, None), ("b", 91, None)], draw(50, texts[1:] + ["a lease"])
    left, right = spark.createDataFrame(items, "k string, i int, item_text string"), spark.createDataFrame(markers, "k string, o int, marker_text string")
    best = {i: min((-_score(x, y), o) for m, o, y in markers if m == k) for k, i, x in items}
    rows = linkage.scored_join(left, right, "k", ["k", "i"], "o").select("i", "o", "score").collect()
    assert sorted(tuple(r) for r in rows) == sorted((i, o, -s) for i, (s, o) in best.items() if -s >= 5) and len(rows) > 40


def test_rows_of_the_most_common_texts_carry_no_parts(spark, monkeypatch):
    """Such a text moves as its number; common texts beyond, and all others, with their parts."""
    monkeypatch.setattr(linkage, "PAIRED", 1)
    df = spark.createDataFrame([(x,) for x in ["lease"] * 3 + ["permit"] * 2 + ["once", None, None]], "t string")
    rows = linkage._with_parts(df, "t", "_a", True, linkage._common(df, "t", True)).collect()
    assert {(r.t, r._a_no, r._a and tuple(r._a.words)) for r in rows} == {("lease", 0, None), ("permit", None, ("PERMIT",)), ("once", None, ("ONCE",)), (None, None, ())}
