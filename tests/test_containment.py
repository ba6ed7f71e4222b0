"""Containment joins within a session against plain loops."""

import random

import pytest

from rollcall.operators import containment


def chosen(item, keys, policy):
    """The rule as it is written down: one loop over the keys in order."""
    if policy != "first" and item in [k for _, k in keys]:
        return min(o for o, k in keys if k == item)
    a, best, score = item.lower(), None, 0
    for o, k in sorted(keys):
        b = k.lower()
        if a in b or b in a:
            if policy != "best":
                return o
            n = len(set(a.split()) & set(b.split()))
            if n > score:
                best, score = o, n
    return best


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(11)
    words = ["a", "lease", "Lease", "of", "land", "the", "Budget", "10A.", "hearing", "x"]
    text = lambda n: " ".join(rng.choices(words, k=rng.randint(1, n)))
    items = [(rng.choice(["1", "2", "3", "9"]), text(6)) for _ in range(400)] + [("1", None), ("1", ""), (None, "lease"), ("1", "  "), ("1", "İstanbul lease")]
    keys, places = [], {}
    for _ in range(150):
        s = rng.choice(["1", "2", "3", "4"])
        places[s] = places.get(s, -1) + 1
        keys.append((s, places[s], text(4)))
    keys += [("1", 900, ""), ("1", 901, None), (None, 0, "lease"), ("2", 902, " ")]
    return items, keys, spark.createDataFrame([(i, *r) for i, r in enumerate(items)], "i int, s string, item string"), spark.createDataFrame(keys, "s string, o int, key string")


@pytest.mark.parametrize("policy", containment.POLICIES)
@pytest.mark.parametrize("group", [20_000, 7])
def test_equals_a_loop(sides, policy, group):
    items, keys, left, right = sides
    got = {r.i: r.o for r in containment.match(left, right, "s", "item", "key", "o", policy, group).collect()}
    want = {}
    for i, (s, t) in enumerate(items):
        own = [(o, k) for x, o, k in keys if x == s and k]
        o = chosen(t, own, policy) if s and t else None
        if o is not None:
            want[i] = o
    assert got == want and len(want) > 50


def test_no_nested_loop_and_no_rows(sides):
    *_, left, right = sides
    plan = containment.match(left, right, "s", "item", "key", "o", "best")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert containment.match(left.limit(0), right, "s", "item", "key", "o", "best").collect() == []
    assert containment.match(left, right.limit(0), "s", "item", "key", "o", "first").collect() == []
