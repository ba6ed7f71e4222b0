"""Containment joins within a session: items and keys meet where one holds the other.

A session's keys are put into a multi-pattern automaton that reads the items, and its items into one that reads the keys, so
only pairs that do hold each other are looked at. Sessions are dealt into groups of about GROUP rows. A session with more keys or
items than that is cut into blocks of keys and buckets of items, each block meeting each bucket in a group of its own: no task holds
a whole session. Copies of a text within a session are looked up once.

Policies: 'first' takes the first key that equals, holds or is held; 'exact' a key that is equal as written, else the first;
'best' one that is equal as written, else that with most words in common (at least one), the first on ties.
Null and empty items and keys, and rows without session, meet nothing.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 20_000
POLICIES = ("first", "exact", "best")
FOUND = "item string, key_ord long, inexact boolean, score long"


def _patterns(texts: list[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for k, t in enumerate(texts):
        automaton.add_word(t, k)
    automaton.make_automaton()
    return automaton


def holders(outer: list[str], inner: list[str]):
    """(place in outer, place in inner) wherever the outer text holds the inner one, each pair once. Texts of inner differ."""
    if not inner:
        return
    automaton = _patterns(inner)
    for i, text in enumerate(outer):
        yield from ((i, j) for j in {k for _, k in automaton.iter(text)})


def best_keys(items: list[str], keys: list[tuple[int, str]], policy: str) -> dict[str, tuple[bool, int, int]]:
    """Of each item that meets a key: whether it differs from it as written, the score, and the key's order."""
    best: dict[str, tuple[bool, int, int]] = {}  # item: (inexact, -score, order), the least wins

    def offer(item: str, *rank) -> None:
        if item not in best or rank < best[item]:
            best[item] = rank

    if policy != "first":
        order: dict[str, int] = {}
        for o, k in keys:
            order[k] = min(o, order.get(k, o))
        for item in items:
            if item in order:
                offer(item, False, 0, order[item])
    left = [i for i in items if i not in best]
    lower_items = defaultdict(list)
    for i in left:
        lower_items[i.lower()].append(i)
    lower_keys: dict[str, int] = {}
    for o, k in keys:
        lower_keys[k.lower()] = min(o, lower_keys.get(k.lower(), o))
    item_texts, key_texts = list(lower_items), list(lower_keys)
    words = (lambda t: frozenset(t.split())) if policy == "best" else (lambda t: frozenset())
    item_words, key_words = [words(t) for t in item_texts], [words(t) for t in key_texts]

    def met(i: int, j: int) -> None:
        text, o = item_texts[i], lower_keys[key_texts[j]]
        score = 0
        if policy == "best":
            now = best.get(lower_items[text][0])
            most = min(len(item_words[i]), len(key_words[j]))
            if not most or now and (-most, o) > now[1:]:  # it can't do better
                return
            score = len(item_words[i] & key_words[j])
            if not score:
                return
        for item in lower_items[text]:
            offer(item, policy != "first", -score, o)

    for i, j in holders(item_texts, key_texts):
        met(i, j)
    for j, i in holders(key_texts, item_texts):
        met(i, j)
    return best


def match(left: DataFrame, keys: DataFrame, session: str, item: str, key: str, order: str, policy: str, group: int = GROUP) -> DataFrame:
    """left with the columns of the key row that each item meets; items that meet none are left out. `order` numbers the
    keys of a session; equal keys count as the first of them."""
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}")
    items = left.select(F.col(session).alias("s"), F.col(item).alias("item")).where("s is not null and item <> ''").distinct()
    firsts = keys.select(F.col(session).alias("s"), F.col(key).alias("key"), F.col(order).cast("long").alias("o")).where("s is not null and key <> ''")
    firsts = firsts.groupBy("s", "key").agg(F.min("o").alias("o"))
    size = lambda df, name: df.groupBy("s").agg(F.count(F.lit(1)).alias(name))
    cuts = size(items, "n_items").join(size(firsts, "n_keys"), "s")
    parts = lambda c: F.ceil(F.col(c) / group).cast("int")
    cuts = cuts.select("s", parts("n_items").alias("buckets"), parts("n_keys").alias("blocks"))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    many = F.pmod(F.xxhash64("s"), F.lit(max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))) * 8))
    bin_of = F.when((F.col("buckets") > 1) | (F.col("blocks") > 1), F.concat_ws(":", F.lit("s"), F.col("s"))).otherwise(F.concat_ws(":", F.lit("b"), many))
    a = items.join(cuts, "s").select(bin_of.alias("bin"), "s", "item", dealt("item", "buckets").alias("bucket"), each("blocks").alias("block"))
    b = firsts.join(cuts, "s").select(bin_of.alias("bin"), "s", "key", "o", dealt("key", "blocks").alias("block"), each("buckets").alias("bucket"))
    kind = dict(items.dtypes)["s"]

    def run(x, y):
        import pandas as pd

        of = {s: g for s, g in y.groupby("s")}
        out = []
        for s, g in x.groupby("s"):
            if s in of:
                ks = list(zip(of[s]["o"].tolist(), of[s]["key"].tolist(), strict=True))
                out += [(s, i, o, inexact, -score) for i, (inexact, score, o) in best_keys(g["item"].tolist(), ks, policy).items()]
        return pd.DataFrame(out, columns=["s", "item", "key_ord", "inexact", "score"])

    on = ["bin", "bucket", "block"]
    found = a.groupBy(*on).cogroup(b.groupBy(*on)).applyInPandas(run, f"s {kind}, {FOUND}")
    best = found.groupBy("s", "item").agg(F.min_by("key_ord", F.struct("inexact", -F.col("score"), "key_ord")).alias("_o"))
    best = best.select(F.col("s").alias("_bs"), F.col("item").alias("_bi"), "_o")
    rest = [c for c in keys.columns if c != session]
    rows = keys.select(F.col(session).alias("_s"), F.col(order).cast("long").alias("_ko"), *[F.col(c).alias(f"_k_{c}") for c in rest]).where("_s is not null").dropDuplicates(["_s", "_ko"])
    met = left.join(best, (F.col(session) == F.col("_bs")) & (F.col(item) == F.col("_bi"))).join(rows, (F.col("_bs") == F.col("_s")) & (F.col("_o") == F.col("_ko")))
    return met.select(*left.columns, *[F.col(f"_k_{c}").alias(c) for c in rest if c not in left.columns])
