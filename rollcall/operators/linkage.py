"""Record linkage: band, prefix, containment and scored joins. Ties go to the first by build order."""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from rollcall.functions import text as tx

#: Rows of seed keys, and words of a vocabulary, that are sent to all tasks at most; and the characters that index a text.
SEEDS, VOCABULARY, HEAD = 10_000, 500_000, 6
#: Rows of a table that tell which texts are common, and the length of a text that may be one of them.
SEEN, SHORT = 20_000, 500
#: The most common texts of a side whose scores with those of the other side are worked out ahead, so PAIRED * PAIRED at most.
PAIRED = 128


def first_match(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def band_join(left: DataFrame, right: DataFrame, key: str, at: str, other: str, width: int, left_id: str, right_ord: str) -> DataFrame:
    """For each left row, the exact right row or else the first in build order within width. Buckets make the band an
    equi-join, so a key with many rows spreads over its buckets."""
    b = width + 1
    near = right.withColumn("_b", F.explode(F.array(*[F.floor(F.col(other) / b) + d for d in (-1, 0, 1)])))
    joined = left.withColumn("_b", F.floor(F.col(at) / b)).join(near, [key, "_b"]).where(F.abs(F.col(at) - F.col(other)) <= width)
    return first_match(joined, [left_id], F.when(F.col(at) == F.col(other), 0).otherwise(1), F.col(right_ord)).drop("_b")


def _few(df: DataFrame, most: int) -> bool:
    return df.limit(most + 1).count() <= most


def prefix_join(left: DataFrame, keys: DataFrame, item: str, key: str, left_id: str, ord_col: str) -> DataFrame:
    """Equal key, else the first key that starts with the item's number (strictly parted from what follows). Each key and
    each beginning of a key names its first row only, so both ways are equi-joins that give one row for each left row."""
    row = F.struct(*[F.col(c) for c in keys.columns])
    equal = keys.groupBy(F.col(key).alias("_item")).agg(F.min_by(row, F.col(ord_col)).alias("_equal"))
    begun = keys.select(F.explode(F.transform(F.sequence(F.lit(0), F.length(key)), lambda i: F.left(F.col(key), i))).alias("_number"), row.alias("_k"), F.col(ord_col).alias("_o"))
    first = begun.groupBy("_number").agg(F.min_by("_k", "_o").alias("_first"))
    number = F.when(F.contains(F.col(item), F.lit(".")), F.lower(F.trim(F.substring_index(item, ".", 1))))
    found = left.withColumns({"_item": F.lower(F.col(item)), "_number": number}).join(equal, "_item", "left").join(first, "_number", "left")
    hit = found.withColumn("_k", F.coalesce("_equal", "_first")).where("_k is not null")
    return hit.select(*[F.col(c) for c in left.columns], "_k.*")


def containment_join(left: DataFrame, keys: DataFrame, item: str, key: str, left_id: str, ord_col: str, exact_first: bool = False, most: int = SEEDS) -> DataFrame:
    """The first key that equals, holds or is held by the item, for every row of left; the keys are of one session (containment.match
    has them by session). At most most keys are sent to all tasks; with more, the distinct texts meet where the first HEAD
    characters of one occur in the other. The result is the same."""
    a, b = F.lower(F.col(item)), F.lower(F.col(key))
    row = F.struct(*[F.col(c) for c in keys.columns])
    named = keys.where(F.col(key).isNotNull()).groupBy(b.alias("_b")).agg(F.min_by(row, F.col(ord_col)).alias("_k"), F.min(ord_col).alias("_o"))
    items = left.where(F.col(item).isNotNull()).select(a.alias("_a")).distinct()
    if _few(keys, most):
        pairs = items.join(F.broadcast(named), F.contains("_a", "_b") | F.contains("_b", "_a"))
    else:
        pairs = _indexed_pairs(items, named)
    order = F.struct(*([F.col("_a") != F.col("_b")] if exact_first else []), F.col("_o"))
    best = pairs.groupBy("_a").agg(F.min_by("_k", order).alias("_k"))
    return left.withColumn("_a", a).join(best, "_a").select(*[F.col(c) for c in left.columns], "_k.*")


def _indexed_pairs(items: DataFrame, named: DataFrame) -> DataFrame:
    """Texts _a of items and _b of keys of which one holds the other: they meet at the first HEAD characters of the held one."""

    def parts(c: str) -> Column:
        of_length = lambda n: F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(F.col(c), i, F.lit(n)))
        return F.explode(F.array_distinct(F.concat(F.array(F.lit("")), *map(of_length, range(1, HEAD + 1))))).alias("_g")

    held = items.select("_a", parts("_a")).join(named.withColumn("_g", F.left("_b", F.lit(HEAD))), "_g").where(F.contains("_a", "_b"))
    holds = named.select("*", parts("_b")).join(items.withColumn("_g", F.left("_a", F.lit(HEAD))), "_g").where(F.contains("_b", "_a"))
    return held.select("_a", "_b", "_k", "_o").union(holds.select("_a", "_b", "_k", "_o"))


def overlap_join(left: DataFrame, right: DataFrame, text: str, other: str, left_id: str, right_id: str, least: int = 1, most: int = VOCABULARY) -> DataFrame:
    """The right row with most words in common, at least least of them (ties to the smallest id). Ids are unique and not
    null. Words are ordered by rarity on the right; rows that share least words share one of all but the last least - 1
    of their words, so only these are indexed. With least = 1 this leaves none out: for small tables only."""
    words = lambda df, i, t: df.select(i, F.explode(F.array_distinct(F.split(F.regexp_replace(F.lower(t), "[^a-z0-9]+", " "), " "))).alias("_w")).where("_w <> ''")
    b = words(right, right_id, other)
    if _few(b, most) and least > 0:
        return _overlap_with_few(left, b, text, left_id, right_id, least)
    rarity = b.groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    rarity = F.broadcast(rarity) if _few(rarity, most) else rarity

    def ordered(df: DataFrame, i: str, name: str) -> DataFrame:
        known = df.join(rarity, "_w").groupBy(i).agg(F.array_sort(F.collect_list(F.struct("_n", "_w")))["_w"].alias(name))
        return known.where(F.size(name) >= least)

    mine, theirs = ordered(words(left, left_id, text), left_id, "_mine"), ordered(b, right_id, "_theirs")
    index = lambda df, i, name: df.select(i, F.explode(F.slice(name, 1, F.size(name) - least + 1)).alias("_w"))
    met = index(mine, left_id, "_mine").join(index(theirs, right_id, "_theirs"), "_w").select(left_id, right_id).distinct()
    scored = met.join(mine, left_id).join(theirs, right_id).select(left_id, right_id, F.size(F.array_intersect("_mine", "_theirs")).cast("bigint").alias("score"))
    best = scored.where(F.col("score") >= least).groupBy(left_id).agg(F.min_by(F.struct(right_id, "score"), F.struct(-F.col("score"), F.col(right_id))).alias("_best"))
    return best.select(left_id, "_best.*")


def _overlap_with_few(left: DataFrame, words: DataFrame, text: str, left_id: str, right_id: str, least: int) -> DataFrame:
    """overlap_join where the words of the right side, a row a word and id, are few enough to be sent to all tasks: every left row counts
    its words' lists of ids by itself, so nothing is shuffled and no pair becomes a row."""
    import numpy as np

    rows = words.select(right_id, "_w").collect()  # at most the caller's bound
    ids = sorted({r[0] for r in rows})
    place = {i: k for k, i in enumerate(ids)}
    lists: dict[str, list[int]] = {}
    for i, w in rows:
        lists.setdefault(w, []).append(place[i])
    sent = left.sparkSession.sparkContext.broadcast({w: np.array(x, np.int32) for w, x in lists.items()})
    own = left.select(left_id, F.array_distinct(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " ")).alias("_words"))

    def run(batches):
        import pyarrow as pa

        known = sent.value
        for batch in batches:
            best, score = [], []
            for own_words in batch.column(1).to_pylist():
                found = [known[w] for w in own_words or () if w in known]
                if not found:
                    best.append(None), score.append(0)
                    continue
                hits = np.concatenate(found)
                if len(ids) <= 4 * len(hits):
                    at, counts = None, np.bincount(hits, minlength=len(ids))
                else:
                    at, counts = np.unique(hits, return_counts=True)
                k = int(counts.argmax())  # the first of the most, so the smallest id
                best.append(ids[k if at is None else at[k]]), score.append(int(counts[k]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, kinds[1]), pa.array(score, pa.int64())], ["a", "b", "score"])

    kinds = [to_arrow_type(df.schema[c].dataType) for df, c in ((left, left_id), (words, right_id))]
    a, b = (df.schema[c].dataType.simpleString() for df, c in ((left, left_id), (words, right_id)))
    out = own.mapInArrow(run, f"a {a}, b {b}, score bigint").where(F.col("score") >= least)
    return out.select(F.col("a").alias(left_id), F.col("b").alias(right_id), "score")


def marker_times(ballots: DataFrame, markers: DataFrame) -> DataFrame:
    """Ballots with a marker take its seconds, or an estimate by frame rate where it has none; others stay as they are."""
    side = markers.select("session_id", "marker_id", F.col("seconds").cast("bigint").alias("_s"))
    marked = F.coalesce(F.length("marker_id") > 0, F.lit(False))
    out = ballots.join(side, ["session_id", "marker_id"], "left")
    by_rate = F.floor(F.col("frame_number") / 30).cast("bigint")
    out = out.withColumn("video_ts", F.when(marked, F.coalesce("_s", by_rate)).otherwise(F.col("video_ts")))
    return out.withColumn("ts_estimated", F.when(marked, F.col("_s").isNull()).otherwise(F.col("ts_estimated"))).drop("_s")


def _common(df: DataFrame, text: str, item: bool) -> DataFrame | None:
    """The texts met twice among the first SEEN rows of df, the most frequent first, with a number and with_match_parts; None if there are none."""
    import pyarrow as pa

    seen = Counter(r[0] for r in df.select(F.when(F.length(text) <= SHORT, F.col(text))).limit(SEEN).collect())
    often = [x for x, times in seen.most_common() if x is not None and times > 1]
    if not often:
        return None
    rows = df.sparkSession.createDataFrame(pa.table({"_no": pa.array(range(len(often)), pa.int32()), "_text": pa.array(often, pa.string())}))
    return tx.with_match_parts(rows, "_text", "_known", item)


def _with_parts(df: DataFrame, text: str, out: str, item: bool, common: DataFrame | None) -> DataFrame:
    """df with out: with_match_parts of its text, and out_no: the text's number if it is one of the PAIRED most common texts, for which
    out is null. Other common texts are looked up, all others worked out in their rows by the same expressions: what is sent
    spares work and changes no result."""
    no = f"{out}_no"
    if common is None:
        return tx.with_match_parts(df, text, out, item).withColumn(no, F.lit(None).cast("int"))
    paired = F.col("_no") < PAIRED
    sent = common.select("_text", F.when(paired, F.col("_no")).alias(no), F.when(~paired, F.col("_known")).alias("_known"))
    found = df.join(F.broadcast(sent), F.col(text) == F.col("_text"), "left")
    own = tx.with_match_parts(found, text, "_own", item, F.col("_text").isNull())
    return own.withColumn(out, F.coalesce("_known", "_own")).drop("_text", "_known", "_own")


def _match_score(a: str, b: str) -> Column:
    """The score of an item's parts with a marker's."""
    found = F.bit_count(F.col(f"{a}.phrases").bitwiseAND(F.col(f"{b}.phrases"))) + F.when(F.contains(f"{b}.text", f"{a}.number"), 1).otherwise(0)
    return 10 * found + 2 * F.size(F.array_intersect(f"{a}.words", f"{b}.words")) + F.when(F.abs(F.col(f"{a}.n") - F.col(f"{b}.n")) < 50, 1).otherwise(0)


def _paired(common: DataFrame | None, out: str) -> tuple[DataFrame | None, int, Column]:
    """The PAIRED most common texts, how many they are, and their parts as a constant list by their numbers."""
    if common is None:
        return None, 0, F.lit(None)
    top = common.where(F.col("_no") < PAIRED).select(F.col("_no").alias(f"{out}_no"), F.col("_known").alias(out))
    rows = top.select(f"{out}_no", F.to_json(out)).collect()
    kind = f"array<{top.schema[out].dataType.simpleString()}>"
    return top, len(rows), F.from_json(F.lit("[" + ",".join(r[1] for r in sorted(rows)) + "]"), kind)


def scored_join(left: DataFrame, right: DataFrame, key: str, left_id: list[str], right_ord: str, least: int = 5) -> DataFrame:
    """For each left item (item_text) the right one (marker_text) of the same key with the best score, if at least least:
    10 for each key phrase of the item in the marker's text, 2 for each word in common, 1 for lengths within 50. Ties go
    to the first by right_ord. Only rows of one key meet."""
    # words and phrases are worked out before rows meet; a pair only compares them, and a pair of the most common texts looks its score up
    items, markers = _common(left, "item_text", True), _common(right, "marker_text", False)
    a, b = _with_parts(left, "item_text", "_a", True, items), _with_parts(right, "marker_text", "_b", False, markers)
    (top_a, _, parts_a), (top_b, n, parts_b) = _paired(items, "_a"), _paired(markers, "_b")
    joined = a.join(b, key)
    for out, common, parts in (("_a", items, parts_a), ("_b", markers, parts_b)):
        joined = joined if common is None else joined.withColumn(out, F.coalesce(out, F.get(parts, F.col(f"{out}_no"))))
    score = _match_score("_a", "_b")
    if items is not None and markers is not None:
        ahead = top_a.crossJoin(F.broadcast(top_b)).select("_a_no", "_b_no", score).collect()  # at most PAIRED * PAIRED
        score = F.coalesce(F.get(F.from_json(F.lit(json.dumps([r[2] for r in sorted(ahead)])), "array<int>"), F.col("_a_no") * n + F.col("_b_no")), score)
    joined = joined.withColumn("score", score).drop("_a", "_b", "_a_no", "_b_no")
    return first_match(joined, left_id, F.col("score").desc(), F.col(right_ord)).where(F.col("score") >= least)


def timed_markers(ballots: DataFrame, markers: DataFrame, key: str, ballot_id: list[str], least: int = 5) -> DataFrame:
    """Ballots with the marker that fits their item best (scored_join), if a time is known for it. Ballots that have a marker and a
    time that is not estimated are left as they are. markers: key, marker_id, marker_text, seconds, ord."""
    settled = (F.coalesce(F.length("marker_id"), F.lit(0)) > 0) & F.col("video_ts").isNotNull() & ~F.coalesce("ts_estimated", F.lit(False))
    side = markers.select(key, F.col("marker_id").alias("_m"), "marker_text", F.col("seconds").cast("long").alias("_s"), "ord")
    found = scored_join(ballots.where(~settled).select(key, *[c for c in ballot_id if c != key], "item_text"), side, key, ballot_id, "ord", least)
    best = found.where(F.col("_s").isNotNull()).select(*[F.col(c).alias(f"_b_{c}") for c in ballot_id], "_m", "_s")
    on = [ballots[c].eqNullSafe(best[f"_b_{c}"]) for c in ballot_id]
    out, hit = ballots.join(best, on, "left"), F.col("_m").isNotNull()
    new = {"marker_id": F.coalesce("_m", "marker_id"), "video_ts": F.when(hit, F.col("_s")).otherwise(F.col("video_ts").cast("long")), "ts_estimated": F.when(hit, False).otherwise(F.col("ts_estimated"))}
    return out.withColumns(new).select(*ballots.columns)
