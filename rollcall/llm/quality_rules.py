"""Operator 7: quality rules learned as an ordered decision list, in Spark expressions only.

Statistics of a text are DataFrame expressions. From labelled statistics (a sample of at most about TRAIN_ROWS
labelled documents, chosen by a hash of their id), sequential covering grows a conjunction of thresholds by
information gain on two thirds of the rows and prunes it on the rest; it is kept if it is precise enough, what it
covers is set aside, and the next one is grown. The list becomes one CASE WHEN expression: the first rule that holds
names the verdict, and a document that no rule names is kept.

Defined results: a null text counts as empty: all statistics are 0 and base_failed is true. Where no labelled rows
are there, the list is empty. Repeated rows give repeated results; only the named columns of df are read. Texts of any length
are counted whole; of several rules that hold the first counts; no documents give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 3000
#: White space other than the space itself, and the symbols that are counted.
BLANKS, SYMBOLS = "\t\n\x0b\x0c\r", "#*$%&|<>"
#: Bits of a packed 3-word window that hold its place; texts with more words are sorted by their words.
PLACE = 24
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _flat(text: Column) -> Column:
    return F.trim(F.translate(text, BLANKS, " " * len(BLANKS)))


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def statistics(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, place_bits: int = PLACE) -> DataFrame:
    """The columns keep (all without it) and the statistics of each row's text.

    3-word windows are sorted as hashes packed with their places. Where neighbours of one hash differ in their words,
    or the places do not fit, the text's windows are sorted by the words themselves; else equal hashes are equal windows."""
    kept = df.columns if keep is None else keep
    flat = df.select(*[F.col(c) for c in kept], F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn("_flat", _flat(F.col("_text")))
    with_words = flat.select(*kept, "_text", F.when(F.col("_flat") == "", F.array().cast("array<string>")).otherwise(F.split("_flat", " +")).alias("_words"))
    at = F.sequence(F.lit(0), F.size("_words") - 3)
    word = lambda i: F.get("_words", i)
    packed = F.transform(at, lambda i: F.shiftleft(F.xxhash64(word(i), word(i + 1), word(i + 2)), place_bits).bitwiseOR(i.cast("long")))
    fits, beyond = F.size("_words").between(3, 1 << place_bits), F.size("_words") > (1 << place_bits)
    grams = with_words.select(*kept, "_text", "_words", F.when(fits, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>")).alias("_grams"))

    place = lambda p: p.bitwiseAND(F.lit((1 << place_bits) - 1)).cast("int")
    same_hash = lambda p, q: F.shiftrightunsigned(p, place_bits) == F.shiftrightunsigned(q, place_bits)
    same_words = lambda i, j: (word(i) == word(j)) & (word(i + 1) == word(j + 1)) & (word(i + 2) == word(j + 2))
    clashes = F.filter("_grams", lambda p, k: same_hash(p, F.get("_grams", k + 1)) & ~same_words(place(p), place(F.get("_grams", k + 1))))
    sure = grams.select("*", (beyond | (F.size(clashes) > 0)).alias("_by_words"))

    spelled = F.transform(at, lambda i: F.struct(word(i).alias("a"), word(i + 1).alias("b"), word(i + 2).alias("c"), i.alias("i")))
    either = sure.select("*", F.when(F.col("_by_words"), F.array_sort(spelled)).alias("_spelled"))
    same = lambda s, t: (s["a"] == t["a"]) & (s["b"] == t["b"]) & (s["c"] == t["c"])
    spelled_again = F.filter("_spelled", lambda s, k: same(s, F.get("_spelled", k - 1)) | same(s, F.get("_spelled", k + 1)))
    hashed_again = F.filter("_grams", lambda p, k: same_hash(p, F.get("_grams", k - 1)) | same_hash(p, F.get("_grams", k + 1)))
    found_at = F.when(F.col("_by_words"), F.transform(spelled_again, lambda s: s["i"])).otherwise(F.transform(hashed_again, place))
    places = either.select(*kept, "_text", "_words", F.sort_array(found_at).alias("_at"))
    covered = F.aggregate(F.transform("_at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_at", k + 1), p + 3) - p)), F.lit(0), lambda a, x: a + x)
    lines = places.select(*kept, "_text", F.size("_words").cast("long").alias("n_words"), covered.cast("long").alias("n_repeat_words"), F.filter(F.split("_text", "\n"), lambda x: _flat(x) != "").alias("_lines"))
    found = F.struct(
        "n_words",
        F.length(F.translate(F.col("_text"), BLANKS + " ", "")).cast("long").alias("word_chars"),
        _count_of(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        _count_of(F.col("_text"), "!?").alias("n_marks"),
        _count_of(F.col("_text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    # The generator keeps filters on the statistics above it: pushed below, they would compute the words anew for each word.
    return lines.select(*kept, F.inline_outer(F.array(found)))


def features() -> dict[str, Column]:
    """What the rules test, by name: shares of the statistics."""
    part = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": part("word_chars", "n_words"),
        "symbol_share": part("n_symbols", "word_chars"),
        "dup_line_share": part("n_dup_lines", "n_lines"),
        "repeat_share": part("n_repeat_words", "n_words"),
        "mark_share": part("n_marks", "n_words"),
        "capital_share": part("n_capitals", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, by: dict[str, Column]) -> Column:
        return by[self.feature] > self.threshold if self.above else by[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _all(rule: list[Test], x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t.holds(x, names)
    return out


def _grow(x: np.ndarray, y: np.ndarray, names: list[str], most_tests: int, cuts: int) -> list[Test]:
    rule: list[Test] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most_tests and (p := int((inside & y).sum())) and p < inside.sum():
        best, gained = None, 1e-9
        before = np.log2(p / inside.sum())
        for f, name in enumerate(names):
            v = x[inside, f]
            for cut in np.unique(np.quantile(v, np.linspace(0, 1, cuts))):
                for above in (True, False):
                    hold = v > cut if above else v <= cut
                    n, q = int(hold.sum()), int((hold & y[inside]).sum())
                    if q and n < len(v) and (gain := q * (np.log2(q / n) - before)) > gained:
                        middle = (v[v <= cut].max() + v[v > cut].min()) / 2  # as far from the rows of either side
                        best, gained = Test(name, above, float(middle)), gain
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x, names)
    return rule


def learn(x: np.ndarray, rejected: np.ndarray, names: list[str], precision: float = 0.97, most_rules: int = 12, most_tests: int = 3, cuts: int = 33) -> list[list[Test]]:
    """Sequential covering: rules that name rejected rows, in order. Deterministic: every third row prunes."""
    rules: list[list[Test]] = []
    left, prune = np.ones(len(x), bool), np.arange(len(x)) % 3 == 2
    while len(rules) < most_rules and (left & rejected).sum() >= 5:
        g, h = left & ~prune, left & prune
        rule = _grow(x[g], rejected[g], names, most_tests, cuts)
        if not rule:
            break

        def worth(r: list[Test]) -> float:
            c = _all(r, x[h], names)
            p = int((c & rejected[h]).sum())
            return (2 * p - int(c.sum())) / max(1, int(c.sum()))

        while len(rule) > 1 and max(worth(rule[:k]) for k in range(1, len(rule))) >= worth(rule):
            rule = max((rule[:k] for k in range(1, len(rule))), key=worth)
        c = _all(rule, x, names) & left
        if (c & rejected).sum() < 3 or (c & rejected).sum() < precision * c.sum():
            break
        rules.append(rule)
        left &= ~c
    return rules


def verdict(rules: list[list[Test]]) -> Column:
    """The ordered list as one expression: the number of the first rule that holds, else null."""
    by, out = features(), None
    for k, rule in enumerate(rules):
        cond = F.lit(True)
        for t in rule:
            cond = cond & t.column(by)
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> list[list[Test]]:
    """Learns from at most about rows labelled documents (1 keeps, 0 rejects), never more than twice as many: a label that is given
    again counts once, and of documents that share ids the first by hash are taken."""
    named = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).where("_id is not null and _label is not null").distinct()
    n = named.count()
    if not n:
        return []
    picked = named.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / n)))
    some = docs.join(F.broadcast(picked), docs[id_col] == F.col("_id")).select("_id", "_label", F.col(text_col).alias("_body"))  # bounded by rows
    by = features()
    found = statistics(some, "_body", ["_id", "_label"]).where(~base_failed()).select("_id", "_label", *[c.alias(k) for k, c in by.items()]).orderBy(F.xxhash64("_id"), "_id", *by).limit(2 * rows).collect()
    if not found:
        return []
    x = np.array([[r[k] for k in by] for r in found], float)
    return learn(x, np.array([r["_label"] == 0 for r in found]), list(by))


def judge(docs: DataFrame, rules: list[list[Test]], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns keep, the statistics, base_failed, rule (the first that holds) and kept."""
    stats = statistics(docs, text_col, keep)
    rest = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return rest.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules = train(docs, labels)
    return judge(docs, rules, "text", ["doc_id"]).select("doc_id", *STATISTICS, "base_failed", "kept", "rule")


def brute_force(text: str | None) -> tuple[int, int, int, int, int]:
    """The statistics from their definitions, for tests."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in SYMBOLS), dup, len(hit)
