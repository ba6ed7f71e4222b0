"""Operator 2: URL filter of gradient-boosted trees on lexical features, under ordered host and path rules.

The features of a URL are its length, path depth, digit ratio, character entropy, parameter counts and the labelled
record of its host's suffixes (in training that of other URLs, by FOLDS). Boosted regression trees (logistic loss,
Newton leaves) are fitted on labelled URLs, at most TRAIN_URLS of them; the fitted ensemble is a few kilobytes and goes
to the tasks as a constant. A rule that fits a URL decides before the trees do; the rule with the longest text wins.

Defined results: a null URL, or one without `://`, has an empty host and path, fits no rule and is scored like any
other text. Repeated rows give repeated results. Without labelled URLs the trees allow everything. Of equally long rules that
fit, the first by its text decides. URLs of any length are read whole; no pages give no rows; only the named columns of pages
are read.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_URLS, FOLDS = 20_000, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the query: verdict and host/path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FEATURES = ("length", "host_length", "depth", "digit_ratio", "entropy", "parameters", "parameter_length", "hyphens", "labels", "suffix_1", "suffix_2")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The fitting rule with the longest text, or null."""
    out = None
    for _, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(slash + p))
        out = F.when(fits, F.lit(text)) if out is None else out.when(fits, F.lit(text))
    return F.lit(None).cast("string") if out is None else out


def parts(url: str | None) -> tuple[str, str, str]:
    """Host, path and query of a URL as text."""
    _, mark, rest = (url or "").partition("://")
    m = re.match(r"([^/?#]*)([^?#]*)\??([^#]*)", rest if mark else "", re.S)
    return m[1].lower(), m[2], m[3]


def _shannon(s: str) -> float:
    n = len(s)
    return -sum(c / n * np.log2(c / n) for c in Counter(s).values()) if n else 0.0


@dataclass
class Suffixes:
    """How often labelled hosts with a suffix were blocked, smoothed towards the overall share."""

    share: float = 0.5
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)

    @staticmethod
    def of(host: str) -> tuple[str, str]:
        labels = host.split(".")
        return labels[-1], ".".join(labels[-2:])

    @classmethod
    def fit(cls, urls: list[str], blocked: np.ndarray) -> Suffixes:
        counts: dict[str, tuple[int, int]] = {}
        for url, b in zip(urls, blocked, strict=True):
            for s in cls.of(parts(url)[0]):
                n, k = counts.get(s, (0, 0))
                counts[s] = n + 1, k + int(b)
        return cls(float(np.mean(blocked)) if len(urls) else 0.5, counts)

    def rate(self, suffix: str) -> float:
        n, k = self.counts.get(suffix, (0, 0))
        return (k + 20 * self.share) / (n + 20)


def features(url: str | None, suffixes: Suffixes) -> list[float]:
    host, path, query = parts(url)
    text = url or ""
    params = [x for x in query.split("&") if x]
    one, two = Suffixes.of(host)
    return [
        len(text), len(host), sum(1 for x in path.split("/") if x), sum(map(str.isdigit, text)) / max(1, len(text)), _shannon(host),
        len(params), len(query), host.count("-"), host.count("."), suffixes.rate(one), suffixes.rate(two),
    ]


@dataclass
class Trees:
    """Boosted trees as arrays: for each tree (feature, threshold, left, right, value) of its nodes."""

    base: float = -20.0
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, left, right, value in self.trees:
            node = np.zeros(len(x), int)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                go_left = x[rows, np.maximum(feature[node], 0)] <= cut[node]
                node = np.where(inner, np.where(go_left, left[node], right[node]), node)
            out += value[node]
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, penalty: float = 1.0, cuts: int = 24) -> Trees:
        if not len(x) or y.min() == y.max():
            return cls(20.0 if len(x) and y[0] else -20.0)
        share = y.mean()
        out = cls(float(np.log(share / (1 - share))))
        margin = np.full(len(x), out.base)
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, cuts + 1)[1:-1])) for f in range(x.shape[1])]
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, p * (1 - p)
            nodes: list[list[float]] = []

            def grow(rows: np.ndarray, level: int) -> int:
                me, g, h = len(nodes), grad[rows].sum(), hess[rows].sum()
                nodes.append([-1, 0.0, 0, 0, rate * g / (h + penalty)])
                best = (1e-6, 0, 0.0)
                if level < depth and len(rows) >= 20:
                    for f, es in enumerate(edges):
                        if len(es):
                            b = np.searchsorted(es, x[rows, f], "left")
                            gs, hs = (np.cumsum(np.bincount(b, v[rows], len(es) + 1))[:-1] for v in (grad, hess))
                            gain = gs**2 / (hs + penalty) + (g - gs) ** 2 / (h - hs + penalty) - g**2 / (h + penalty)
                            k = int(gain.argmax())
                            if gain[k] > best[0]:
                                best = (float(gain[k]), f, float(es[k]))
                if best[0] > 1e-6:
                    go = x[rows, best[1]] <= best[2]
                    nodes[me][:2] = [best[1], best[2]]
                    nodes[me][2] = grow(rows[go], level + 1)
                    nodes[me][3] = grow(rows[~go], level + 1)
                return me

            grow(np.arange(len(x)), 0)
            a = np.array(nodes)
            out.trees.append((a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]))
            margin = out.margin(x)
        return out


@dataclass
class UrlModel:
    suffixes: Suffixes
    trees: Trees

    def probability(self, urls: list[str | None]) -> np.ndarray:
        x = np.array([features(u, self.suffixes) for u in urls], float).reshape(-1, len(FEATURES))
        return 1 / (1 + np.exp(-self.trees.margin(x)))


def fit(urls: list[str], blocked: list[bool]) -> UrlModel:
    """From labelled URLs; beyond TRAIN_URLS a seeded sample of them."""
    if len(urls) > TRAIN_URLS:
        picked = sorted(random.Random(7).sample(range(len(urls)), TRAIN_URLS))
        urls, blocked = [urls[k] for k in picked], [blocked[k] for k in picked]
    y = np.array(blocked, float)
    fold = np.array([zlib.crc32(u.encode("utf-8", "surrogatepass")) % FOLDS for u in urls], int)
    x = np.zeros((len(urls), len(FEATURES)))
    for f in range(FOLDS):  # the record of a URL's suffixes comes from the other folds: its own label is not in it
        own = np.flatnonzero(fold == f)
        rest = Suffixes.fit([u for u, g in zip(urls, fold, strict=True) if g != f], y[fold != f])
        x[own] = np.array([features(urls[k], rest) for k in own], float).reshape(-1, len(FEATURES))
    return UrlModel(Suffixes.fit(urls, y), Trees.fit(x, y))


def seed_urls(n: int = 4000, seed: int = 11) -> list[tuple[str, bool]]:
    """Made labels for where no labelled table is given: n addresses of the two kinds that public block lists tell apart.

    Allowed are names of one word or two, with readable paths; blocked are chains of hyphens, random host names, and
    random paths with many parameters. Both kinds share their top-level domains, so a domain alone decides nothing."""
    r = random.Random(seed)
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    vowels, consonants = "aeiou", "bcdfghklmnprstvw"
    word = lambda k: "".join(r.choice(consonants) + r.choice(vowels) + r.choice(["", "", r.choice("nrst")]) for _ in range(k))
    noise = lambda k: "".join(r.choice(letters + digits) for _ in range(k))
    number = lambda: str(r.randrange(10 ** r.randint(1, 6)))
    readable = lambda: "".join("/" + r.choice([word(r.randint(1, 3)), number()]) for _ in range(r.randint(0, 5)))
    query = lambda k, value: "?" + "&".join(f"{word(1)}={value()}" for _ in range(k)) if k else ""
    out = []
    for k in range(n):
        scheme, end = r.choice(["http", "https"]), r.choice(["com", "org", "net", "info", "co"])
        site = ".".join([word(r.randint(1, 2)) for _ in range(r.randint(0, 2))] + [""])
        if k % 3:
            out.append((f"{scheme}://{site}{word(r.randint(2, 4))}.{end}{readable()}{query(r.choice([0, 0, 1, 2]), number)}", False))
        elif r.random() < 0.6:
            host = "-".join(word(r.randint(1, 2)) for _ in range(r.randint(2, 4)))
            out.append((f"{scheme}://{site}{host}.{r.choice(['', word(3) + '.'])}{end}{readable()}{query(r.choice([0, 0, 1, 2]), number)}", True))
        else:
            path = "".join("/" + noise(r.randint(6, 16)) for _ in range(r.randint(1, 3)))
            out.append((f"{scheme}://{site}{noise(r.randint(12, 24))}.{end}{path}{query(r.randint(2, 7), lambda: noise(8))}", True))
    return out


def judge(df: DataFrame, model: UrlModel, id_col: str = "page_id", url_col: str = "url", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """id_col, host, path, rule, verdict and spam (the trees' probability of block) of every row."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.probability(batch.column(1).to_pylist()), pa.float64())], ["id", "url", "spam"])

    kind = dict(df.dtypes)[id_col]
    scored = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).mapInArrow(run, f"id {kind}, url string, spam double")
    host, path = split_url(F.col("url"))
    ruled = scored.select("id", host.alias("host"), path.alias("path"), "spam").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    said = None
    for v, text in rules:
        said = F.when(F.col("rule") == text, F.lit(v)) if said is None else said.when(F.col("rule") == text, F.lit(v))
    own = F.when(F.col("spam") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(F.col("id").alias(id_col), "host", "path", "rule", (F.coalesce(said, own) if said is not None else own).alias("verdict"), "spam")


def labelled_sample(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked") -> list[tuple[str, bool]]:
    """At most TRAIN_URLS labelled URLs, those with the smallest hashes; rows without a URL or a label are left out."""
    rows = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(url_col).alias("u"), F.col(label_col).cast("boolean").alias("b")).distinct()
    return [(r.u, r.b) for r in rows.orderBy(F.xxhash64("u"), "u", "b").limit(TRAIN_URLS).collect()]


def report(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """host, path, rule and verdict of every page. labelled: a table of url and blocked; without one, seed_urls()."""
    seeds = seed_urls() if labelled is None else labelled_sample(labelled)
    return judge(pages, fit([u for u, _ in seeds], [b for _, b in seeds]))
