"""Operator 4: benchmark decontamination as a prefix-filtered containment join.

An item's windows (SIZE consecutive words; a shorter item is one window) are the sets to be contained. Their words
are ordered by rarity, the number of documents that hold them. As the whole window must be contained, its necessary
prefix is its one rarest word: documents and windows join on that word's occurrences. A length bound (the window
fits into the document) and a positional bound (the word at the window's offset) leave few candidates, which are
compared word by word. Windows are taken in blocks of at most BLOCK_BYTES, so what is sent to the tasks has a fixed
bound however large the benchmark is; documents are read once per block. With several blocks the hits of a text, few
and small, are gathered under its digest and joined to the rows that have this text; texts are not shuffled.

Defined results: a null or wordless text has no words and no hits; items that are null or wordless match nothing, an
item without an id is named by the empty text; repeated items each count; every document row gets its own result,
also where ids repeat or are null; very long texts are searched whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, slices

SIZE = 10
BLOCK_BYTES = 16 << 20
#: What is no part of a word becomes a space, A-Z become a-z, the rest stays.
WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else 32 if c < 0x30 or 0x3A <= c < 0x61 or 0x7B <= c < 0x80 else c for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> list[list[tuple[str, bytes]]]:
    """The items in blocks of bounded text size; each block alone is what the driver and a task hold."""
    sized = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t")).where("t is not null")
    total = sized.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 + total // block_bytes
    for b in range(n):
        part = sized.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else sized
        yield [(r.i, r.t.encode()) for r in part.collect()], n


def word_counts(docs: DataFrame, text_col: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the vocabulary occurs, over all documents."""

    def run(batches):
        seen: dict[bytes, int] = defaultdict(int)
        for batch in slices(batches):
            for text in byte_rows(batch.column(0)):
                for w in vocabulary.intersection(words_of(text)):
                    seen[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in found.collect()}  # at most the words of one block


class Windows:
    """The windows of a block, keyed by their rarest word."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.items: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for i, text in items:
            for w in windows_of(words_of(text), size):
                self.items[w].add(i)
        self.vocabulary = frozenset(x for w in self.items for x in w)
        self.keys: dict[bytes, dict[tuple[int, int], None]] = {}

    def order(self, counts: dict[bytes, int]) -> Windows:
        for w in self.items:
            k = min(range(len(w)), key=lambda j: (counts.get(w[j], 0), w[j], j))
            self.keys.setdefault(w[k], {})[k, len(w)] = None
        return self

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Where windows occur, and whose they are."""
        spans, whose, keys, n = [], set(), self.keys, len(words)
        if keys.keys().isdisjoint(words):
            return spans, whose
        for at, word in enumerate(words):
            if word in keys:
                for offset, width in keys[word]:
                    begin = at - offset
                    if begin >= 0 and begin + width <= n and (found := self.items.get(tuple(words[begin : begin + width]))):
                        spans.append((begin, begin + width))
                        whose |= found
        return spans, whose


def covered(spans: list[tuple[int, int]]) -> int:
    total = last = 0
    for begin, end in sorted(spans):
        total += max(0, end - max(begin, last))
        last = max(last, end)
    return total


FOUND = "spans array<array<int>>, items array<string>"


def _key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id_col, n_words, spans (word ranges of hits) and items (ids) of every document."""
    two = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    tables = list(_tables(docs, items, text_col, item_id, item_text, size, block_bytes))
    if len(tables) == 1:
        return two.mapInArrow(_matcher(tables[0], "id"), f"id {kind}, n_words long, {FOUND}").withColumnRenamed("id", id_col)
    counted = two.select("id", "text", _key(F.col("text")).alias("key")).mapInArrow(_counter, f"id {kind}, key binary, n_words long")
    out = counted.join(_gathered(docs, text_col, tables), "key", "left").select("id", "n_words", "spans", "items")
    none = [F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c) for c in ("spans", "items")]
    return out.select(F.col("id").alias(id_col), "n_words", *none)


def hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, spans and items of every distinct text of docs that holds a window; clean() removes the rows with such texts."""
    return _gathered(docs, text_col, list(_tables(docs, items, text_col, item_id, item_text, size, block_bytes)))


def clean(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, as they are, less the rows whose text is in found (a table of keys); rows need no id."""
    return docs.join(found.select("key"), _key(docs[text_col]) == found["key"], "left_anti")


def _tables(docs, items, text_col, item_id, item_text, size, block_bytes):
    for block, _ in item_blocks(items, item_id, item_text, block_bytes):
        windows = Windows(block, size)
        windows.order(word_counts(docs, text_col, windows.vocabulary) if windows.vocabulary else {})
        yield docs.sparkSession.sparkContext.broadcast((dict(windows.items), windows.keys))


def _gathered(docs: DataFrame, text_col: str, tables: list) -> DataFrame:
    """key, spans and items of the distinct texts that are hit, over all blocks."""
    keyed = docs.select(_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    parts = [keyed.mapInArrow(_matcher(t, "key", True), f"key binary, n_words long, {FOUND}") for t in tables]
    every = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.collect_set("spans").alias("spans"), F.collect_set("items").alias("items"))
    return every.select("key", F.array_distinct(F.flatten("spans")).alias("spans"), F.array_distinct(F.flatten("items")).alias("items"))


def _counter(batches):
    for batch in slices(batches):
        n = [len(words_of(text)) for text in byte_rows(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "key", "n_words"])


def _matcher(sent, name: str, hit_only: bool = False):
    """Rows of (name, text) to name, n_words, spans, items; hit_only: of rows with hits, equal texts of a slice once."""

    def run(batches):
        windows = Windows([], 1)
        windows.items, windows.keys = sent.value
        for batch in slices(batches):
            rows, seen = [], set()
            names = batch.column(0)
            for k, text in enumerate(byte_rows(batch.column(1))):
                words = words_of(text)
                spans, whose = windows.hits(words)
                if not hit_only or (spans and text not in seen):
                    seen.add(text)
                    rows.append((k, len(words), [list(x) for x in sorted(set(spans))], sorted(whose)))
            columns = [pa.array([r[j] for r in rows], t) for j, t in ((1, pa.int64()), (2, pa.list_(pa.list_(pa.int32()))), (3, pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([names.take(pa.array([r[0] for r in rows], pa.int64())), *columns], [name, "n_words", "spans", "items"])

    return run


def report(docs: DataFrame, items: DataFrame, **named) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = contamination(docs, items, **named)
    # covered words of sorted ranges: each adds what lies beyond the furthest end so far
    step = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("last")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s[1] - F.greatest(s[0], a["last"]))).cast("long").alias("n"), F.greatest(a["last"], s[1]).alias("last")),
        lambda a: a["n"],
    )
    return found.select(
        found.columns[0], "n_words", step.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], size: int = SIZE) -> list[tuple]:
    """The same report from the definition alone, for tests."""
    windows = [("" if i is None else str(i), w) for i, t in items for w in windows_of(words_of((t or "").encode()), size)]
    out = []
    for i, text in docs:
        words = words_of((text or "").encode())
        hit, whose = np.zeros(len(words), bool), set()
        for name, w in windows:
            for at in range(len(words) - len(w) + 1):
                if tuple(words[at : at + len(w)]) == w:
                    hit[at : at + len(w)] = True
                    whose.add(name)
        ids = ",".join(sorted(whose))
        out.append((i, len(words), int(hit.sum()), len(whose), hashlib.sha256(ids.encode()).hexdigest(), bool(hit.any())))
    return out
