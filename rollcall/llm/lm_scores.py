"""Operator 8: language-model scoring by cross-entropy difference.

Two bigram models, one of the target documents and one of all documents, share one vocabulary: every word and every
pair of neighbouring words of the corpus, each counted for itself under a 63-bit hash, so what is gathered grows with
the corpus. Both use the same interpolation p(w | v) = MIX c(v, w) / c(v) + (1 - MIX) (c(w) + 1) / (N + V), V being
the number of distinct words of all documents, and are matched in size: the background's counts are scaled to the
target's number of tokens. A document's score is the mean over its tokens of the target's loss less the background's:
the lower, the closer to the target.

Documents are dealt into slices of about SLICE bytes by a hash of the row. A slice asks for its distinct keys once,
with its own counts of them, at the parts that hold the ranges of keys; a part sums the counts of all slices and
answers each in the order asked; the slice then scores its documents. So a common word costs one entry a slice, and
no task holds more than one slice or one part, each of which has a fixed size, up to the largest row.

Defined results: a null or wordless text has no tokens and 0 for losses and difference; without target documents the
target's model is uniform. Rows that repeat count as often as they occur. A text larger than a slice makes its slice as large
as it is; no documents give no rows; only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, materialise, release
from .jaccard_join import LOWER, WordHashes

#: The slots of a table that is made by hand; counts of a corpus have as many as there are words and pairs.
WORD_SLOTS, PAIR_SLOTS, MIX = 1 << 16, 1 << 20, 0.7
SLICE = 6 << 20
BROADCAST = 1_000_000
U = np.uint64


class Slots:
    def __init__(self):
        self.words = WordHashes()

    def keys(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Keys of a text's tokens (odd), and of the pairs that end at all but the first (even)."""
        words = text.translate(LOWER).split() if text else []
        h = np.fromiter(map(self.words.__getitem__, words), U, len(words))
        with np.errstate(over="ignore"):
            pair = (h[:-1] * U(0x9E3779B97F4A7C15) ^ h[1:]) * U(0xD6E8FEB86659FD93)
            pair ^= pair >> U(32)
        return h | U(1), pair & ~U(1)

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Word slots of a text's tokens, and pair slots of all but the first, within this text."""
        words, pairs = self.keys(text)
        return np.searchsorted(np.unique(words), words), np.searchsorted(np.unique(pairs), pairs)


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: few bytes where they are small, and none of the zeros reach a sort or a shuffle."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype(U).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = zstandard.ZstdDecompressor().decompress(data)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(U).ravel()


def deal(docs: DataFrame, id_col: str, text_col: str, is_target: Column, slice_bytes: int = SLICE) -> tuple[DataFrame, int]:
    """id, text, target and slice of every row, and the number of slices."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(is_target, F.lit(False)).alias("target"))
    n = 1 + (own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // slice_bytes
    return own.withColumn("slice", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int")), n


def count(dealt: DataFrame, n: int) -> tuple[DataFrame, tuple[int, int, int]]:
    """For each slice and part (a range of keys) the background and target counts of the slice's keys, in their order;
    and the number of distinct words, of tokens and of target tokens."""

    def ask(table: pa.Table) -> pa.Table:
        slots, found, wanted = Slots(), [], []
        for text, target in zip(byte_rows(table.column("text").combine_chunks()), table.column("target").to_pylist(), strict=True):
            mine = slots.keys(text)
            found += mine
            wanted += mine if target else ()
        keys, b = np.unique(np.concatenate(found), return_counts=True)
        own, c = np.unique(np.concatenate([*wanted, np.zeros(0, U)]), return_counts=True)
        t = np.zeros(len(keys), U)
        t[np.searchsorted(keys, own)] = c
        ends = np.searchsorted((keys >> U(32)) * U(n) >> U(32), np.arange(n + 1, dtype=U))
        rows = [(p, i, j) for p, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if i < j]
        columns = [[table.column("slice")[0].as_py()] * len(rows), [p for p, _, _ in rows], [pack(np.diff(keys[i:j], prepend=U(0))) for _, i, j in rows], *([pack(x[i:j]) for _, i, j in rows] for x in (b, t))]
        return pa.table([pa.array(x, k) for x, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["slice", "part", "keys", "b", "t"])

    def answer(table: pa.Table) -> pa.Table:
        asked = [np.cumsum(unpack(x), dtype=U) for x in table.column("keys").to_pylist()]
        ends = np.cumsum([0, *map(len, asked)])
        keys, at = np.unique(np.concatenate(asked), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([unpack(x) for x in table.column(c).to_pylist()]).astype(np.float64), len(keys)) for c in ("b", "t")]
        words = (keys & U(1)).astype(bool)
        out = [[pack(s[at[i:j]]) for i, j in zip(ends[:-1], ends[1:], strict=True)] + [None] for s in sums]
        none = [None] * len(asked)
        totals = [none + [int(x)] for x in (words.sum(), sums[0][words].sum(), sums[1][words].sum())]
        columns = [table.column("slice").to_pylist() + [-1], table.column("part").to_pylist() + [-1], *out, *totals]
        return pa.table([pa.array(x, k) for x, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 3), strict=True)], ["slice", "part", "b", "t", "n_words", "n_tokens", "n_wanted"])

    asked = dealt.select("text", "target", "slice").groupBy("slice").applyInArrow(ask, "slice int, part int, keys binary, b binary, t binary")
    counts = materialise(asked.groupBy("part").applyInArrow(answer, "slice int, part int, b binary, t binary, n_words long, n_tokens long, n_wanted long"), "counts")
    totals = counts.where("slice < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_tokens", "n_wanted"))).first()
    release(dealt.sparkSession)
    return counts.where("slice >= 0").select("slice", "part", "b", "t"), tuple(totals)


def losses(counts: np.ndarray, words: np.ndarray, pairs: np.ndarray, slots: int = WORD_SLOTS, tokens: float | None = None, vocabulary: int = WORD_SLOTS) -> float:
    """Mean loss of a text's tokens under one model, whose counts are those of so many word slots, then of pair slots."""
    single = counts[words].astype(np.float64)
    p = (single + 1) / ((counts[:slots].sum(dtype=np.float64) if tokens is None else tokens) + vocabulary)
    before = single[:-1]
    joint = np.minimum(counts[slots + pairs], before)
    p[1:] = MIX * np.divide(joint, before, out=np.zeros_like(before), where=before > 0) + (1 - MIX) * p[1:]
    return float(-np.log(p).mean())


def score(dealt: DataFrame, counts: DataFrame, totals: tuple[int, int, int], id_col: str = "doc_id") -> DataFrame:
    """id_col, n_tokens, target_loss, background_loss and difference of every row."""
    vocabulary, tokens, wanted = totals
    scale = wanted / tokens if wanted else 1.0

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        slots = Slots()
        found = [slots.keys(text) for text in byte_rows(table.column("text").combine_chunks())]
        keys = np.unique(np.concatenate([k for both in found for k in both]))
        order = np.argsort(answers.column("part").to_numpy())
        b, t = (np.concatenate([np.zeros(0, U), *(unpack(data[k]) for k in order)]).astype(np.float64) for data in (answers.column(c).to_pylist() for c in ("b", "t")))
        odd = (keys & U(1)).astype(bool)
        known, pairs = keys[odd], keys[~odd]
        target, background = (np.concatenate([x[odd], x[~odd]]) for x in (t, b * scale))
        n, out = [len(w) for w, _ in found], np.zeros((2, len(found)))
        for k, (w, p) in enumerate(found):
            if len(w):
                at = np.searchsorted(known, w), np.searchsorted(pairs, p), len(known)
                out[:, k] = losses(target, *at, wanted, vocabulary), losses(background, *at, tokens * scale, vocabulary)
        return pa.table([table.column("id"), pa.array(n, pa.int64()), pa.array(out[0]), pa.array(out[1]), pa.array(out[0] - out[1])], ["id", "n_tokens", "target_loss", "background_loss", "difference"])

    kind = dealt.schema["id"].dataType.simpleString()
    both = dealt.select("id", "text", "slice").groupBy("slice").cogroup(counts.groupBy("slice"))
    return both.applyInArrow(run, f"id {kind}, n_tokens long, target_loss double, background_loss double, difference double").withColumnRenamed("id", id_col)


def report(docs: DataFrame, labels: DataFrame, slice_bytes: int = SLICE) -> DataFrame:
    """Target: documents labelled of good quality and not toxic."""
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
    few = good.count() <= BROADCAST  # 8 bytes each
    own = docs.select("doc_id", "text")
    marked = own.join(F.broadcast(good) if few else good, own.doc_id == F.col("_good"), "left")
    dealt, n = deal(marked, "doc_id", "text", F.col("_good").isNotNull(), slice_bytes)
    return score(dealt, *count(dealt, n))
