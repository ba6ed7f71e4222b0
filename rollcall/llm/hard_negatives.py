"""Operator 11: hard-negative mining by a vertical scan (BOND).

Vectors are scaled to whole numbers and stored by column: a block of rows holds its first dimension, then its second, and so
on, with each dimension's least and greatest value. For an anchor a block is read in the order of the anchor's descending
magnitudes, a few dimensions at a time. What the unread dimensions can still add lies between sums of their extreme products,
so every row has a lower and an upper bound; rows whose bounds can no longer reach an open window leave the bitmap of
candidates, and those left at the last dimension have their exact score.

The anchors are a stated query set against all rows. They come in blocks of ANCHOR_BYTES, and each block of anchors makes two
scans: one for the positives (the window is the anchor's label, open above), one for the negatives (a window of scores
for each positive). Tasks give out their best few rows for each window, and a window function takes the best of those.

Defined results: rows without label or vector, or with a null or non-finite component, take no part; nor do rows with a component
beyond LIMIT once scaled, as their products could leave a long. Vectors of another length than the anchor's have no score with it.
A null id is no anchor; as a candidate it comes after all ids of its score. Repeated rows are rows of their own: another row
with the anchor's id can be its positive, and a repeated anchor has its rows twice. No rows, no result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, materialise, small_batches

#: Rows of a block, dimensions read between two looks at the bitmap, bytes of anchors in a block of them, greatest scaled component.
ROWS, STEP, ANCHOR_BYTES, LIMIT = 4096, 8, 8 << 20, 1 << 24
#: What stands for a null id among whole numbers: it sorts last.
NO_ID = np.iinfo(np.int64).max


def scaled(df: DataFrame, id_col: str, vector_col: str, label_col: str, label: F.Column | None = None, factor: int = 256) -> DataFrame:
    """row, id, label and q (floor of factor * component) of the rows that take part. label: an expression in place of label_col."""
    q = F.transform(vector_col, lambda x: F.floor(factor * x.cast("double")))
    sound = F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(factor * x.cast("double")) > LIMIT))
    rows = df.where(sound).select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).cast("long").alias("label"), q.cast("array<int>").alias("q"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "*")


BLOCK = "rows array<long>, ids array<long>, labels array<long>, least array<long>, most array<long>, columns binary"


def columnar(rows: DataFrame) -> DataFrame:
    """Blocks of vectors of one length, a column of a block lying together."""

    def block(held: dict) -> pa.RecordBatch:
        q = np.stack(held["q"], 1).astype("<i4")
        lists = [held["row"], held["id"], held["label"], q.min(1), q.max(1)]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([np.asarray(x, np.int64)], pa.list_(pa.int64())) for x in lists), pa.array([q.tobytes()], pa.binary())],
            ["rows", "ids", "labels", "least", "most", "columns"],
        )

    def run(batches):
        open_blocks: dict[int, dict] = {}
        for batch in batches:
            q = batch.column(3)
            values, ends = np.asarray(q.flatten()), np.concatenate(([0], np.cumsum(np.asarray(q.value_lengths()))))
            ids = np.asarray(batch.column(1).fill_null(NO_ID))
            for k, (row, i, label) in enumerate(zip(np.asarray(batch.column(0)), ids, np.asarray(batch.column(2)), strict=True)):
                vector = values[ends[k] : ends[k + 1]]
                held = open_blocks.setdefault(len(vector), {"row": [], "id": [], "label": [], "q": []})
                for name, x in zip(held, (row, i, label, vector), strict=True):
                    held[name].append(x)
                if len(held["row"]) * max(1, len(vector)) >= ROWS * 64:
                    yield block(open_blocks.pop(len(vector)))
        for held in open_blocks.values():
            yield block(held)

    return rows.mapInArrow(run, BLOCK)


class Block:
    """A columnar block as a task reads it."""

    def __init__(self, row: dict):
        self.rows, self.ids, self.labels, self.least, self.most = (np.array(row[c], np.int64) for c in ("rows", "ids", "labels", "least", "most"))
        self.columns = np.frombuffer(row["columns"], "<i4").reshape(len(self.least), len(self.rows))


def vertical_scan(block: Block, anchor: np.ndarray, open_rows: np.ndarray, low: list[int], high: list[int], floors, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the block's rows that may fall in a window [low, high]. floors(): the scores below which each
    window needs no more rows, asked anew at each step with the rows' lower bounds (so far) and places."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    a, least, most = anchor[order], block.least[order], block.most[order]
    worst, best = np.minimum(a * least, a * most), np.maximum(a * least, a * most)
    rest_low = np.concatenate((np.cumsum(worst[::-1])[::-1], [0]))
    rest_high = np.concatenate((np.cumsum(best[::-1])[::-1], [0]))
    at, score = open_rows, np.zeros(len(open_rows), np.int64)
    # sums below 2^53 are exact as doubles, and doubles multiply faster
    kind = np.float64 if int(np.maximum(np.abs(worst), np.abs(best)).sum()) < 1 << 53 else np.int64
    for begin in range(0, len(a) or 1, step):
        end = min(begin + step, len(a))
        part = block.columns[order[begin:end]]
        part = part if len(at) == part.shape[1] else part[:, at]
        score = score + (a[begin:end].astype(kind) @ part.astype(kind)).astype(np.int64)
        lower, upper = score + rest_low[end], score + rest_high[end]
        keep = np.zeros(len(at), bool)
        for lo, hi, floor in zip(low, high, floors(lower, upper), strict=True):
            keep |= (upper >= max(lo, floor)) & (lower <= hi)
        if not keep.all():
            at, score = at[keep], score[keep]
        if not len(at):
            break
    return at, score


class Best:
    """The first k rows of a window, higher scores first, ties by smaller id."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.row = k, *(np.zeros(0, np.int64) for _ in range(3))

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else -(1 << 62)

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(score):
            s, i, r = np.concatenate((self.score, score)), np.concatenate((self.id, ids)), np.concatenate((self.row, rows))
            first = np.lexsort((r, i, -s))[: self.k]
            self.score, self.id, self.row = s[first], i[first], r[first]


def kth(lower: np.ndarray, sure: np.ndarray, k: int) -> int:
    """The k-th greatest lower bound of rows that are surely inside a window."""
    inside = lower[sure]
    return int(np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else -(1 << 62)


FOUND = "anchor long, window int, other long, other_row long, score long"


def scan(blocks: DataFrame, anchors: list[dict], k: int, same_label: bool) -> DataFrame:
    """Each task's first k rows for each window of each anchor. An anchor: row, label, q and windows [(low, high)]."""
    ready = [(a["row"], a["label"], np.asarray(a["q"], np.int64), [w[0] for w in a["windows"]], [w[1] for w in a["windows"]]) for a in anchors]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[Best(k) for _ in low] for _, _, _, low, _ in ready]
        for batch in batches:
            for held in (Block(row) for row in batch.to_pylist()):
                for (row, label, q, low, high), own in zip(ready, best, strict=True):
                    if len(q) != len(held.least) or not low:
                        continue
                    fits = (held.labels == label) & (held.rows != row) if same_label else held.labels != label

                    def floors(lower, upper, own=own, low=low, high=high):
                        return [max(b.floor, kth(lower, (lower >= lo) & (upper <= hi), k)) for b, lo, hi in zip(own, low, high, strict=True)]

                    at, score = vertical_scan(held, q, np.flatnonzero(fits), low, high, floors)
                    for b, lo, hi in zip(own, low, high, strict=True):
                        inside = (score >= lo) & (score <= hi)
                        b.add(score[inside], held.ids[at[inside]], held.rows[at[inside]])
        rows = [(a[0], w, b) for a, own in zip(ready, best, strict=True) for w, b in enumerate(own) if len(b.score)]
        if rows:
            times = [len(b.score) for _, _, b in rows]
            others = np.concatenate([b.id for _, _, b in rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([r for r, _, _ in rows], times), pa.int64()), pa.array(np.repeat([w for _, w, _ in rows], times), pa.int32()),
                    pa.array(others, mask=others == NO_ID), pa.array(np.concatenate([b.row for _, _, b in rows])), pa.array(np.concatenate([b.score for _, _, b in rows])),
                ],
                ["anchor", "window", "other", "other_row", "score"],
            )

    per_task = blocks.mapInArrow(run, FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("other"), "other_row")
    return per_task.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor: F.Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Of each anchor and positive the first different-label rows whose score is between low and high per cent of the positive's.
    rows: as scaled() gives them. Window bounds are worked out as whole numbers, so nothing can overflow."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    kept = scratch.write(rows, "negatives-rows")
    chosen = kept.where(is_anchor)
    size = chosen.agg(F.sum(64 + 8 * F.size("q"))).first()[0] or 0
    results, n = [], -(-size // anchor_bytes)
    blocks = scratch.write(columnar(kept), "negatives-blocks")
    with small_batches(spark, 8):
        for k in range(n):  # one block of anchors at a time, of about anchor_bytes each
            anchors = {r.row: r.asDict() | {"windows": [(-(1 << 62), 1 << 62)]} for r in chosen.where(F.pmod(F.xxhash64("row"), F.lit(n)) == k).collect()}
            for a in anchors.values():
                a["found"] = []
            for r in scan(blocks, list(anchors.values()), positives, same_label=True).collect():  # at most `positives` an anchor
                anchors[r.anchor]["found"].append((r["rank"], r.other, r.score))
            for a in anchors.values():
                a["found"].sort(key=lambda x: x[0])
                a["windows"] = [(-(-low * s // 100), high * s // 100) for _, _, s in a["found"]]
            known = spark.createDataFrame([(a["row"], w, a["id"], other, s) for a in anchors.values() for w, (_, other, s) in enumerate(a["found"])], "anchor long, window int, anchor_id long, positive_id long, positive_score long")
            found = scan(blocks, list(anchors.values()), negatives, same_label=False).join(F.broadcast(known), ["anchor", "window"])
            named = found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            results.append(materialise(named, "negatives"))
    scratch.drop_all_but()
    if not results:
        return spark.createDataFrame([], RESULT)
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out

