"""Operator 13: packing along a space-filling curve.

A document's token ids are hashed into a signed vector, whose logarithms, at unit length, are projected to a few dimensions;
the Hilbert key of its cell there is its place on the curve. Documents are sorted by ranges of that key, so neighbours on the
curve, which are alike, come to lie in the same sequences. Laid end to end along the curve the documents are cut every `size`
ids; what is left at the end is cut into powers of two, which need no padding.

Only keys and counts are sorted: each range sums up its own counts, and a range's first position is the sum of those before it
(one number a range). Ids are moved once, to meet their position.

Defined results: a null or empty text is the end id alone. Equal keys (copies) are dealt by row, so a hot group spreads over
ranges. Repeated rows and ids are documents of their own; a null id stays null. No documents, no pieces. Very long texts are
encoded whole and cut. Only the two named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_level import byte_level
from .common import Scratch, byte_rows, slices

#: Buckets of a hashed vector, dimensions and bits a dimension of the curve, documents whose vectors are held at once.
BUCKETS, DIMS, BITS, AT_ONCE = 256, 4, 10, 500
SLICE = 1 << 20


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of unsigned coordinates of `bits` bits): from the highest bit down, what lies
    below a set bit is mirrored and what lies below an unset one swapped with the first dimension; Gray code is then undone."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(n):
            up = (x[d] >> b & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where(x[-1] >> b & 1, flip ^ ((1 << b) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << 1 | x[d] >> b & 1
    return key


def projector(vocabulary: int, dims: int = DIMS, bits: int = BITS, seed: int = 13):
    """A function from lists of token ids to curve keys. Tables follow from the seed alone."""
    rng = np.random.default_rng(seed)
    bucket = rng.integers(0, BUCKETS, vocabulary)
    sign = rng.integers(0, 2, vocabulary) * 2.0 - 1
    plane = rng.standard_normal((BUCKETS, dims))

    def keys(docs: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(docs)
        place = np.repeat(np.arange(len(docs)), [len(d) for d in docs]) * BUCKETS + bucket[flat]
        sums = np.bincount(place, sign[flat], len(docs) * BUCKETS).reshape(len(docs), BUCKETS)
        sums = np.sign(sums) * np.log1p(np.abs(sums))
        norm = np.sqrt((sums**2).sum(1, keepdims=True))
        at = sums @ plane / np.where(norm, norm, 1)
        share = (1 + np.tanh(0.8 * at)) / 2  # close to the normal distribution function: cells are used alike
        return hilbert(np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)

    return keys


def encoded(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """row, id, n, key and ids (little-endian, as wide as the vocabulary needs) of every document."""
    two = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = byte_level(tokenizer)
        keys, width = projector(max(e.size, end_id + 1)), ids_type(e.size, end_id)
        for batch in slices(batches, size=SLICE):
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                ids = [as_array(e.encode_special(src.decode()) if src else [], end_id) for src in byte_rows(part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(x) for x in ids], pa.int64()), pa.array(keys(ids)), pa.array([x.astype(width).tobytes() for x in ids], pa.binary())],
                    ["row", "id", "n", "key", "ids"],
                )

    kind = two.schema["id"].dataType.simpleString()
    return two.mapInArrow(run, f"row long, id {kind}, n long, key long, ids binary")


def as_array(ids: list[int], end_id: int) -> np.ndarray:
    held = array("i", ids)
    held.append(end_id)
    return np.frombuffer(held, np.int32)


def ids_type(vocabulary: int, end_id: int) -> str:
    return "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"


def positions(documents: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The first position of every row along the curve, and the number of all ids."""
    spark = documents.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    light = documents.select("row", "n", "key").repartitionByRange(ranges, "key", F.xxhash64("row")).sortWithinPartitions("key", F.xxhash64("row"), "row")

    def run(batches):
        part, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                ends = so_far + np.cumsum(np.asarray(batch.column(1)))
                starts = np.concatenate(([so_far], ends[:-1]))
                so_far = int(ends[-1])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(ends), part)), pa.array(starts), pa.array(ends)], ["row", "part", "start", "end"])

    laid = scratch.write(light.mapInArrow(run, "row long, part long, start long, end long"), "packing-order")
    sums = sorted((r.part, r.total) for r in laid.groupBy("part").agg(F.max("end").alias("total")).collect())  # one row a range
    bases, total = [], 0
    for part, n in sums:
        bases.append((part, total))
        total += n
    base = spark.createDataFrame(bases, "part long, base long")
    return laid.join(F.broadcast(base), "part").select("row", (F.col("start") + F.col("base")).alias("position")), total


def tail_cuts(total: int, size: int) -> list[int]:
    """Ends of the last sequences, those after the full ones: powers of two, the largest first."""
    at = total // size * size
    left, out = total - at, []
    for b in range(left.bit_length() - 1, -1, -1):
        if left >> b & 1:
            at += 1 << b
            out.append(at)
    return out


def pieces(start: int, n: int, total: int, size: int, tail: list[int]) -> list[tuple[int, int, int, int]]:
    """(place in the document, length, sequence, offset) of each piece of a document of n ids at position start."""
    full, end, at, out = total // size * size, start + n, start, []
    while at < end:
        if at < full:
            sequence, first, last = at // size, at // size * size, at // size * size + size
        else:
            k = int(np.searchsorted(tail, at, "right"))
            sequence, first, last = full // size + k, tail[k - 1] if k else full, tail[k]
        stop = min(end, last)
        out.append((at - start, stop - at, sequence, at - first))
        at = stop
    return out


def pack(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int = 1, size: int = 2048) -> DataFrame:
    """A row for each piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    with_ids = scratch.write(encoded(df, id_col, text_col, tokenizer, end_id), "packing-ids", compression="zstd")
    placed, total = positions(with_ids, scratch)
    tail, width = tail_cuts(total, size), ids_type(byte_level(tokenizer).size, end_id)
    met = with_ids.select("row", "id", "n", "ids").join(placed.hint("shuffle_hash"), "row").select("id", "n", "position", "ids")

    def run(batches):
        for batch in slices(batches, "ids"):
            rows: list[tuple] = []
            docs, times = [], []
            for k, (n, at, ids) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                four = np.frombuffer(ids, width).astype("<u4").data
                cuts = pieces(at, n, total, size, tail)
                rows += [(a, m, zlib.crc32(four[a : a + m]), n, s, o) for a, m, s, o in cuts]
                docs.append(k), times.append(len(cuts))
            columns = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(docs, times))), *(pa.array(c) for c in columns)],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    out = met.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
