"""Operator 12: two tokenizers' tokens of one text, laid side by side.

Both encodings of a text spell the same bytes, so each token list is an ascending list of end offsets. The shorter list drives:
each of its ends is sought in the longer one by steps that double and then by halving (galloping). Where the ends are equal
both lists are cut, which gives the groups; the differences of the ranks found give, for each token of the shorter list, the range
of tokens of the longer one that it overlaps, which gives the links.

A task aligns slices of bounded text and writes a row for each slice: what it found for each document, the id pairs linked in
the slice, in how many of its documents, and which pairs each document has how often. Pairs are counted over slices, the most
frequent of each A id is marked, and the counts of a slice's own pairs are sent back to it, one row a slice. So a pair moves once for
each slice that holds it, and no task holds more than a slice (or one text).

Defined results: null and empty texts, and texts that the tokens do not spell byte by byte, have no tokens: zeros and ''.
Repeated rows count as documents of their own. A null id stays null. No documents, no rows. Very long texts are a slice of their
own. Ties of the highest count are all best. Only the two named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_level import byte_level
from .common import Scratch, byte_rows, materialise, slices, small_batches

#: Text bytes of a slice; bits of an id in a packed pair.
SLICE, ID_BITS = 2 << 20, 20
MASK = (1 << ID_BITS) - 1


def gallop(needles: np.ndarray, hay: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each needle the first place in hay (ascending) whose value is not below it. From its start, steps double towards
    the needle until they have passed it; the last step is then halved. All needles step together."""
    n = len(hay)
    start = np.clip(start, 0, n - 1)
    right = hay[start] < needles
    low, high = np.where(right, start, start - 1), np.where(right, start + 1, start)  # hay[low] < needle <= hay[high]
    for go_right in (True, False):
        active, step = np.flatnonzero(right if go_right else ~right), 1
        while len(active):
            if go_right:
                active = active[high[active] < n]
                active = active[hay[high[active]] < needles[active]]
                low[active] = high[active]
                high[active] = np.minimum(high[active] + step, n)
            else:
                active = active[low[active] >= 0]
                active = active[hay[low[active]] >= needles[active]]
                high[active] = low[active]
                low[active] = np.maximum(low[active] - step, -1)
            step *= 2
    active = np.flatnonzero(high - low > 1)
    while len(active):
        middle = (low[active] + high[active]) // 2
        below = hay[middle] < needles[active]
        low[active[below]], high[active[~below]] = middle[below], middle[~below]
        active = active[high[active] - low[active] > 1]
    return high


def driven(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of two ascending end lists over the same bytes: the place in long of each end of short, whether it is equal there, and
    where each short token's range of long tokens begins (it ends at that place)."""
    place = gallop(short, long, start)
    equal = long[place] == short
    first = np.concatenate(([0], place[:-1] + equal[:-1])) if len(place) else place
    return place, equal, first


def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges first..last written out: which range, which place."""
    times = last - first + 1
    which = np.repeat(np.arange(len(times)), times)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)


def aligned(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
    """Links (places in A, places in B) and common ends (places in A, in B) of documents laid end to end; n_a, n_b: their token numbers."""
    doc_a, doc_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    links, common = [], []
    for a_drives in (True, False):
        taken = (n_a <= n_b) if a_drives else (n_a > n_b)
        at_a, at_b = np.flatnonzero(taken[doc_a]), np.flatnonzero(taken[doc_b])
        (at_short, ends_short, n_short), (at_long, ends_long, n_long) = ((at_a, ends_a, n_a), (at_b, ends_b, n_b))[:: 1 if a_drives else -1]
        if not len(at_short):
            continue
        n_short, n_long = n_short[taken], n_long[taken]
        # a document's needles start evenly spread over its part of the longer list
        doc = np.repeat(np.arange(len(n_short)), n_short)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(n_short) - n_short, n_short)
        start = (np.cumsum(n_long) - n_long)[doc] + within * n_long[doc] // n_short[doc]
        place, equal, first = driven(ends_short[at_short], ends_long[at_long], start)
        which, other = spread(first, place)
        pairs = [(at_short[which], at_long[other]), (at_short[equal], at_long[place[equal]])]
        for to, (s, o) in zip((links, common), pairs, strict=True):
            to.append((s, o) if a_drives else (o, s))
    none = np.zeros(0, np.int64)
    return tuple(tuple(np.concatenate([none, *(x[k] for x in found)]) for k in (0, 1)) for found in (links, common))


class Digits:
    """Decimal texts of many ids at once."""

    def __init__(self, n: int):
        texts = np.arange(n).astype("S")
        self.width = np.char.str_len(texts)
        self.digit = np.frombuffer(texts.tobytes(), np.uint8).reshape(n, -1)

    def joined(self, ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids' texts, each followed by its byte of `after`; and where each ends."""
        ends = np.cumsum(self.width[ids] + 1)
        begins = ends - self.width[ids] - 1
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        for k in range(self.digit.shape[1]):
            has = np.flatnonzero(self.width[ids] > k)
            out[begins[has] + k] = self.digit[ids[has], k]
        out[ends - 1] = after
        return out.tobytes(), ends


def group_texts(digits: Digits, a: np.ndarray, b: np.ndarray, common: tuple[np.ndarray, np.ndarray], n_a: np.ndarray, n_b: np.ndarray) -> list[bytes]:
    """'a1,a2|b1;a3|b2,b3' of each document: groups in order, the A ids of a group before its B ids."""
    cut_a, cut_b = (np.sort(x) for x in common)
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[cut_a] = last_b[cut_b] = 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    at_a = np.arange(len(a)) + np.concatenate(([0], cut_b + 1))[group_a]  # B tokens of earlier groups stand before it
    at_b = np.arange(len(b)) + (cut_a + 1)[group_b] if len(b) else np.zeros(0, np.int64)  # and A tokens of its own, too
    ids, after = np.zeros(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.uint8)
    ids[at_a], ids[at_b] = a, b
    after[at_a], after[at_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
    text, ends = digits.joined(ids, after)
    to = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_a + n_b)))]
    return [text[i : j - 1] if j > i else b"" for i, j in zip(to[:-1], to[1:], strict=True)]


class Pair:
    """The two tokenizers: a byte-level BPE file (A) and a SentencePiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.a, self.library = byte_level(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        model = pb.ModelProto()
        with open(path_b, "rb") as f:
            model.ParseFromString(f.read())
        byte = model.SentencePiece.BYTE if hasattr(model, "SentencePiece") else 6
        self.bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == byte else p.piece.replace("▁", " ").encode() for p in model.pieces]
        self.widths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.digits = Digits(max(self.a.size, len(self.bytes_b)))

    def encode(self, src: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        if not src:
            return none, none
        text = src.decode()
        a, b = self.a.encode(" " + text), self.library.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != b" " + src or self.a.encoding.decode_bytes(a) != b" " + src:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.astype("<u4").tobytes())


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<u4").astype(np.int64)


def slices_of(df: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """A row a slice: its documents' ids, counts and group digests, its pairs with their numbers of documents, and for each
    document which pairs it has (places in the slice's list, as differences) and how often."""
    two = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    columns = f"slice long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, pairs array<long>, docs array<long>, sizes array<long>, places binary, times binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, number = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in slices(batches, size=SLICE):
            both = [p.encode(src) for src in byte_rows(batch.column(1))]
            n_a, n_b = (np.array([len(x[k]) for x in both], np.int64) for k in (0, 1))
            a, b = (np.concatenate([x[k] for x in both]) for k in (0, 1))
            del both
            links, common = aligned(np.cumsum(p.a.widths[a]), np.cumsum(p.widths_b[b]), n_a, n_b)
            doc = np.repeat(np.arange(len(n_a)), n_a)
            n_groups, n_links = (np.bincount(doc[x[0]], minlength=len(n_a)) for x in (common, links))
            texts = group_texts(p.digits, a, b, common, n_a, n_b)
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
            own, times = np.unique(doc[links[0]] << 2 * ID_BITS | a[links[0]] << ID_BITS | b[links[1]], return_counts=True)
            of, own = own >> 2 * ID_BITS, own & (1 << 2 * ID_BITS) - 1
            pairs, places, docs = np.unique(own, return_inverse=True, return_counts=True)
            sizes = np.bincount(of, minlength=len(n_a))
            steps = np.diff(places, prepend=0)
            steps[(np.cumsum(sizes) - sizes)[sizes > 0]] = places[(np.cumsum(sizes) - sizes)[sizes > 0]]  # each document starts anew
            lists = [n_a, n_b, n_groups, n_links]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0)),
                    *(pa.array([x], pa.list_(pa.int64())) for x in lists), pa.array([digests], pa.list_(pa.string())),
                    *(pa.array([x], pa.list_(pa.int64())) for x in (pairs, docs, sizes)), pa.array([packed(steps)]), pa.array([packed(times)]),
                ],
                columns_of(columns),
            )
            number += 1

    return two.mapInArrow(run, columns)


def columns_of(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def pair_counts(by_slice: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked) and best (whether no pair of its A id has more)."""
    counts = by_slice.select(F.inline(F.arrays_zip("pairs", "docs"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n"))
    of_a = Window.partitionBy(F.shiftrightunsigned("pair", ID_BITS))  # at most as many rows as B has ids
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(df: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    spark = df.sparkSession
    scratch = Scratch(spark)
    by_slice = scratch.write(slices_of(df, id_col, text_col, path_a, path_b), "alignment", compression="zstd")
    asked = by_slice.select("slice", F.explode("pairs").alias("pair")).join(pair_counts(by_slice), "pair")
    answers = asked.groupBy("slice").agg(F.collect_list(F.struct("pair", (F.col("n") * 2 + F.col("best").cast("long")).alias("value"))).alias("answers"))
    answers = answers.select(F.col("slice"), F.col("answers.pair").alias("asked"), F.col("answers.value").alias("values"))
    met = by_slice.drop("docs").join(answers, "slice", "left")
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
                lists = {c: np.asarray(row[c].values) for c in ("n_a", "n_b", "n_groups", "n_links", "sizes", "pairs")}
                value = np.zeros(len(lists["pairs"]), np.int64)
                if len(value):
                    value[np.searchsorted(lists["pairs"], np.asarray(row["asked"].values))] = np.asarray(row["values"].values)
                of = np.repeat(np.arange(len(lists["sizes"])), lists["sizes"])
                begins = (np.cumsum(lists["sizes"]) - lists["sizes"])[of]
                run_sum = np.concatenate(([0], np.cumsum(unpacked(row["places"].as_py()))))
                places = run_sum[1:] - run_sum[begins]
                times, found = unpacked(row["times"].as_py()), value[places]
                n_best, total = np.zeros(len(lists["sizes"]), np.int64), np.zeros(len(lists["sizes"]), np.int64)
                np.add.at(n_best, of, times * (found & 1))
                np.add.at(total, of, times * (found >> 1))
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, *(pa.array(lists[c]) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(n_best), pa.array(total), row["groups"].values],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    with small_batches(spark, 4):  # a row is a whole slice
        out = materialise(met.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"), "alignment-result")
    scratch.drop_all_but()
    return out.withColumnRenamed("id", id_col)
