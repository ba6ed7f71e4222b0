"""Operator 3: exact Jaccard join of word-shingle sets in a metric space, with the components of its links.

Sets x and y link when TAU_DEN * |x & y| >= TAU_NUM * |x | y|.

1. *First level.* Nearly every document is at Jaccard distance 1 from every other, so drawn documents cannot part the
   corpus: each triangle window would hold all of it. The pivots of this level are the single shingles. A set is at
   distance 1 - 1/|x| from each shingle that it holds and at 1 from all others; the tie goes to the rarest, whose
   Voronoi cell it is in. A linked set may lie in another cell, yet not in any: the two differ by few shingles, so the
   window of a set spans its |x| - ceil(TAU |x|) + 1 rarest shingles, and that of the smaller of two linked sets its
   |x| - ceil(2 TAU / (1 + TAU) |x|) + 1 rarest. A set is replicated to the regions of its window; linked sets meet in
   the region of the first shingle, in the common order, that they have in common. This is a signature join, no more.
   "Rarest" is read from a sketch of all shingles (SLOTS counters, log scale), ties by hash: whatever the sketch says,
   the order is one for all and the result exact; a good sketch keeps shared passages out of the windows.
2. *Regions.* A document is the pivot of each region, every member that can link with it there is compared with it,
   and components of the links found are labelled. Members of one component need no comparison any more. A region
   that still holds several components is joined across these, within the triangle windows
   |d(x, p) - d(y, p)| <= 1 - TAU of its pivot and where the places of the shingle in both sets let them link.
3. *Recursion.* A region with more than CROSS pairs left is cut again, around a pivot p that most members choose, by
   what its members differ in from p: let x' = x ^ p, so x ^ y = x' ^ y'. With c = (1 - TAU) / (1 + TAU), linked sets
   have |x ^ y| <= c (|x| + |y|), and as |x| <= |p| + |x'|, they share at least
   ((1 - c) |x'| + |y'| - c (|y| + |p|)) / 2 of their differences from p. The second part is above 0 unless y is
   linked with p, and two members linked with p are of one component. So a pair shares one of the first differences
   of either side, what p lacks before what it has, and what is left behind the first one in common must reach the
   pair's bound; the rest of the members never meet. Members further than FAR from p are taken by themselves (with
   x' = x), and those within the triangle's window below FAR both ways.

Candidates are then compared by profiles, the numbers of their hashes in PROFILE parts of the shingle space: these
lie at most as far apart as the sets do. All that are left are verified on whole sets. Sets are compared by 64-bit
hashes of shingles; equal sets by 128 bits. Shuffled are hashes and ids, and the sets of candidates only; texts are
not. A shingle that holds many documents is reduced to one row a slice of input before the shuffle of windows, and
what only one slice holds ends there.

Defined results: a document without words has an empty set and is linked with nothing; with fewer words than a
shingle, its whole sequence is its one shingle; equal documents link; rows without an id keep a null component; ids
are expected to be unique, rows that repeat an id share its component. Very long texts are whole sets like all others.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, byte_rows, slices, small_batches

K, TAU_NUM, TAU_DEN = 4, 85, 100
#: A region with more pairs across components is cut again; ids up to BROADCAST are sent to all tasks.
CROSS, BROADCAST = 1_000, 1_000_000
#: Counters of the sketch (a power of two) and counters in one row of it.
SLOTS, BLOCK = 1 << 21, 1 << 15
#: Parts of the profile by which candidates are first compared.
PROFILE = 256
#: Beyond this distance from a pivot a member stands for itself; those within the window below do both.
FAR = 0.45
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
U = np.uint64


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A fixed 64-bit finaliser; seeds give independent hashes."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    def __init__(self, k: int):
        self.k, self.words = k, WordHashes()
        self.factors = [U(int(x)) for x in mix(np.arange(1, k + 1, dtype=U), 99) | U(1)]

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of a text's shingles."""
        words = text.translate(LOWER).split() if text else []
        if not words:
            return np.zeros(0, U)
        h = np.fromiter(map(self.words.__getitem__, words), U, len(words))
        width = min(self.k, len(words))
        n = len(words) - width + 1
        s = np.full(n, U(width))
        for j in range(width):
            s += h[j : j + n] * self.factors[j]
        return np.unique(mix(s, 1))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)


def slot(s: np.ndarray) -> np.ndarray:
    """The sketch's counter of each shingle hash."""
    return (s >> U(65 - SLOTS.bit_length())).astype(np.int64)


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes, on a log scale of eight steps a doubling."""
    return np.minimum(np.rint(8 * np.log2(1.0 + counts)), 255).astype(np.uint8)


def frequencies(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """The sketch over all texts: SLOTS coded counts of distinct sets' shingles (equal sets count once a task).

    Each task sends its counters as blocks, which are summed by block; SLOTS bytes reach the driver, whatever the input."""

    def count(batches):
        shingle, counts, held, size, seen = Shingler(k), np.zeros(SLOTS, np.uint32), [], 0, set()
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                for text in byte_rows(batch.column(0)):
                    s = shingle(text)
                    d = int(mix(s, 3).sum())
                    if not len(s) or d in seen:
                        continue
                    seen.add(d)
                    held.append(slot(s))
                    size += len(s)
                    if size > 1 << 17:
                        add_to(counts, held)
                        held, size = [], 0
                if len(seen) > 1_000_000:
                    seen.clear()
        if held:
            add_to(counts, held)
        yield from blocks(counts)

    def add_to(counts, held):
        slots, times = np.unique(np.concatenate(held), return_counts=True)
        counts[slots] += times.astype(np.uint32)

    def blocks(counts):
        parts = [(j, coded(x).tobytes()) for j, x in enumerate(counts.reshape(-1, BLOCK)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], ["block", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for j, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.exp2(np.frombuffer(x, np.uint8) / 8.0) - 1
                total[j] = total[j] + found if j in total else found
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([coded(x).tobytes() for x in total.values()], pa.binary())], ["block", "counts"])

    kind = "block int, counts binary"
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, kind).repartition("block").mapInArrow(add, kind)
    out = np.zeros(SLOTS, np.uint8)
    for r in parts.collect():
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.counts, np.uint8)
    return out


def window(s: np.ndarray, classes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles whose regions a set is replicated to, rarest first, and where they stand: size, place, and whether
    the window of the smaller of two linked sets spans the place, packed into one number (see size, place, smaller)."""
    n = len(s)
    width = n + 1 - -(-num * n // den)
    close = n + 1 - -(-2 * num * n // (num + den))
    order = np.argsort(classes[slot(s)], kind="stable")[:width]  # s is sorted: ties go by hash
    place = np.arange(width, dtype=np.int64)
    return s[order], np.int64(n << 32) | place << 1 | (place < close)


def size(at: str) -> Column:
    return F.shiftright(F.col(at), 32)


def place(at: str) -> Column:
    return F.shiftright(F.col(at).bitwiseAND(0xFFFFFFFF), 1)


def smaller(at: str) -> Column:
    return F.col(at).bitwiseAND(1) == 1


def can_link(a: str, b: str, num: int, den: int) -> Column:
    """Whether sets can link whose first shingle in common stands at these places."""
    both = size(a) + size(b)
    least = F.ceil((num * both) / F.lit(num + den) - 1e-9)
    return F.least(size(a) - place(a), size(b) - place(b)) >= least


def _regions(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """(sig, id, at, more, p, p_at), of three kinds: a shingle of a window that is new in its slice of input and is held
    by other slices too, with the region's pivot p (more is null); one met before in the slice (more is the id it was
    met at and its place there); and each input row (at is its size, more is first, d1, d2). first is the first row of
    the task with the same set; only first rows have windows. All kinds come from one scan and pass one shuffle; what
    no one else holds, or only windows of larger sets, ends there."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(docs, text_col, k))

    def run(batches):
        shingle, classes, firsts, spread = Shingler(k), shared.value, {}, 0
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                ids, rows, sizes, whose, sigs, ats = batch.column(0).to_pylist(), [], [], [], [], []
                for i, text in zip(ids, byte_rows(batch.column(1)), strict=True):
                    s = shingle(text)
                    sizes.append(len(s))
                    if not len(s) or i is None:
                        rows.append([None, None, None])
                        continue
                    d = tuple(int(x) for x in signed(np.array([mix(s, 3).sum(), mix(s, 4).sum()], U)))
                    f = firsts.setdefault(d, i)
                    if f == i:
                        found, at = window(s, classes, num, den)
                        sigs.append(found), ats.append(at), whose.append(np.full(len(found), i, np.int64))
                    rows.append([f, *d])
                every, owner, at = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((sigs, U), (whose, np.int64), (ats, np.int64)))
                order = np.lexsort(((at & 1) ^ 1, every))
                every, owner, at = every[order], owner[order], at[order]
                new = np.ones(len(every), bool)
                new[1:] = every[1:] != every[:-1]
                head = np.maximum.accumulate(np.where(new, np.arange(len(every)), 0))
                pivot, pivot_at, old = owner[head], at[head], ~new & (owner[head] != owner)
                new = np.flatnonzero(new)[np.argsort(order[new])]  # by document again: such rows take fewer bytes
                spot = signed(mix(np.arange(spread, spread + len(ids), dtype=U), 5))  # input rows go anywhere
                spread += len(ids)
                count = len(new)
                met = pa.ListArray.from_arrays(np.arange(0, 2 * old.sum() + 1, 2, dtype=np.int32), np.stack((pivot[old], pivot_at[old]), 1).ravel())
                for columns in (
                    (signed(every[new]), np.zeros(count, np.int64), owner[new], at[new], pa.nulls(count, met.type)),
                    (signed(every[old]), owner[old], owner[old], at[old], met),
                    (spot, spot, batch.column(0), np.array(sizes, np.int64), pa.array(rows, pa.list_(pa.int64()))),
                ):
                    yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["sig", "salt", "id", "at", "more"])

    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    region = Window.partitionBy("sig", "salt")  # the salt keeps rows met before out of their region's task
    rows = two.mapInArrow(run, "sig long, salt long, id long, at long, more array<long>")
    pivot, members = F.min(F.when(smaller("at"), F.struct("id", "at"))).over(region), F.count(F.lit(1)).over(region)
    held = rows.select("sig", "id", "at", "more", pivot.alias("b"), members.alias("c")).where("more is not null or c > 1 and b is not null")
    return held.select("sig", "id", "at", "more", F.col("b.id").alias("p"), F.col("b.at").alias("p_at"))


def _sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame, k: int) -> DataFrame:
    """(id, s, c, m): the sets of the named documents as bytes, how many of their hashes fall into each of PROFILE parts, and all."""

    def run(batches):
        shingle = Shingler(k)
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                found = [shingle(t) for t in byte_rows(batch.column(1))]
                parts = [np.bincount((x >> U(56)).astype(np.int64), minlength=PROFILE) for x in found]
                profiles = [np.minimum(x, 255).astype(np.uint8).tobytes() for x in parts]
                columns = [pa.array([x.tobytes() for x in found], pa.binary()), pa.array(profiles, pa.binary()), pa.array([len(x) for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "s", "c", "m"])

    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return two.join(_small(ids), "id", "left_semi").mapInArrow(run, "id long, s binary, c binary, m long")


def _small(written: DataFrame) -> DataFrame:
    """A written table of numbers, sent to all tasks where it has no more than BROADCAST rows."""
    return F.broadcast(written) if written.count() <= BROADCAST else written


def _named(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets with these ids, a written table's column."""
    few = ids.count() <= BROADCAST
    ids = ids.toDF("id").distinct()
    return sets.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _near(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that can link by their profiles: these lie no further apart than the sets, counted part by part."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, PROFILE).astype(np.int16) for k in (2, 3))
                total = batch.column(4).to_numpy()
                # no link if the symmetric difference is over (1 - TAU) / (1 + TAU) of both sizes
                keep = np.abs(x - y).sum(1, dtype=np.int64) * (den + num) <= total * (den - num)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    side = lambda i, c, m: sets.select(F.col("id").alias(i), F.col("c").alias(c), F.col("m").alias(m))
    both = side("a", "x", "m").join(_small(pairs), "a").join(side("b", "y", "k"), "b").where(den * F.least("m", "k") >= num * F.greatest("m", "k"))
    return both.select("a", "b", "x", "y", (F.col("m") + F.col("k")).alias("total")).mapInArrow(run, "a long, b long")


def _verify(all_pairs: DataFrame, sets: DataFrame, num: int, den: int, t: Scratch) -> DataFrame:
    """(a, b, d, linked) of each pair that their profiles leave; all_pairs is a written table."""
    pairs = t.write(_near(all_pairs, sets, num, den), "near")

    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            inter, total = [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                inter.append(len(np.intersect1d(x, y, True)))
                total.append(len(x) + len(y))
            both, inter = np.array(total, np.int64), np.array(inter, np.int64)
            union = both - inter
            columns = [a, b, pa.array(1 - inter / np.maximum(union, 1)), pa.array(den * inter >= num * union)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "d", "linked"])

    left = sets.select(F.col("id").alias("a"), F.col("s").alias("x"))
    right = _named(sets, pairs.select("b")).select(F.col("id").alias("b"), F.col("s").alias("y"))
    return left.join(_small(pairs), "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, d double, linked boolean")


def components(links: DataFrame, t: Scratch, rounds: int = 100) -> DataFrame:
    """(id, root) of every id in the links (a, b): smallest labels spread along links, and labels jump to their own."""
    both = t.write(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    first = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root"))
    labels = step = t.write(first, "labels")
    for _ in range(rounds):
        spread = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        new = labels.join(spread, "id").select("id", F.least("root", "m").alias("r"), F.col("root").alias("old"))
        jump = labels.select(F.col("id").alias("r"), F.col("root").alias("far"))
        last, step = step, t.write(new.join(jump, "r", "left").select("id", F.least("r", F.coalesce("far", "r")).alias("root"), "old"), "labels")
        t.drop(last)
        labels = step.select("id", "root")
        if step.where("root <> old").isEmpty():
            t.drop(both)
            return labels
    raise RuntimeError(f"components not found in {rounds} rounds")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, num: int = TAU_NUM, den: int = TAU_DEN, cross: int = CROSS) -> DataFrame:
    """id_col, n_shingles and component_id (the smallest id reachable by links) of every row."""
    with small_batches(docs.sparkSession):
        return _join(docs, id_col, text_col, k, num, den, cross)


def _ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def _join(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int, cross: int) -> DataFrame:
    t = Scratch(docs.sparkSession)
    regions = t.write(_regions(docs, id_col, text_col, k, num, den), "regions")
    scanned = t.write(regions.where("size(more) = 3").select("id", F.col("at").alias("n"), *[F.col("more")[i].alias(x) for i, x in enumerate(("first", "d1", "d2"))]), "scanned")
    met = regions.where("size(more) = 2").select("sig", "id", "at", F.col("more")[0].alias("p"), F.col("more")[1].alias("p_at"))
    alone = regions.where("more is null").select("sig", "id", "at", "p", "p_at")
    # equal sets of different tasks
    firsts = scanned.where("first = id")
    least = t.write(firsts.groupBy("d1", "d2").agg(F.min("id").alias("b"), F.max("id").alias("top")).where("b < top").select("d1", "d2", "b"), "equal")
    copies = t.write(firsts.select("id", "d1", "d2").join(least, ["d1", "d2"]).where("id <> b").select(F.col("id").alias("a"), "b"), "copies")
    t.drop(least)
    # members with the pivots of their regions
    stars = alone.union(met).where("id <> p").where(can_link("at", "p_at", num, den))
    pairs = t.write(_ordered(stars, "id", "p").join(copies, ["a", "b"], "left_anti"), "pairs")
    ids = t.write(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    sets = t.write(_sets(docs, id_col, text_col, ids, k), "sets")
    measured = t.write(_verify(pairs, sets, num, den, t), "measured")
    links = measured.where("linked").select("a", "b").union(copies)
    labels = components(links, t)

    # regions that still hold several components
    member = alone.select("sig", "id", "at").union(met.select("sig", "id", "at")).union(met.select("sig", "p", "p_at")).distinct()
    member = member.join(_small(labels), "id", "left").select("sig", "id", "at", F.coalesce("root", "id").alias("root"))
    rows = member.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min(F.when(smaller("at"), F.col("id"))).alias("p"))
    rows = t.write(member.join(rows.where("r0 < r1 and p is not null").select("sig", "p"), "sig"), "mixed")
    t.drop(regions)
    few = F.sum(smaller("at").cast("long"))
    sizes = rows.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("c"), few.alias("s")).groupBy("sig")
    sizes = sizes.agg((F.sum("c") * F.sum("s") - F.sum(F.col("c") * F.col("s"))).alias("pairs"))
    split = rows.join(sizes.where("pairs > 0").select("sig", (F.col("pairs") > cross).alias("wide")), "sig")
    split = t.write(split, "split")
    t.drop(rows)
    if not split.isEmpty():
        labels = _across(docs, id_col, text_col, k, num, den, t, split, measured, ids, sets, links, labels)
    result = t.write(_finish(scanned, labels, id_col), "result")
    t.drop_all_but(result)
    return result


def _across(docs, id_col, text_col, k, num, den, t, split, measured, ids, sets, links, labels) -> DataFrame:
    """The labels after joining the regions of split, (sig, id, at, root, p, wide), across their components."""
    # windows of the pivot: both distances are known where the pair with the pivot was measured
    known = measured.select(F.col("a").alias("id"), F.col("b").alias("p"), "d").union(measured.select("b", "a", "d"))
    known = known.union(split.select(F.col("p").alias("id"), "p", F.lit(0.0).alias("d")).distinct())
    own = split.where("not wide").join(known, ["id", "p"], "left").select("sig", "id", "at", "root", "d")
    other = own.select("sig", F.col("id").alias("id_b"), F.col("at").alias("at_b"), F.col("root").alias("root_b"), F.col("d").alias("d_b"))
    near = F.coalesce(F.abs(F.col("d") - F.col("d_b")) <= (den - num) / den + 1e-9, F.lit(True))
    narrow = own.where(smaller("at")).join(other, "sig").where("root <> root_b and id <> id_b").where(size("at") <= size("at_b"))
    more = t.write(_ordered(narrow.where(near & can_link("at", "at_b", num, den)), "id", "id_b"), "narrow")
    around = None
    if not split.where("wide").isEmpty():
        around = t.write(_pivots(split.where("wide").select("sig", "p", "id"), t), "around")
    missing = more.select(F.col("a").alias("id")).union(more.select("b"))
    if around is not None:
        missing = missing.union(around.select("id")).union(around.select("p"))
    missing = t.write(missing.distinct().join(ids, "id", "left_anti"), "missing")
    if not missing.isEmpty():
        sets = sets.union(t.write(_sets(docs, id_col, text_col, missing, k), "sets"))
    if around is not None:
        # links with the pivots come first: members linked with one are then of one component
        spokes = t.write(_ordered(around.where("p <> id"), "p", "id"), "spokes")
        links = links.union(t.write(_verify(spokes, sets, num, den, t).where("linked").select("a", "b"), "linked")).distinct()
        labels = components(links, t)
        more = more.union(_differences(around.join(labels, "id", "left").select("p", "id", F.coalesce("root", "id").alias("root")), sets, num, den, t))
    more = t.write(more.distinct().join(measured.select("a", "b"), ["a", "b"], "left_anti"), "more")
    late = t.write(_verify(more, sets, num, den, t).where("linked").select("a", "b"), "late")
    return labels if late.isEmpty() else components(links.union(late), t)


def _pivots(far: DataFrame, t: Scratch) -> DataFrame:
    """(p, id): one pivot for each region, the one that most of its members choose, each choosing the pivot that most
    ids have. Any pivot is right; few of them, near their members, keep the differences few and short."""
    whole = t.write(far, "far")
    asked = whole.select("p", "id").distinct().groupBy("p").agg(F.count(F.lit(1)).alias("c"))
    best = F.max(F.struct("c", -F.col("p")))
    chosen = whole.select("p", "id").distinct().join(asked, "p").groupBy("id").agg(best.alias("best")).select("id", (-F.col("best.col2")).alias("choice"))
    votes = whole.join(chosen, "id").groupBy("sig", "choice").agg(F.count(F.lit(1)).alias("v"))
    taken = votes.groupBy("sig").agg(F.max(F.struct("v", -F.col("choice"))).alias("best")).select("sig", (-F.col("best.col2")).alias("p"))
    return whole.select("sig", "id").join(taken, "sig").select("p", "id").distinct()


def _differences(members: DataFrame, sets: DataFrame, num: int, den: int, t: Scratch) -> DataFrame:
    """Candidates (a, b), a > b, across roots among the members of each pivot p, by prefixes of their differences from p."""
    whole = t.write(members, "wide")
    c = (den - num) / (den + num)

    def run(batches):
        for batch in batches:
            for p, i, root, x, y in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                lacks = np.setdiff1d(x, y, True)  # what p lacks is rarer
                apart = np.concatenate((lacks, np.setdiff1d(y, x, True)))
                m = len(apart)
                d = 2 * m / (len(x) + len(y) + m)
                for own in (False, True):
                    if d < FAR - (den - num) / den - 1e-9 if own else d > FAR + 1e-9:
                        continue
                    if own:
                        parts = np.concatenate((lacks, np.intersect1d(x, y, True)))
                        share = np.ceil(num * len(x) / den - 1e-6)
                    else:
                        parts = apart
                        over = m - c * (len(x) + len(y))  # above 0: not linked with p
                        share = max(1, np.ceil((1 - c) * m / 2 - 1e-6))  # with a partner that is not linked with p
                        if over > -1e-6:  # or with one that is, which then differs from p by enough itself
                            share = min(share, max(1, np.ceil(over / (1 + c) - 1e-6)))
                    k = int(len(parts) - share + 1)
                    longs = [pa.array(np.full(k, v, np.int64)) for v in (p, i, root)]
                    ints = [pa.array(np.full(k, v, np.int32)) for v in (len(x), len(parts))]
                    rest = [pa.array(np.arange(1, k + 1, dtype=np.int32)), pa.array(np.full(k, own)), pa.array(signed(parts[:k]))]
                    yield pa.RecordBatch.from_arrays([*longs, *ints, *rest], ["p", "id", "root", "n", "m", "k", "own", "part"])

    pivots = _named(sets, whole.select("p")).select(F.col("id").alias("p"), F.col("s").alias("y"))
    own = _named(sets, whole.select("id")).select("id", F.col("s").alias("x"))
    with_sets = whole.join(own, "id").join(pivots, "p").select("p", "id", "root", "x", "y")
    first = t.write(with_sets.mapInArrow(run, "p long, id long, root long, n int, m int, k int, own boolean, part long"), "prefix")
    other = first.select("p", "own", "part", *[F.col(x).alias(f"{x}_2") for x in ("id", "root", "n", "m", "k")])
    # what this pair must share, and what it can still share from the first part in common on
    shared = F.ceil((F.col("m") + F.col("m_2") - c * (F.col("n") + F.col("n_2"))) / 2 - 1e-6)
    reach = F.least(F.col("m") - F.col("k"), F.col("m_2") - F.col("k_2")) + 1
    meets = (F.col("k") <= F.col("m") - shared + 1) & (F.col("k_2") <= F.col("m_2") - shared + 1) & (reach + F.least("k", "k_2") - 1 >= shared)
    met = first.join(other, ["p", "own", "part"]).where("root <> root_2 and id > id_2").where(meets)
    return met.select(F.col("id").alias("a"), F.col("id_2").alias("b")).distinct()


def _finish(scanned: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    roots = labels.select(F.col("id").alias("first"), "root")
    rows = scanned.select("id", "n", "first").join(roots, "first", "left").select("id", "n", F.coalesce("root", "first").alias("root"))
    least = rows.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return rows.join(least, "root", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def brute_force(rows: list[tuple[int, str | None]], k: int = K, num: int = TAU_NUM, den: int = TAU_DEN) -> list[tuple[int, int, int]]:
    """The same result from all pairs, for tests."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().translate(LOWER).split()
        sets[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and den * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return sorted((i, len(sets[i]), find(i)) for i in ids)
