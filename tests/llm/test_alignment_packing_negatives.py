"""Operators 11 to 13 against brute force, and their defined results for odd rows."""

import hashlib
import random
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rollcall.llm import alignment, byte_level, hard_negatives, packing, queries
from rollcall.llm.common import table

from .test_operators import LONG, ODD, SF, clashing, odd

MORE = [
    (20, "a ▁ piece's own space"), (21, "<s> </s> <0x41> <|endoftext|> plain"), (22, " " * 3000 + "x" + "\n" * 900), (23, "é́ ☃☃☃ \U0001f600\U0001f601 ​ z"),
    (24, "zzzzqqqq" * 4000), (25, "tab\tand\r\nnew\x00line"), (20, "the same id again"), (None, "no id at all here"),
]


@pytest.fixture(scope="module")
def texts(spark):
    given = [(r.doc_id, r.text) for r in table(spark, SF, "documents").limit(60).collect()]
    return odd(spark, ODD + MORE + given), ODD + MORE + given


# operator 11


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, q int, row string, anchor int")


def mined(df, **more):
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.scaled(df, "vec_id", "embedding", "label", moved)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0, **more)


def mined_plainly(rows):
    """Every product of every anchor with every row."""
    held = []
    for i, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        if max(map(abs, q), default=0) <= hard_negatives.LIMIT:
            held.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, q))
    out = []
    for k, (i, label, q) in enumerate(held):
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, r, strict=True)), j is None, j, other) for n, (j, other, r) in enumerate(held) if n != k and len(r) == len(q)), key=lambda x: (x[0], x[1], x[2] or 0))
        for s, _, positive, _ in [x for x in scored if x[3] == label][:5]:
            fits = [(j, -t) for t, _, j, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, positive, n + 1, j, -s, t) for n, (j, t) in enumerate(fits[:10])]
    return Counter(out)


def test_hard_negatives_equal_plain_products(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0.1, 0.4) for _ in range(12)], rng.randrange(4)) for i in range(420)]
    rows += [(i % 50, rows[i][1], rows[i][2]) for i in range(60)]  # copies, ties and repeated ids
    rows += [(None, rows[3][1], 1), (500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 12, 2), (503, [float("inf")] * 12, 2), (504, [0.5] * 12, None), (600, [0.25, 0.5], 2), (601, [0.3, 0.4], 2), (602, [0.3, 0.3], 3)]
    rows += [(700, [], 1), (701, [], 1), (702, [], 2), (703, [1e9] * 12, 1), (800, [-1.0] * 12, 1), (900, rows[0][1], 0), (900, rows[0][1], 0)]
    rows = [(*r, 1, "x", 2) for r in rows]
    df = vectors(spark, rows)
    want = mined_plainly(rows)
    assert len(want) > 100
    assert Counter(map(tuple, mined(df).collect())) == want
    assert Counter(map(tuple, mined(df, anchor_bytes=1500).collect())) == want  # several blocks of anchors
    assert mined(df.limit(0)).collect() == []
    assert mined(df.where("vec_id = 1")).collect() == []


def test_vertical_scan_drops_only_what_cannot_count():
    rng = np.random.default_rng(2)
    q = rng.integers(-90, 90, (16, 3000))
    block = hard_negatives.Block({"rows": range(3000), "ids": range(3000), "labels": [0] * 3000, "least": q.min(1), "most": q.max(1), "columns": q.astype("<i4").tobytes()})
    for anchor in (rng.integers(-90, 90, 16), np.array([400, *[1] * 15])):
        score = anchor @ q
        lo, hi = np.quantile(score, [0.6, 0.8]).astype(int)
        sizes = []

        def floors(lower, upper, sizes=sizes):
            sizes.append(len(lower))
            return [-(1 << 62)]

        at, got = hard_negatives.vertical_scan(block, anchor, np.arange(3000), [int(lo)], [int(hi)], floors, step=2)
        assert (np.sort(at) == np.flatnonzero((score >= lo) & (score <= hi))).all() and (got == score[at]).all()
        assert sizes[-1] < 3000
    assert sizes[1] < 1500  # one large dimension decides early


# operator 12


def aligned_plainly(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    byte = byte_level.alphabet()
    a_lib, b_lib = Tokenizer.from_file(queries.BYTES), sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    a_lib.encode_special_tokens = True
    out, linked = [], defaultdict(int)
    for i, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a_lib.id_to_token(t)) for t in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(t)[3:5], 16)]) if b_lib.is_byte(t) else b_lib.id_to_piece(t).replace("▁", " ").encode() for t in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append((i, [], [], [], ""))
            continue
        spans = []
        for parts in (bytes_a, bytes_b):
            at, own = 0, []
            for p in parts:
                own.append((at, at := at + len(p)))
            spans.append(own)
        owner = {}
        for k, (s, e) in enumerate(spans[1]):
            owner |= dict.fromkeys(range(s, e), k)
        links = [(a[k], b[j]) for k, (s, e) in enumerate(spans[0]) for j in sorted({owner[x] for x in range(s, e)})]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        parts = [([], []) for _ in ends]
        for side, (ids, own) in enumerate(zip((a, b), spans, strict=True)):
            for t, (s, _) in zip(ids, own, strict=True):
                parts[bisect_right(ends, s)][side].append(str(t))
        groups = ["|".join(map(",".join, p)) for p in parts]
        out.append((i, a, b, links, ";".join(groups)))
        for p in set(links):
            linked[p] += 1
    best = defaultdict(int)
    for (x, _), n in linked.items():
        best[x] = max(best[x], n)
    return Counter(
        (i, len(a), len(b), g.count("|"), len(links), sum(linked[p] == best[p[0]] for p in links), sum(linked[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, links, g in out
    )


def test_alignment_equals_byte_by_byte(spark, texts):
    df, rows = texts
    got = alignment.align(clashing(df).repartition(3), "doc_id", "text", queries.BYTES, queries.PIECES)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == aligned_plainly(rows)
    assert alignment.align(df.limit(0), "doc_id", "text", queries.BYTES, queries.PIECES).collect() == []


def test_alignment_slices_do_not_matter(spark, texts, monkeypatch):
    df, _ = texts
    run = lambda: Counter(map(tuple, alignment.align(df.coalesce(1), "doc_id", "text", queries.BYTES, queries.PIECES).collect()))
    whole = run()
    monkeypatch.setattr(alignment, "slices", lambda batches, size: (b.slice(k, 7) for b in batches for k in range(0, b.num_rows, 7)))
    assert run() == whole


def test_gallop_equals_bisection():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (1, 900), (300, 301), (50, 5000)):
        hay = np.unique(rng.integers(0, 4 * m, m))
        needles = np.sort(rng.integers(-2, hay[-1] + 1, n))
        for start in (np.zeros(n, np.int64), np.full(n, len(hay) - 1), rng.integers(0, len(hay), n)):
            assert (alignment.gallop(needles, hay, start) == np.searchsorted(hay, needles)).all()


# operator 13


@lru_cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.BYTES)


def library_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("size", [2048, 64])
def test_packing_holds_every_id_once(spark, texts, size):
    df, rows = texts
    numbered = df.select(F.monotonically_increasing_id().alias("doc_id"), "text", F.lit(1).alias("id"), F.lit(2).alias("row"), F.lit("x").alias("key"))
    by_id = {r.doc_id: r.text for r in numbered.collect()}
    got = packing.pack(numbered, "doc_id", "text", queries.BYTES, size=size).collect()
    assert got[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r), sequences[r.sequence_id].append(r)
    assert docs.keys() == by_id.keys()
    for i, own in docs.items():
        ids, at = np.array(library_ids(by_id[i]), "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == size or at < size and at.bit_count() == 1  # no padding at all
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_of_odd_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, None), (None, ""), (7, "a b"), (7, "a b"), (8, LONG)], "doc_id int, text string")
    got = packing.pack(df, "doc_id", "text", queries.BYTES).collect()
    assert sum(r.length for r in got) == sum(len(library_ids(t)) for t in (None, "", "a b", "a b", LONG)) and {r.doc_id for r in got} == {None, 7, 8}
    assert packing.pack(df.limit(0), "doc_id", "text", queries.BYTES).collect() == []


def test_hilbert_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = packing.hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark):
    rng = random.Random(3)
    kinds = [[rng.randrange(50000) for _ in range(60)] for _ in range(8)]
    docs = [np.array(rng.choices(kinds[k % 8], k=200)) for k in range(400)]
    order = np.argsort(packing.projector(50257)(docs))
    same = np.mean([a % 8 == b % 8 for a, b in zip(order[:-1], order[1:], strict=True)])
    assert same > 0.5  # by chance 0.125


def test_byte_level_equals_library(texts):
    own = byte_level.byte_level(queries.BYTES)
    for _, text in texts[1]:
        if text:
            assert [*own.encode_special(text), 1] == library_ids(text)
