"""Operator 5: language identification by unigrams marginalised over segmentations.

Each language has a probability for every piece of one fixed public vocabulary (and, so that any text has a
probability, for every single byte). A word's probability is the sum over all ways to cut it into pieces, by the
forward algorithm; words are independent, so a text's log-probability is the sum over its words. The piece
probabilities are fitted by expectation-maximisation on a sample of about TRAIN_DOCS documents a language (at most
twice as many), chosen by a hash of id and text among those allowed for training. Texts are learned from and scored whole:
the words of the sample are counted in tasks, and the driver holds its distinct words.

Words are runs of letters: ASCII capitals are lower-cased, other ASCII characters part words. The forward algorithm
runs over all new words of a batch at once, by word length; words over WIDE bytes go by themselves, with sums scaled
as they shrink, so these too are summed over all their segmentations, in training as in scoring.

A text that no language gives more than CHANCE a byte, that of drawing from 26 letters and a space at random, is
claimed by none: see claimed().

Defined results: a null text, or one without a letter, is `und` with score 0; without any training document every
text is `und`. Ties go to the first language by name. Repeated rows give repeated results; rows without an id, or with
one that others have, are sampled by their text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import byte_rows, slices

TRAIN_DOCS = 200
WIDE, KNOWN, ROUNDS = 32, 400_000, 3
CHANCE = -np.log(27)
#: ASCII letters stay or are lower-cased, other ASCII characters become spaces.
LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))
FOUND = ("lang_pred", "score", "fluency")
ASCII_LETTER = re.compile(rb"[A-Za-z]")
NORMAL = 1  # a type in the model format
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text.decode(errors="replace"))))


def vocabulary(model: str) -> list[bytes]:
    """The pieces of a public model, a space for its word mark, after the 256 single bytes."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(model, "rb") as f:
        m.ParseFromString(f.read())
    pieces = {p.piece.replace("▁", " ").encode() for p in m.pieces if p.type == NORMAL}
    return [bytes((c,)) for c in range(256)] + sorted(p for p in pieces if 1 < len(p) <= WIDE + 1)


class Pieces:
    """Finds the pieces in many words of one length by rolling hashes."""

    def __init__(self, pieces: list[bytes]):
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        widths: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            widths.setdefault(len(p), []).append(k)
        with np.errstate(over="ignore"):
            for w, ids in widths.items():
                text = np.frombuffer(b"".join(pieces[k] for k in ids), np.uint8).reshape(-1, w)
                h = self.prefix_hashes(text)[:, -1]
                order = np.argsort(h)
                self.by_width[w] = h[order], np.array(ids)[order]

    @staticmethod
    def prefix_hashes(text: np.ndarray) -> np.ndarray:
        out = np.zeros((len(text), text.shape[1] + 1), np.uint64)
        for k in range(text.shape[1]):
            out[:, k + 1] = out[:, k] * BASE + text[:, k].astype(np.uint64) + np.uint64(1)
        return out

    def edges(self, text: np.ndarray):
        """(begin, end, rows, pieces) for each pair of places where some rows have a piece, in order of begin."""
        n, h = text.shape[1], self.prefix_hashes(text)
        power = [np.uint64(1)]
        for _ in range(n):
            power.append(power[-1] * BASE)
        for begin in range(n):
            for end in range(begin + 1, n + 1):
                if end - begin == 1:
                    yield begin, end, slice(None), text[:, begin].astype(np.int64)
                elif (table := self.by_width.get(end - begin)) is not None:
                    want = h[:, end] - h[:, begin] * power[end - begin]
                    at = np.minimum(np.searchsorted(table[0], want), len(table[0]) - 1)
                    rows = np.flatnonzero(table[0][at] == want)
                    if len(rows):
                        yield begin, end, rows, table[1][at[rows]]


def by_length(words: list[bytes]):
    """(indices of words, matrix of bytes of the words with their leading space), by equal length; none over WIDE bytes."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if len(w) < WIDE:
            groups.setdefault(len(w) + 1, []).append(k)
    for width in sorted(groups):
        ids = groups[width]
        for k in range(0, len(ids), 50_000):
            yield np.array(ids[k : k + 50_000]), np.frombuffer(b"".join(b" " + words[i] for i in ids[k : k + 50_000]), np.uint8).reshape(-1, width)


def word_edges(pieces: Pieces, word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end place and number of every piece in one word of any length, in order of end."""
    text = np.frombuffer(b" " + word, np.uint8)
    n, h = len(text), np.zeros(len(text) + 1, np.uint64)
    total = 0
    for k, c in enumerate(text.tolist()):
        total = (total * int(BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
        h[k + 1] = total
    begins, ends, ids = [np.arange(n)], [np.arange(1, n + 1)], [text.astype(np.int64)]
    power = int(BASE)
    for width in range(2, max(pieces.by_width, default=1) + 1):
        power = power * int(BASE) & 0xFFFFFFFFFFFFFFFF
        if (table := pieces.by_width.get(width)) is not None and width <= n:
            want = h[width:] - h[:-width] * np.uint64(power)
            at = np.minimum(np.searchsorted(table[0], want), len(table[0]) - 1)
            rows = np.flatnonzero(table[0][at] == want)
            begins.append(rows), ends.append(rows + width), ids.append(table[1][at[rows]])
    ends = np.concatenate(ends)
    order = np.argsort(ends, kind="stable")
    return np.concatenate(begins)[order], ends[order], np.concatenate(ids)[order]


def long_expectations(pieces: Pieces, log_p: np.ndarray, word: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Piece numbers and, for each language, how often each is expected in one word, over all its segmentations; in logarithms,
    so the word may be of any length."""
    begins, ends, ids = word_edges(pieces, word)
    n, weight = len(word) + 1, log_p[ids]
    forth, back = (np.full((n + 1, log_p.shape[1]), -np.inf) for _ in range(2))
    forth[0] = back[n] = 0
    cuts = np.searchsorted(ends, np.arange(1, n + 2))
    for end in range(1, n + 1):
        some = slice(cuts[end - 1], cuts[end])
        forth[end] = np.logaddexp.reduce(forth[begins[some]] + weight[some], 0)
    order = np.argsort(begins, kind="stable")
    cuts = np.searchsorted(begins[order], np.arange(n + 1))
    for begin in range(n - 1, -1, -1):
        some = order[cuts[begin] : cuts[begin + 1]]
        back[begin] = np.logaddexp.reduce(back[ends[some]] + weight[some], 0)
    return ids, np.exp(forth[begins] + weight + back[ends] - forth[n])


def long_word(pieces: Pieces, p: np.ndarray, word: bytes) -> np.ndarray:
    """Log of the sum over all segmentations of one word of any length."""
    n = len(word) + 1
    begins, ends, ids = word_edges(pieces, word)
    weight = p[ids]
    cuts = np.searchsorted(ends, np.arange(1, n + 2))
    a, scale = np.zeros((n + 1, p.shape[1])), np.zeros(p.shape[1])
    a[0] = 1
    widest = max(pieces.by_width, default=1)
    for end in range(1, n + 1):
        some = slice(cuts[end - 1], cuts[end])
        a[end] = (a[begins[some]] * weight[some]).sum(0)
        small = a[end] < 1e-150
        if small.any():
            low = max(0, end - widest)
            factor = np.where(small, 1 / np.maximum(a[end], 1e-300), 1.0)
            a[low : end + 1] *= factor
            scale -= np.log(factor)
    return np.log(a[n]) + scale


def forward(pieces: Pieces, p: np.ndarray, text: np.ndarray, edges=None) -> np.ndarray:
    """Sums over segmentations up to each place: rows x places x languages."""
    a = np.zeros((len(text), text.shape[1] + 1, p.shape[1]))
    a[:, 0] = 1
    for begin, end, rows, ids in edges if edges is not None else pieces.edges(text):
        a[rows, end] += a[rows, begin] * p[ids]
    return a


def log_probabilities(pieces: Pieces, p: np.ndarray, words: list[bytes]) -> np.ndarray:
    out = np.zeros((len(words), p.shape[1]))
    short = np.array([k for k, w in enumerate(words) if len(w) < WIDE], np.int64)
    with np.errstate(over="ignore"):
        for ids, text in by_length([words[k] for k in short]):
            out[short[ids]] = np.log(forward(pieces, p, text)[:, -1])
        for k, w in enumerate(words):
            if len(w) >= WIDE:
                out[k] = long_word(pieces, p, w)
    return out


@dataclass
class Model:
    langs: list[str]
    vocab: list[bytes]
    p: np.ndarray  # pieces x languages


def fit(sample: list[tuple[str, bytes]], vocab: list[bytes], rounds: int = ROUNDS) -> Model:
    """EM over the words of labelled texts."""
    counts: dict[tuple[str, bytes], int] = {}
    for lang, text in sample:
        for w in words_of(text):
            counts[lang, w] = counts.get((lang, w), 0) + 1
    return fit_words(counts, {lang for lang, _ in sample}, vocab, rounds)


def fit_words(counts: dict[tuple[str, bytes], int], names: set[str], vocab: list[bytes], rounds: int = ROUNDS) -> Model:
    """EM over words, each with its number in each language."""
    langs, words = sorted(names), sorted({w for _, w in counts})
    pieces, index = Pieces(vocab), {w: k for k, w in enumerate(words)}
    n = np.zeros((len(words), len(langs)))
    for (lang, w), c in counts.items():
        n[index[w], langs.index(lang)] = c
    p = np.full((len(vocab), len(langs)), 1 / len(vocab))
    with np.errstate(over="ignore"):
        for _ in range(rounds):
            expected = np.full(p.shape, 0.02)
            for ids, text in by_length(words):
                edges = list(pieces.edges(text))
                a = forward(pieces, p, text, edges)
                b = np.zeros_like(a)
                b[:, -1] = 1
                for begin, end, rows, found in reversed(edges):
                    b[rows, begin] += b[rows, end] * p[found]
                weight = n[ids] / a[:, -1]
                for begin, end, rows, found in edges:
                    g = a[rows, begin] * p[found] * b[rows, end] * weight[rows]
                    for k in range(len(langs)):
                        expected[:, k] += np.bincount(found, g[:, k], len(vocab))
            log_p = np.log(p)
            for w in words:
                if len(w) >= WIDE:
                    found, g = long_expectations(pieces, log_p, w)
                    for k in range(len(langs)):
                        expected[:, k] += np.bincount(found, g[:, k] * n[index[w], k], len(vocab))
            p = expected / expected.sum(0)
    return Model(langs, vocab, p)


class Scorer:
    """Scores texts; words met before keep their log-probabilities, up to KNOWN words."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.vocab)
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.table = np.zeros((0, len(self.model.langs)))

    def __call__(self, texts: list[bytes | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and log-probability a byte (of words and the space before each) of each text."""
        if len(self.ids) > KNOWN:
            self._clear()
        ids, spans, at, todo, sizes = self.ids, [], [], [], []
        for text in texts:
            words = words_of(text) if text else []
            sizes.append(sum(map(len, words)) + len(words))
            for w in words:
                k = ids.get(w)
                if k is None:
                    k = ids[w] = len(ids)
                    todo.append(w)
                at.append(k)
            spans.append(len(at))
        if todo:
            self.table = np.concatenate((self.table, log_probabilities(self.pieces, self.model.p, todo)))
        every = self.table[at] if at else np.zeros((0, len(self.model.langs)))
        langs, scores, fluency, begin = [], [], [], 0
        for text, end, size in zip(texts, spans, sizes, strict=True):
            if not text or not self.model.langs or not has_letter(text):
                langs.append("und"), scores.append(0.0), fluency.append(None)
            else:
                s = every[begin:end].sum(0)
                e = np.exp(s - s.max())
                langs.append(self.model.langs[int(s.argmax())]), scores.append(float(e.max() / e.sum())), fluency.append(float(s.max() / size))
            begin = end
        return langs, scores, fluency


def sample_of(docs: DataFrame, id_col: str, text_col: str, lang_col: str, allowed: Column, per_lang: int = TRAIN_DOCS) -> DataFrame:
    """l and t: about per_lang allowed documents of each language, at most twice as many, by a hash of id and text, whole. The
    rates, a row a language, are sent to all tasks, as the model with its column a language will be."""
    usable = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    rates = usable.groupBy("l").agg((F.lit(1e6 * per_lang) / F.count(F.lit(1))).alias("rate"))
    picked = usable.withColumn("h", F.xxhash64("i", "t")).join(F.broadcast(rates), "l").where(F.pmod("h", F.lit(1_000_000)) <= F.col("rate"))
    few = picked.select("l", "h", "t").distinct()
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))).where(F.col("k") <= 2 * per_lang)
    return few.select("l", "t")


def sample_words(sample: DataFrame) -> tuple[dict[tuple[str, bytes], int], set[str]]:
    """The numbers of the sample's words in each language, counted in tasks; and the languages."""

    def run(batches):
        for batch in slices(batches, "t"):
            counts: dict[tuple[str, bytes], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1)), strict=True):
                counts[lang, b""] = 1  # the language is known even without a word
                for w in words_of(text):
                    counts[lang, w] = counts.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in counts], pa.string()), pa.array([w for _, w in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())], ["l", "w", "n"])

    rows = sample.mapInArrow(run, "l string, w binary, n long").groupBy("l", "w").agg(F.sum("n").alias("n")).collect()
    return {(r.l, bytes(r.w)): r.n for r in rows if r.w}, {r.l for r in rows}


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score and fluency (log-probability a byte); columns of these names in docs are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in FOUND]
    place = kept.index(text_col)

    def run(batches):
        score = Scorer(sent.value)
        for batch in slices(batches, text_col):
            langs, scores, fluency = score(byte_rows(batch.column(place)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(fluency, pa.float64())], [*kept, *FOUND])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in kept]).schema)
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(run, f"{fields}, lang_pred string, score double, fluency double")


def claimed(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, as they are, whose text has letters and that some language finds likelier than chance."""
    taken = {c: f"{c}_{len(docs.columns)}_given" for c in FOUND if c in docs.columns}
    found = identify(docs.withColumnsRenamed(taken), model, text_col).where((F.col("lang_pred") != "und") & (F.col("fluency") > float(CHANCE)))
    return found.drop(*FOUND).withColumnsRenamed({v: k for k, v in taken.items()}).select(*[f"`{c}`" for c in docs.columns])


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, vocab_model: str) -> Model:
    return fit_words(*sample_words(sample_of(docs, "doc_id", "text", "lang", ~held_out())), vocabulary(vocab_model))


def report(docs: DataFrame, vocab_model: str) -> DataFrame:
    return identify(docs.select("doc_id", "text"), train(docs, vocab_model)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def brute_force(vocab: list[bytes], p: dict[bytes, float], word: bytes) -> float:
    """Sum over all segmentations by plain recursion, for tests."""
    def go(rest: bytes) -> float:
        return 1.0 if not rest else sum(p[rest[:k]] * go(rest[k:]) for k in range(1, len(rest) + 1) if rest[:k] in p)

    return go(b" " + word)
