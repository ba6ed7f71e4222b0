"""Operator 10: token counts of sections, attributed through offsets.

A whole document is encoded once by byte-level BPE. Such tokens, laid end to end, are the document's bytes, so their
byte spans are running sums of token widths. An interval join lays the spans over the sections of the document
(lines, or ranges that the caller gives). A token inside one section counts there; a token that crosses a boundary
is allocated by RULE: 'most' (the section with most of its bytes, the earlier on a tie), 'first' or 'last'.

Defined results: null and empty texts have no tokens and no sections; a section without tokens counts 0; section
counts always add up to the document's token count. Given sections are taken in ascending order, each start once, and
the first begins at 0 whatever is given. Very long texts and runs of white space are encoded whole. Repeated ids are rows of
their own; no rows give none. Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, list_array, slices

RULES = ("most", "first", "last")
#: The characters with Unicode's White_Space property, in runs that are cut out before matching.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{500,}")


class Encoder:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)


    def encode(self, text: str) -> list[int]:
        """As the library encodes. Its matcher's stack does not hold white space of any length, so long runs are cut out
        as the pattern cuts them: white space before a character that is none leaves its last one to what follows."""
        out, at = [], 0
        for run in LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def line_starts(src: bytes) -> np.ndarray:
    """First bytes of the lines; a line keeps its line feed."""
    ends = np.flatnonzero(np.frombuffer(src, np.uint8) == 10) + 1
    return np.concatenate(([0], ends[ends < len(src)]))


def allocate(ends: np.ndarray, widths: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens crossed a boundary. starts: first bytes of the sections, ascending,
    the first 0; what stands before the first start counts there."""
    starts = np.concatenate(([0], starts[1:]))
    begins = ends - widths
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    to = last if rule == "last" else first.copy()
    if rule == "most":
        for k in crossing:
            cuts = np.concatenate(([begins[k]], starts[first[k] + 1 : last[k] + 1], [ends[k]]))
            to[k] = first[k] + int(np.argmax(np.diff(cuts)))
    return np.bincount(to, minlength=len(starts)), len(crossing)


def token_counts(df: DataFrame, id_col: str, text_col: str, ranks: str, pattern: str, rule: str = "most", starts_col: str | None = None) -> DataFrame:
    """id_col, n_tokens, n_sections, n_crossing and section_tokens (a count for each section) of every row.

    starts_col: an array of the sections' first bytes; without it, lines are the sections."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    cols = [F.col(id_col).alias("id"), F.col(text_col).alias("text")] + ([F.col(starts_col).cast("array<int>").alias("starts")] if starts_col else [])
    two = df.select(*cols)

    def run(batches):
        e = encoder(ranks, pattern)
        for batch in slices(batches):
            given = batch.column(2).to_pylist() if starts_col else None
            n, sections, crossing, counts = [], [], [], []
            for k, src in enumerate(byte_rows(batch.column(1))):
                if not src:
                    n.append(0), sections.append(0), crossing.append(0), counts.append([])
                    continue
                widths = e.widths[e.encode(src.decode())]
                starts = np.unique([0, *(x for x in given[k] or () if x and 0 < x < len(src))]) if given else line_starts(src)
                c, x = allocate(np.cumsum(widths), widths, starts, rule)
                n.append(len(widths)), sections.append(len(starts)), crossing.append(x), counts.append(c)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, sections, crossing)), list_array(counts, pa.int32())],
                ["id", "n_tokens", "n_sections", "n_crossing", "section_tokens"],
            )

    kind = two.schema["id"].dataType.simpleString()
    return two.mapInArrow(run, f"id {kind}, n_tokens long, n_sections long, n_crossing long, section_tokens array<int>").withColumnRenamed("id", id_col)
