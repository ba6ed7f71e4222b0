"""Operator 1: SentencePiece encoding and decoding that keeps source offsets.

A text is normalised by longest-prefix look-ups in the model's compiled character map; every byte of the normalised
text records the source byte it came from. The pieces of the library's own segmentation are laid over the normalised
text, so each piece projects to a span of source bytes. Decoding is the library's decode of the ids.

Defined results: a null or empty text has no tokens and decodes to ''. Repeated rows give repeated results. Texts of any length
are encoded whole, one at a time where they are long; no rows give none. Extra columns never clash: only the two named columns
are read, and the outputs are new columns of a new frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, list_array, slices

SPACE = "▁".encode()
#: Values of the model format (piece types and the replacement character).
#: Text bytes whose pieces are held at once (or one row's).
SLICE = 1 << 19
UNKNOWN, BYTE, BAD = 2, 6, "�".encode()


class CharMap:
    """The compiled character map: a double-array trie whose values point at zero-ended replacement strings."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob, 0)
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist()
        self.strings = blob[4 + size :]

    def longest(self, src: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest prefix of src[at:] in the map, and its replacement; (0, b'') if there is none."""
        units, best, value = self.units, 0, 0
        node = self._offset(units[0])
        for k in range(at, len(src)):
            c = src[k]
            node ^= c
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != c:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                best, value = k + 1 - at, units[node] & 0x7FFFFFFF
        if not best:
            return 0, b""
        return best, self.strings[value : self.strings.index(b"\0", value)]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normaliser:
    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.dummy, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, src: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and for the end the source byte where it begins."""
        if self.map is None and not self.trim and self.escape:
            return self._plain(src)
        return self._mapped(src)

    def _plain(self, src: bytes) -> tuple[bytes, np.ndarray]:
        if not src:
            return b"", np.zeros(1, np.int64)
        wide = np.where(np.frombuffer(src, np.uint8) == 32, 3, 1)
        head = SPACE if self.dummy else b""
        at = np.repeat(np.arange(len(src)), wide)
        return head + src.replace(b" ", SPACE), np.concatenate((np.zeros(len(head), np.int64), at, [len(src)]))

    def _parts(self, src: bytes) -> Iterator[tuple[int, int, bytes]]:
        at, n = 0, len(src)
        while at < n:
            took, new = self.map.longest(src, at) if self.map else (0, b"")
            if not took:
                lead = src[at]
                width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = src[at : at + width]
                try:
                    new.decode()
                    took = width
                except UnicodeDecodeError:
                    took, new = 1, BAD
            yield at, took, new
            at += took

    def _mapped(self, src: bytes) -> tuple[bytes, np.ndarray]:
        space = SPACE if self.escape else b" "
        out, align, end, parts = bytearray(), [], 0, []
        blank = self.trim  # leading spaces go
        for at, took, new in self._parts(src):
            if self.trim:
                while blank and new[:1] == b" ":
                    new = new[1:]
                if new:
                    blank = new[-1:] == b" "
            if new:
                parts.append((at, new))
                end = at + took
        if not parts:
            return b"", np.zeros(1, np.int64)
        if self.dummy:
            out += space
            align += [parts[0][0]] * len(space)
        for at, new in parts:
            for c in new:
                more = space if c == 32 else bytes((c,))
                out += more
                align += [at] * len(more)
        if self.trim:
            while out.endswith(space):
                end = align[len(out) - len(space)]
                del out[-len(space) :], align[-len(space) :]
        return bytes(out), np.array([*align, end], np.int64)


class Codec:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.normalise = Normaliser(model.normalizer_spec)
        self.bytes_fall_back = model.trainer_spec.byte_fallback
        self.widths = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)

    def encode(self, src: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids of a text, and the first and end source byte of each piece."""
        if not src:
            none = np.zeros(0, np.int64)
            return [], none, none
        if self.bytes_fall_back:
            ids = self.library.encode(src.decode())
            widths = self.widths[ids]
        else:  # an unknown piece is as wide as what it stands for
            pieces = self.library.encode(src.decode(), return_type="proto").pieces
            ids = [p.id for p in pieces]
            widths = np.array([len(p.piece.encode()) for p in pieces], np.int64)
        normal, align = self.normalise(src)
        ends = np.cumsum(widths)
        if len(normal) != (int(ends[-1]) if len(ends) else 0):
            raise ValueError(f"pieces cover {ends[-1:]} of {len(normal)} normalised bytes")
        return ids, align[ends - widths], align[ends]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec for each worker process and model."""
    return Codec(path)


FULL = "ids array<int>, starts array<int>, ends array<int>, decoded string"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"


def encode(df: DataFrame, id_col: str, text_col: str, model: str) -> DataFrame:
    """Columns id_col, ids, starts, ends (source bytes of each piece) and decoded, a row for each row of df."""

    def run(batches):
        c = codec(model)
        for batch in slices(batches, size=SLICE):
            found, decoded = [], []
            for src in byte_rows(batch.column(1)):
                ids, *spans = c.encode(src or b"")
                decoded.append(c.decode(ids))
                found.append([np.asarray(x, np.int32) for x in (ids, *spans)])
            lists = [list_array([x[k] for x in found], pa.int32()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(decoded, pa.string())], ["id", "ids", "starts", "ends", "decoded"])

    return _over(df, id_col, text_col, run, FULL)


def encode_digests(df: DataFrame, id_col: str, text_col: str, model: str) -> DataFrame:
    """As encode, but of each row only what proves the result: a count and SHA-256 digests of ids, text and spans."""

    def run(batches):
        c, sha = codec(model), hashlib.sha256
        for batch in slices(batches, size=SLICE):
            rows: list[list] = [[], [], [], []]
            for src in byte_rows(batch.column(1)):
                ids, starts, ends = c.encode(src or b"")
                spans = np.stack((starts, ends), 1).astype("<i4")
                for to, x in zip(rows, (len(ids), sha(",".join(map(str, ids)).encode()).hexdigest(), sha(c.decode(ids).encode()).hexdigest(), sha(spans.tobytes()).hexdigest()), strict=True):
                    to.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows[0], pa.int64()), *(pa.array(x, pa.string()) for x in rows[1:])], ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return _over(df, id_col, text_col, run, DIGESTS)


def _over(df: DataFrame, id_col: str, text_col: str, run, columns: str) -> DataFrame:
    two = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    return two.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id_col)
