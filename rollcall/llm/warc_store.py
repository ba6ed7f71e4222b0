"""Operator 6: WARC records in seekable Zstandard bundles.

Records are grouped into frames of about FRAME_BYTES, each an independent Zstandard frame, and frames into bundles of
about BUNDLE_BYTES. A bundle ends with the seek table of the public seekable format: a skippable frame that lists
the compressed and plain size of every frame. An index maps record identifiers to a frame and an offset in its plain
bytes, so one record costs one frame. Bundles are rows (bundle, data, index) that Spark's own writer commits into the
shared folder, so a lost or repeated task leaves no half bundle behind; `export` writes them out as .warc.zst files.

Of equal payloads of at least REVISIT_BYTES, that with the smallest id is a response and the others are revisits that
refer to it. Only digests and ids are shuffled to find them.

Defined results: a null payload is an empty one; rows without an id are responses with a null id; rows that repeat an
id with the same payload are responses alike; a null URL leaves out the record's target. A payload larger than a bundle is a
bundle of its own; no pages give no bundles and no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, materialise, slices

FRAME_BYTES, BUNDLE_BYTES, REVISIT_BYTES, LEVEL = 256 << 10, 8 << 20, 100, 3
#: Up to so many revisits (about 100 bytes each) are sent to all tasks; beyond, the join is shuffled.
BROADCAST = 100_000
#: Magic numbers of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = b"2024-01-01T00:00:00Z"


def record(i: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record; of a revisit, only what stands for the payload."""
    name = lambda x: b"<urn:page:%s>" % (b"" if x is None else str(x).encode())
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: " + name(i), b"WARC-Date: " + DATE]
    if url is not None:
        head.append(b"WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url).encode())
    head += [b"WARC-Payload-Digest: sha256:" + digest.encode(), b"WARC-Payload-Length: %d" % len(payload), b"Content-Type: application/http; msgtype=response"]
    block = HTTP % len(payload)
    if refers_to is None:
        block += payload
    else:
        head += [b"WARC-Refers-To: " + name(refers_to), b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(block), b"", block, b"", b""])


def parse(plain: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at a place."""
    stop = plain.index(b"\r\n\r\n", at)
    lines = plain[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, plain[begin:end], end + 4


class Bundle:
    """Collects records; seal() gives the bundle's bytes and its index."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self.frame_bytes, self.frames, self.sizes, self.open = frame_bytes, [], [], bytearray()
        self.index: list[tuple[int | None, int, int]] = []

    def add(self, i: int | None, data: bytes) -> None:
        self.index.append((i, len(self.frames), len(self.open)))
        self.open += data
        if len(self.open) >= self.frame_bytes:
            self._close()

    def _close(self) -> None:
        if self.open:
            packed = self.pack(bytes(self.open))
            self.frames.append(packed)
            self.sizes.append((len(packed), len(self.open)))
            self.open = bytearray()

    def size(self) -> int:
        return sum(a for a, _ in self.sizes)

    def seal(self) -> tuple[bytes, list[tuple[int | None, int, int]]]:
        self._close()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table]), self.index


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(place, compressed size, plain size) of each frame, from the bundle's end."""
    n, _, magic = struct.unpack_from("<IBI", data, len(data) - 9)
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    out, at = [], 0
    for k in range(n):
        a, b = struct.unpack_from("<II", data, len(data) - 9 - 8 * (n - k))
        out.append((at, a, b))
        at += a
    return out


def frame(data: bytes, place: tuple[int, int, int]) -> bytes:
    import zstandard

    at, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=plain)


def fetch(data: bytes, frame_no: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record, by its place in the index."""
    headers, block, _ = parse(frame(data, seek_table(data)[frame_no]), offset)
    return headers, block


def records(data: bytes, index: list[tuple[int | None, int, int]]) -> Iterator[tuple[int | None, dict[str, str], bytes]]:
    """Every record of a bundle by its place in the index; raises where the index and the frames do not fit together."""
    places, open_no, plain, end = seek_table(data), -1, b"", 0
    for i, frame_no, offset in index:
        if frame_no != open_no:
            if end != len(plain) or frame_no != open_no + 1:
                raise ValueError(f"records without an index entry in frame {open_no}")
            open_no, plain, end = frame_no, frame(data, places[frame_no]), 0
        if offset != end:
            raise ValueError(f"records without an index entry in frame {frame_no}")
        headers, block, end = parse(plain, offset)
        yield i, headers, block
    if end != len(plain) or open_no != len(places) - 1:
        raise ValueError("the index ends before the bundle")


INDEX = "index array<struct<id: long, frame: int, offset: int>>"


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """The bundles of a table, committed: bundle, data, index."""
    body = F.coalesce(F.col(payload_col), F.lit(""))
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("text"), F.sha2(body.cast("binary"), 256).alias("digest"))
    long = own.where(F.octet_length("text") >= REVISIT_BYTES).select("id", "digest")
    first = materialise(long.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("top")).where("refers_to < top").select("digest", "refers_to"), "first")
    revisits = materialise(long.join(first, "digest").where("id <> refers_to").distinct(), "revisits")
    joined = own.join(F.broadcast(revisits) if revisits.count() <= BROADCAST else revisits, ["id", "digest"], "left").select("id", "url", "digest", "refers_to", "text")

    def run(batches):
        bundle, rows = Bundle(), []

        def seal():
            data, index = bundle.seal()
            entries = [{"id": a, "frame": b, "offset": c} for a, b, c in index]
            kind = pa.list_(pa.struct([("id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int32())]))
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([data], pa.binary()), pa.array([entries], kind)], ["bundle", "data", "index"])

        for batch in slices(batches):
            rows = zip(*(batch.column(k).to_pylist() for k in range(4)), byte_rows(batch.column(4)), strict=True)
            for i, url, digest, refers_to, payload in rows:
                bundle.add(i, record(i, url, payload, digest, refers_to))
                if bundle.size() >= bundle_bytes:
                    yield seal()
                    bundle = Bundle()
        if bundle.index:
            yield seal()

    return materialise(joined.mapInArrow(run, f"bundle string, data binary, {INDEX}"), "warc")


def read(bundles: DataFrame, id_col: str = "page_id") -> DataFrame:
    """A row for each record, read through the index: payload_bytes and payload_digest of the full payload, record_type and refers_to."""

    def run(batches):
        number = lambda x: int(x[10:-1]) if len(x) > 11 else None
        for batch in batches:
            for data, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out = []
                for i, headers, block in records(data, [(x["id"], x["frame"], x["offset"]) for x in index]):
                    kind, said = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(headers["WARC-Payload-Length"])
                    if number(headers["WARC-Record-ID"]) != i:
                        raise ValueError(f"the index names {i}, the record {headers['WARC-Record-ID']}")
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if len(payload) != size or hashlib.sha256(payload).hexdigest() != said:
                            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
                    out.append((i, size, said, kind, number(headers["WARC-Refers-To"]) if kind == "revisit" else None))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return bundles.select("data", "index").mapInArrow(run, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long").withColumnRenamed("id", id_col)


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Writes each bundle as a .warc.zst file into a folder that every executor mounts: bundle, path, bytes."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = os.path.join(folder, f"{name}.warc.zst")
                with open(f"{path}.{uuid.uuid4().hex}", "wb") as f:
                    f.write(data)
                os.replace(f.name, path)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([path]), pa.array([len(data)])], ["bundle", "path", "bytes"])

    return bundles.select("bundle", "data").mapInArrow(run, "bundle string, path string, bytes long")


def round_trip(pages: DataFrame) -> DataFrame:
    return read(write(pages))
