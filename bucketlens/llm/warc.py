"""WARC archives as seekable Zstandard bundles (operator 6).

Writing: each task turns its pages into WARC/1.1 records and appends them to
bundle files in a shared folder. Records are gathered into independent
Zstandard frames of about ``frame_bytes``; a bundle ends with the seek table of
the public seekable format (a skippable frame with the compressed and
decompressed size of every frame, and a footer). A bundle is closed at
``bundle_bytes``. The index maps each record to (bundle, frame, offset in the
decompressed frame, length); it is a Parquet table, so Spark's commit decides
which attempt of a task counts: bundles have unique names, and those of a lost
or repeated attempt are in no index.

Reading: only the footer, the seek table and the frames that hold wanted
records are read; a record is cut out of its frame by offset and length.

Of pages with equal payloads of at least ``min_revisit`` bytes, the one with
the largest page_id is a response; the others are revisit records without a
body that refer to it. Smaller payloads are all responses. Null html is an
empty payload, a null url an empty target. Rows that share the largest page_id
are all responses; a null page_id counts as the smallest, and if a group has no
other, all its pages are responses.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, stored, table

MIN_REVISIT = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Payloads that several pages share: up to this many (about 60 bytes each) go to
#: every task; beyond it, the pages are joined to them by shuffle, with the same
#: result.
BROADCAST_ROWS = 200_000
#: The capture time written into records when the table has none.
DATE = "1970-01-01T00:00:00Z"

# The seekable format's numbers.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
SKIPPABLE = struct.Struct("<II")

# Fixed value: the profile of a revisit by payload digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Ids pass through Python as text: with nulls they would become floats.
INDEX = "page_id string, bundle string, frame int, offset long, length long"
READ = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def open_store(uri: str):
    """(file system, path) of a uri that executors and the driver share."""
    from pyarrow import fs

    scheme, sep, rest = uri.partition("://")
    if scheme in ("s3a", "s3n"):
        uri = "s3://" + rest
    return fs.FileSystem.from_uri(uri if sep else "file://" + uri)


# -- records -----------------------------------------------------------------


def _urn(page_id: str | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> str | None:
    return (urn or "").strip("<>").rpartition(":")[2] or None


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def make_record(page_id: str | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """A response record with the payload, or a revisit record without it."""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        "Content-Type: application/http; msgtype=response",
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return b"".join([("\r\n".join(head) + "\r\n\r\n").encode(), http, payload, b"\r\n\r\n"])


def parse_record(record: bytes) -> dict:
    """The fields of READ; the digest and size of a response are computed from
    its payload, those of a revisit are read from its headers."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind = fields["WARC-Type"]
    if kind == "response":
        digest = hashlib.sha1(payload).hexdigest()
        if digest != stated or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": stated,
        "record_type": kind,
        "refers_to": _page_of(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


# -- bundles -----------------------------------------------------------------


class BundleWriter:
    """Appends records to one bundle file; ``add`` returns (frame, offset)."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard

        self._zstd = zstandard.ZstdCompressor(level=level)
        store, path = open_store(uri)
        self._out = store.open_output_stream(path, compression=None)
        self._frame_bytes = frame_bytes
        self._entries: list[tuple[int, int]] = []
        self._held: list[bytes] = []
        self._size = 0
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self._size and self._size + len(record) > self._frame_bytes:
            self._flush()
        at = len(self._entries), self._size
        self._held.append(record)
        self._size += len(record)
        return at

    def _flush(self) -> None:
        if self._held:
            frame = self._zstd.compress(b"".join(self._held))
            self._out.write(frame)
            self._entries.append((len(frame), self._size))
            self.written += len(frame)
            self._held, self._size = [], 0

    def close(self) -> None:
        self._flush()
        entries = b"".join(ENTRY.pack(*e) for e in self._entries)
        footer = FOOTER.pack(len(self._entries), 0, SEEKABLE_MAGIC)
        self._out.write(SKIPPABLE.pack(SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self._out.close()


@dataclass
class Bundle:
    """An open bundle and its seek table: (start, compressed, decompressed)."""

    file: object
    frames: list[tuple[int, int, int]]

    @classmethod
    def open(cls, uri: str) -> Bundle:
        store, path = open_store(uri)
        file = store.open_input_file(path)
        end = file.size()
        count, _, magic = FOOTER.unpack(file.read_at(FOOTER.size, end - FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        raw = file.read_at(count * ENTRY.size, end - FOOTER.size - count * ENTRY.size)
        frames, start = [], 0
        for packed, size in ENTRY.iter_unpack(raw):
            frames.append((start, packed, size))
            start += packed
        return cls(file, frames)

    def frame(self, k: int) -> bytes:
        import zstandard

        start, packed, size = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, start), max_output_size=size)


# -- Spark jobs --------------------------------------------------------------


def with_roles(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """`(page_id, url, payload, payload_bytes, payload_digest, refers_to)`; the
    payload of a revisit is null."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    own = pages.select("page_id", "url", payload.alias("payload"))
    own = own.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1("payload")})
    large = own.where(F.col("payload_bytes") >= min_revisit)
    shared = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("first_page"), F.count("*").alias("_n"))
    shared = stored(shared.where("_n > 1").drop("_n"), "warc-shared")
    shared = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    joined = own.join(shared, ["payload_digest", "payload_bytes"], "left")
    revisits = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return joined.select(
        "page_id",
        "url",
        F.when(~revisits, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisits, F.col("first_page")).alias("refers_to"),
    )


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``records`` (as from ``with_roles``) to bundles below ``folder``;
    the stored index of those that count."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, uri = None, ""
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if writer is None:
                    uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(uri, frame_bytes)
                record = make_record(r.page_id, r.url, r.payload or b"", r.payload_digest, int(r.payload_bytes), r.refers_to)
                frame, offset = writer.add(record)
                rows.append((r.page_id, uri, frame, offset, len(record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in INDEX.split(", ")])
        if writer is not None:
            writer.close()

    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    named = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    named = named.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
    return stored(named.mapInPandas(write, INDEX).withColumn("page_id", F.col("page_id").cast("bigint")), "warc-index")


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of an index (or of any rows chosen from it), as READ plus
    (bundle, frame, offset)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uri = bundle = data = None
        held = -1
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.bundle != uri:
                    uri, bundle, held = r.bundle, Bundle.open(r.bundle), -1
                if r.frame != held:
                    data, held = bundle.frame(r.frame), r.frame
                row = parse_record(data[r.offset : r.offset + r.length])
                if not with_payload:
                    row["payload"] = None
                rows.append(row | {"bundle": uri, "frame": r.frame, "offset": r.offset})
                if len(rows) == 1000 or sum(len(x["payload"] or b"") for x in rows[-1:]) > 1 << 20:
                    yield pd.DataFrame(rows)
                    rows = []
            if rows:
                yield pd.DataFrame(rows)

    rows = index.select("bundle", "frame", "offset", "length").repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
    out = rows.mapInPandas(read, READ + ", bundle string, frame int, offset long")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = write_bundles(with_roles(pages), scratch_path(spark, "warc"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
