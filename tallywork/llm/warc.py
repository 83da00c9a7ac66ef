"""WARC archives in seekable Zstandard: records in independent frames, a seek table at the end.

An archive is a row of frames followed by a skippable frame that lists their compressed and plain
sizes, in the public seekable format. The record index names the archive, the frame and the place
inside the frame, so one record costs one read of one frame.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import field
from tallywork.sources.scratch import materialize, new_path

FRAME_BYTES = 1 << 20  # plain bytes after which a frame ends
ARCHIVE_BYTES = 64 << 20  # compressed bytes after which an archive ends
DATE = "2026-01-01T00:00:00Z"  # WARC-Date unless the caller names one: reruns write equal archives

# Fixed values of the seekable format: magic numbers and layouts.
_SKIPPABLE_MAGIC = 0x184D2A5E
_SEEKABLE_MAGIC = 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<II")
_HEAD = struct.Struct("<II")

_INDEX = "archive string, frame int, ids array<long>, offsets array<long>, lengths array<long>"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_NAMESPACE = uuid.UUID(int=0)


def assign_types(pages: DataFrame, at_least: int = 0, id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url") -> DataFrame:
    """(page_id, uri, payload, refers_to): of equal payloads the largest id stays, the others refer to it.

    Only payloads of ``at_least`` bytes are compared. NULL payloads are empty ones. Rows that share the
    largest id are all responses; a row without id is a response unless its payload has one with an id.
    Groups of copies are counted before the shuffle, and single payloads are left out of the join's
    small side.
    """
    payload = F.encode(F.coalesce(field(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(field(id_col).cast("long").alias("page_id"), field(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("_sha1", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= at_least
    groups = (
        rows.filter(long_enough)
        .groupBy(F.col("_sha1").alias("_key"))
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_last").isNotNull())
        .drop("_n")
    )
    revisits = ~F.col("page_id").eqNullSafe(F.col("_last"))
    return rows.join(groups, (F.col("_sha1") == F.col("_key")) & long_enough, "left").select(
        "page_id", "uri", "payload", F.when(F.col("_last").isNotNull() & revisits, F.col("_last")).alias("refers_to")
    )


def write_archives(typed: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Write archives from :func:`assign_types`; the index, one row per frame.

    ``folder`` is a URI every executor can write. A task writes archives under names of its own and only
    those in the stored index count, so a task that ran twice leaves no doubt.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archive = None
        for batch in batches:
            for page_id, uri, payload, refers_to in batch.itertuples(index=False, name=None):
                archive = archive or _Archive(folder)
                archive.add(*_record(page_id, uri, payload, refers_to, date))
                if archive.full():
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    # ids travel as text: a column of long with NULLs would turn to double
    texts = typed.select(F.col("page_id").cast("string"), "uri", "payload", F.col("refers_to").cast("string"))
    return materialize(texts.mapInPandas(write, _INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the index, read back frame by frame; digests are taken anew for responses."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, list] = {}
        for batch in batches:
            for archive, frame, ids, offsets, lengths in batch.itertuples(index=False, name=None):
                if archive not in tables:
                    tables = {archive: seek_table(archive)}
                plain = read_frame(archive, tables[archive], frame)
                found = [
                    parse_record(plain[o : o + n]) for o, n in zip(offsets, lengths, strict=True)
                ]
                yield pd.DataFrame(
                    {
                        "page_id": pd.array([r["page_id"] for r in found], dtype="Int64"),
                        "payload_bytes": [r["payload_bytes"] for r in found],
                        "payload_digest": [r["payload_digest"] for r in found],
                        "record_type": [r["record_type"] for r in found],
                        "refers_to": pd.array([r["refers_to"] for r in found], dtype="Int64"),
                    }
                )

    return index.mapInPandas(read, _READ)


def archive_and_read(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    An empty table gives no archive and no rows; NULL urls become a URN made of the id; other columns
    are ignored.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(assign_types(pages), folder))


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; a bare path is a local one."""
    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def seek_table(archive: str) -> list[tuple[int, int, int]]:
    """(position, compressed size, plain size) of every frame, from the archive's last bytes."""
    system, path = open_folder(archive)
    with system.open_input_file(path) as f:
        size = f.size()
        frames, _flags, magic = _FOOTER.unpack(f.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _SEEKABLE_MAGIC:
            raise ValueError(f"{archive} has no seek table")
        listed = f.read_at(frames * _ENTRY.size, size - _FOOTER.size - frames * _ENTRY.size)
    at, table = 0, []
    for packed, plain in _ENTRY.iter_unpack(listed):
        table.append((at, packed, plain))
        at += packed
    return table


def read_frame(archive: str, table: list[tuple[int, int, int]], frame: int) -> bytes:
    """One frame's plain bytes; the rest of the archive is not read."""
    at, packed, plain = table[frame]
    system, path = open_folder(archive)
    with system.open_input_file(path) as f:
        return zstandard.ZstdDecompressor().decompress(f.read_at(packed, at), max_output_size=plain)


def parse_record(record: bytes) -> dict:
    """Fields of one WARC record."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    own, refers = fields["X-Page-Id"], fields.get("X-Refers-To-Page-Id")
    out = {"page_id": int(own) if own else None, "record_type": fields["WARC-Type"], "refers_to": int(refers) if refers else None}
    if fields["WARC-Type"] == "revisit":
        return out | {"payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": None}
    payload = block.partition(b"\r\n\r\n")[2]
    return out | {"payload_bytes": len(payload), "payload_digest": _digest(payload), "payload": payload}


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{kind}:{page_id}')}>"


def _record(page_id: str | None, uri: str | None, payload: bytes, refers_to: str | None, date: str) -> tuple[int, bytes]:
    own = page_id or ""
    uri = (uri or f"urn:page:{own}").replace("\r", "%0D").replace("\n", "%0A")
    digest = _digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(own, kind)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-Id: {own}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_urn(refers_to, 'response')}",
            f"X-Refers-To-Page-Id: {refers_to}",
            f"X-Payload-Length: {len(payload)}",
        ]
    return int(page_id) if page_id else -1, "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Archive:
    """One archive being written: the open frame in memory, finished frames in the file."""

    def __init__(self, folder: str):
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.uri, self.file = f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=3)
        self.plain, self.places, self.frames, self.index, self.size = io.BytesIO(), [], [], [], 0

    def add(self, page_id: int, record: bytes) -> None:
        self.places.append((page_id, self.plain.tell(), len(record)))
        self.plain.write(record)
        if self.plain.tell() >= FRAME_BYTES:
            self._end_frame()

    def full(self) -> bool:
        return self.size >= ARCHIVE_BYTES

    def close(self) -> pd.DataFrame:
        if self.places:
            self._end_frame()
        table = b"".join(_ENTRY.pack(*f) for f in self.frames) + _FOOTER.pack(len(self.frames), 0, _SEEKABLE_MAGIC)
        self.file.write(_HEAD.pack(_SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()
        return pd.DataFrame(self.index, columns=["archive", "frame", "ids", "offsets", "lengths"])

    def _end_frame(self) -> None:
        packed = self.packer.compress(self.plain.getvalue())
        self.file.write(packed)
        ids, offsets, lengths = map(list, zip(*self.places, strict=True))
        self.index.append((self.uri, len(self.frames), ids, offsets, lengths))
        self.frames.append((len(packed), self.plain.tell()))
        self.size += len(packed)
        self.plain, self.places = io.BytesIO(), []
