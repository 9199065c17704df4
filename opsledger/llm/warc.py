"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Writing: records with equal payloads of at least ``min_bytes`` bytes are stored once, by the largest page_id; the
others are revisits without payload. A task writes archives of about ``ARCHIVE_BYTES`` into a folder that all
executors share, under a name of its own attempt, and renames each when it is complete; a repeated task writes the
same names again. The manifest of archives is stored, so only finished archives are read.

Reading: a stream is inflated piece by piece, each member is one record, its header gives the length of its block,
and block and payload digests are compared with the bytes read. A record that does not hold what it says raises.

Defined cases: null html is an empty payload, null url leaves out the target, a null page_id is kept as an
empty id and is a revisit if another page has its payload; rows that share the largest page_id are all responses;
repeated rows give one record each; an empty table gives no archive and no rows. Extra columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from opsledger.session import new_run_dir

from .shared import broadcast_if_small, small_batches, store, table

ARCHIVE_BYTES = 64 << 20
CHUNK = 64 << 10
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, "
           "payload binary")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, not compressed."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block += b"" if refers_to is not None else payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page_id)),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _name(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """The inflated members of a stream, one after the other."""
    unpack, parts, rest, begun = zlib.decompressobj(31), [], b"", False
    while True:
        data = rest or stream.read(chunk)
        if not data:
            break
        begun = True        # also where only a part of the member's head has come
        parts.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts, begun = zlib.decompressobj(31), [], False
    if begun:
        raise ValueError("the archive ends inside a record")


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse(data: bytes) -> tuple[dict[str, str], bytes, dict[str, str]]:
    """Header fields, payload and HTTP fields of a record whose framing and digests hold."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/1."):
        raise ValueError("no record header")
    fields = _fields(head)
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"wrong length in {fields['warc-record-id']}")
    if fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"wrong block digest in {fields['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{digest(payload)}":
        raise ValueError(f"wrong payload digest in {fields['warc-record-id']}")
    lines = _fields(http)
    if fields["warc-type"] == "response" and len(payload) != int(lines["content-length"]):
        raise ValueError(f"wrong payload length in {fields['warc-record-id']}")
    return fields, payload, lines


def read_archive(stream, records: int | None = None) -> Iterator[dict]:
    """The records of an archive; ``records`` is how many it must hold."""
    found = 0
    for data in members(stream):
        found += 1
        fields, payload, http = parse(data)
        ids = {k: re.fullmatch(r"<urn:page:(-?\d*)>", fields.get(k, "<urn:page:>"))[1]
               for k in ("warc-record-id", "warc-refers-to")}
        yield {
            "page_id": int(ids["warc-record-id"]) if ids["warc-record-id"] else None,
            "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "refers_to": int(ids["warc-refers-to"]) if ids["warc-refers-to"] else None,
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
            "payload_bytes": int(http["content-length"]),
            "payload": payload if fields["warc-type"] == "response" else None,
        }
    if records is not None and found != records:
        raise ValueError(f"the archive holds {found} records instead of {records}")


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, level: int = LEVEL) -> DataFrame:
    """Writes the pages as archives into ``folder``; returns the stored manifest."""
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("key"),
                         F.octet_length(payload).alias("n"))
    firsts = (
        keyed.where(F.col("n") >= min_bytes).groupBy("key", "n")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1")
        .select("key", "n", "original")
    )
    firsts = broadcast_if_small(store(firsts, "warc-firsts"))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("original")), F.col("original"))
    rows = keyed.join(firsts, ["key", "n"], "left").select("page_id", "url", "html", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = _open(folder)
        system.create_dir(at, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        out, files, size, count = None, [], 0, 0

        def close():
            nonlocal out
            out.close()
            system.move(f"{at}/.{attempt}", f"{at}/part-{part:06d}-{len(files):04d}.warc.gz")
            files.append((f"{at}/part-{part:06d}-{len(files):04d}.warc.gz", count, size))
            out = None

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, size, count = system.open_output_stream(f"{at}/.{attempt}", compression=None), 0, 0
                data = _gzip(record(page_id, url, (html or "").encode(), refers_to), level)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
        if out is not None:
            close()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*files, strict=True)], ["path", "records", "bytes"])

    return store(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives named in ``manifest`` (columns ``path`` and ``records``)."""
    n = min(max(manifest.count(), 1), 10_000)
    columns = [c.split(" ")[0] for c in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for row in read_archive(stream, records):
                        rows.append(row if with_payload else row | {"payload": None})
                        size += len(rows[-1]["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], k) for c, k in zip(columns, kinds, strict=True)], columns)

    return manifest.select("path", "records").repartition(n).mapInArrow(read, RECORDS)


def op8_warc(spark, folder: str) -> DataFrame:
    archive = new_run_dir(spark, "warc")
    manifest = write_archives(table(spark, folder, "pages"), archive)
    return read_archives(manifest, archive, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
