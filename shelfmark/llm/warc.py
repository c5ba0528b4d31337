"""WARC archives: writing pages as records, and a sequential reader.

Every record is one gzip member. Records with equal payloads are told by SHA-1: the one with the
smallest page_id is a ``response``, the others ``revisit`` records that name it and carry no
payload. The reader takes a file in small reads: incremental decompression member by member, the
header up to the blank line, then as many bytes as Content-Length says, hashed as they come.

Cases: a null payload counts as empty; rows that repeat a page_id with the payload of the response
are responses too, each with a record of its own; a null page_id comes after all others in the
choice of the response, and a revisit of a null one has null in refers_to; an empty table writes
no file; other columns are ignored. A record cut short or with another digest raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.storage import new_folder, stored

MIN_DEDUP_BYTES = 0        # smaller payloads are never revisited
FILE_BYTES = 256 << 20     # a file is closed once it is this large
READ_BYTES = 1 << 16
LEVEL = 1

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, fields: dict[str, str], content: bytes) -> bytes:
    """One uncompressed record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 2020-01-01T00:00:00Z",
             *[f"{k}: {v}" for k, v in fields.items()], f"Content-Length: {len(content)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    kind: str
    fields: dict[str, str]
    payload_bytes: int       # of the content after the HTTP header
    digest: str              # of those bytes, as read
    payload: bytes | None    # kept only if asked for


def read_records(stream, keep_payload: bool = False) -> Iterator[Record]:
    """Records of one archive, in file order, in bounded memory."""
    waiting = b""
    while True:
        waiting = waiting or stream.read(READ_BYTES)
        if not waiting:
            return
        member = zlib.decompressobj(31)
        head, length, fields, seen = bytearray(), None, {}, 0
        http, in_payload = bytearray(), False
        digest, size, parts, tail = hashlib.sha1(), 0, [], bytearray()
        while not member.eof:
            if not waiting:
                waiting = stream.read(READ_BYTES)
                if not waiting:
                    raise ValueError("archive ends inside a record")
            piece = member.decompress(waiting, READ_BYTES)
            waiting = member.unused_data if member.eof else member.unconsumed_tail
            if length is None:
                head += piece
                end = head.find(b"\r\n\r\n")
                if end < 0:
                    continue
                first, *lines = head[:end].decode().split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError("no WARC record")
                fields = dict(line.split(": ", 1) for line in lines)
                length, piece = int(fields["Content-Length"]), bytes(head[end + 4:])
            content, rest = piece[:length - seen], piece[length - seen:]
            seen += len(content)
            tail += rest
            if not in_payload:
                http += content
                end = http.find(b"\r\n\r\n")
                if end < 0:
                    continue
                in_payload, content = True, bytes(http[end + 4:])
            digest.update(content)
            size += len(content)
            if keep_payload:
                parts.append(content)
        if length is None or seen != length or tail != b"\r\n\r\n":
            raise ValueError("record length differs from Content-Length")
        found = base64.b32encode(digest.digest()).decode()
        kind = fields["WARC-Type"]
        if kind == "response" and fields["WARC-Payload-Digest"] != f"sha1:{found}":
            raise ValueError("payload digest differs")
        yield Record(kind, fields, size, found, b"".join(parts) if keep_payload else None)


def record_roles(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """(page_id, sha1, first_id) of each distinct page and payload; pages: page_id, sha1, size.

    A payload that thousands of pages share is reduced to its smallest page_id per task first.
    """
    told = stored(pages.select("page_id", "sha1", "size").distinct(), "warc-digests")
    first = told.groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    return told.join(first, "sha1").select(
        "page_id", "sha1", F.when(F.col("size") >= min_bytes, F.col("first_id"))
        .otherwise(F.col("page_id")).alias("first_id"))


def write_archives(pages: DataFrame, *, folder: str | None = None, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = MIN_DEDUP_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row to ``folder``; a stored manifest of the files: path, n_records.

    Each task writes files of its own under new names, so one that is run again after a lost
    executor leaves no half file in the manifest. The folder can be in any store that
    ``pyarrow.fs`` reaches from the executors.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    source = source.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    roles = record_roles(source, min_bytes)
    # A row meets the one role of its page_id and payload; the hash of both lets null ids meet too.
    key = F.xxhash64("page_id", "sha1")
    rows = (source.withColumn("at", key)
            .join(roles.select(key.alias("at"), F.col("page_id").alias("role_id"),
                               F.col("sha1").alias("role_sha1"), "first_id"), "at")
            .where(F.col("page_id").eqNullSafe(F.col("role_id")) & (F.col("sha1") == F.col("role_sha1")))
            .select("page_id", "url", "payload", "first_id"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = path = out = None
        done, written, count = [], 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                payload = (row["payload"] or "").encode()
                digest = payload_digest(payload)
                if out is None:
                    store, root = fs.FileSystem.from_uri(folder)
                    store.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", store.open_output_stream(
                        f"{root}/{name}", compression=None)
                url = json.dumps(row["url"]) if row["url"] is None else row["url"]
                fields = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                          "WARC-Target-URI": "".join(c if c >= " " else "%20" for c in url),
                          "WARC-Payload-Digest": f"sha1:{digest}",
                          "X-Page-Id": json.dumps(row["page_id"])}
                if row["page_id"] == row["first_id"]:
                    data = record_bytes("response", fields, _HTTP + payload)
                else:
                    fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/"
                                               "identical-payload-digest",
                               "X-Refers-To-Page-Id": json.dumps(row["first_id"]),
                               "X-Payload-Length": str(len(payload))}
                    data = record_bytes("revisit", fields, _HTTP)
                packed = gzip_member(data)
                out.write(packed)
                written += len(packed)
                count += 1
                if written >= file_bytes:
                    out.close()
                    done.append((path, count))
                    out, written, count = None, 0, 0
        if out is not None:
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()),
             pa.array([c for _, c in done], pa.int64())], ["path", "n_records"])

    return stored(rows.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def read_archives(manifest: DataFrame, *, id_type: str = "long",
                  with_payload: bool = False) -> DataFrame:
    """One row per record of the manifest's files; payload sizes and digests as read.

    A revisit's size is the one its header tells, and its digest that of the response.
    """
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.string()), ("url", pa.string())]
                           + [("payload", pa.binary())] * with_payload)
        for batch in batches:
            for path, expected in zip(*(batch.column(c).to_pylist() for c in ("path", "n_records"))):
                store, place = fs.FileSystem.from_uri(path)
                rows, total = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for record in read_records(stream, with_payload):
                        f, revisit = record.fields, record.kind == "revisit"
                        rows.append((
                            f["X-Page-Id"], int(f["X-Payload-Length"]) if revisit
                            else record.payload_bytes,
                            f["WARC-Payload-Digest"].removeprefix("sha1:") if revisit
                            else record.digest, record.kind,
                            f["X-Refers-To-Page-Id"] if revisit else None, f["WARC-Target-URI"],
                            *([None if revisit else record.payload] * with_payload)))
                        total += 1
                        if len(rows) >= 2000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)],
                                schema=schema)
                            rows = []
                if total != expected:
                    raise ValueError(f"{path} has {total} records, not {expected}")
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    columns = ("page_id string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to string, url string" + ", payload binary" * with_payload)
    # One task per file: a file can only be read in order.
    files = manifest.select("path", "n_records")
    spread = files.repartition(max(1, files.count()), F.xxhash64("path"))
    found = spread.mapInArrow(read, columns)

    def number(name: str):
        return F.when(F.col(name) != "null", F.get_json_object(
            F.concat(F.lit('{"v":'), F.col(name), F.lit("}")), "$.v")).cast(id_type).alias(name)

    return found.select(number("page_id"), "payload_bytes", "payload_digest", "record_type",
                        number("refers_to"), "url", *(["payload"] if with_payload else []))


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages and read the archives back: the contract's row per page."""
    kind = pages.schema[options.get("id_col", "page_id")].dataType.simpleString()
    return read_archives(write_archives(pages, **options), id_type=kind).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
