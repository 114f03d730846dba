"""WARC archives: write them, normalise monolithic gzip files, read records by offset.

A whole archive is sometimes compressed as one gzip stream, which cannot be
entered in the middle. The normaliser inflates such a file once, as a stream,
rewrites every record as a gzip member of its own and writes a sidecar index
(offset and length of each member). Records are then read one by one through the
index. Files live in a folder that the driver and all executors share; a task
writes to a name of its own and moves the file into place when it is whole.
"""
from __future__ import annotations

import base64
import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, scratch, small_batches, travels, written

travels(__name__)

CHUNK = 1 << 20
GZIP = 31  # zlib's window bits for a gzip member
FAST, SMALL = 1, 4  # compression levels: first writing, normalised members
# Content after which a task begins a new archive: what one task normalises and reads is bounded by it and one record.
ARCHIVE_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"
# Headers are held in memory: a stream with no blank line for so long is no archive.
MAX_HEADER = 1 << 28


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; local paths and file: need no library, others are pyarrow's."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class _File:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.fs, base = open_folder(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.own = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.out = self.fs.open_output_stream(self.own, compression=None)
        return self.out

    def __exit__(self, failed, *rest):
        self.out.close()
        if failed is None:
            self.fs.move(self.own, self.path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: object) -> str:
    """A null id has an urn without a colon after it; all other ids are escaped, the empty one too."""
    return "urn:x-no-page" if page_id is None else f"urn:x-page:{quote(str(page_id), safe='')}"


def _page(uri: str | None) -> str | None:
    known = uri is not None and uri.startswith("<urn:x-page:")
    return unquote(uri[len("<urn:x-page:"):-1]) if known else None


def record(page_id: object, url: str | None, payload: bytes, revisit: bool, refers: object) -> bytes:
    """One record: a response with its payload, or a revisit whose HTTP header alone tells the payload's length."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_uri(page_id)}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if revisit:
        head += [f"WARC-Refers-To: <{_uri(refers)}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflate(source, where: str) -> Iterator[bytes]:
    """The content of a gzip file, piece by piece, whether it is one member or many."""
    z = zlib.decompressobj(GZIP)
    whole = True
    while data := source.read(CHUNK):
        while data:
            whole = False
            yield z.decompress(data, CHUNK)
            while z.unconsumed_tail:
                yield z.decompress(z.unconsumed_tail, CHUNK)
            if not z.eof:
                break
            whole, data, z = True, z.unused_data, zlib.decompressobj(GZIP)
    if not whole:
        raise ValueError(f"{where}: the gzip stream ends too early")


class _Stream:
    """Exact reads from pieces; holds little more than one piece."""

    def __init__(self, pieces: Iterator[bytes], where: str):
        self.pieces, self.where, self.buffer = pieces, where, bytearray()

    def _more(self) -> bool:
        for p in self.pieces:
            if p:
                self.buffer += p
                return True
        return False

    def header(self) -> bytes | None:
        """Bytes up to and with the next blank line; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.buffer)
            if seen > MAX_HEADER:
                raise ValueError(f"{self.where}: a record header has no end")
            if not self._more():
                if self.buffer.strip(b"\r\n"):
                    raise ValueError(f"{self.where}: the last record is cut, its header has no end")
                return None
        out = bytes(self.buffer[:at + 4])
        del self.buffer[:at + 4]
        return out

    def body(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise ValueError(f"{self.where}: the last record is cut")
            out = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(out)
            yield out


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def normalise(source, out, where: str) -> list[dict]:
    """Rewrite an archive with one gzip member a record; the index: a dict for each member."""
    stream, index, offset = _Stream(inflate(source, where), where), [], 0
    while (header := stream.header()) is not None:
        fields = _fields(header)
        z = zlib.compressobj(SMALL, zlib.DEFLATED, GZIP)
        size = out.write(z.compress(header))
        for piece in stream.body(int(fields["content-length"]) + 4):
            size += out.write(z.compress(piece))
        size += out.write(z.flush())
        index.append({"offset": offset, "length": size, "id": fields["warc-record-id"], "type": fields["warc-type"]})
        offset += size
    return index


def parse(member: bytes, where: str) -> dict:
    """A record read alone: page, payload length and digest, type, and the page it refers to."""
    raw = zlib.decompress(member, GZIP)
    header, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(header)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(_fields(http)["content-length"])
    if not revisit and (len(payload), payload_digest(payload)) != (length, digest):
        raise ValueError(f"{where}: the payload of {fields['warc-record-id']} does not match its digest")
    return {"page_id": _page(fields["warc-record-id"]), "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to"))}


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write a record for each page into monolithic gzip archives of about ARCHIVE_BYTES; returns (archive, records).

    Of the pages with one payload that with the smallest id is the response, the
    others revisit it. Null html is an empty payload, a null URL is left out. A null
    id is no group's smallest: such a page revisits, unless its group has no id.
    Rows that repeat the response's id are responses too.
    """
    small_batches(pages.sparkSession)
    src = pages.select(col(id_col).cast("string").alias("page"), col(id_col).alias("id"), col(url_col).alias("url"),
                       F.coalesce(col(html_col), F.lit("")).cast("binary").alias("payload")).withColumn(
        "sha", F.unhex(F.sha1("payload")))
    # only payloads that several pages share; one row each
    first = (src.groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("sha").alias("same"), F.col("first").cast("string").alias("first")))
    rows = src.join(first, F.col("sha") == F.col("same"), "left").select(
        "page", "url", "payload", F.when(~F.col("first").eqNullSafe(F.col("page")), F.col("first")).alias("refers"))

    def write(batches):
        task = TaskContext.get().partitionId()
        todo = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        row, number = next(todo, None), 0
        while row is not None or not number:  # a task without pages leaves an empty archive
            name, n, size = f"pages-{task:06d}-{number:04d}.warc.gz", 0, 0
            with _File(folder, name) as out:
                z = zlib.compressobj(FAST, zlib.DEFLATED, GZIP)
                while row is not None and size < ARCHIVE_BYTES:
                    page, url, payload, refers = row
                    raw = record(page, url, payload, refers is not None, refers)
                    out.write(z.compress(raw))
                    n, size, row = n + 1, size + len(raw), next(todo, None)
                out.write(z.flush())
            number += 1
            yield pa.RecordBatch.from_pylist([{"archive": name, "records": n}], schema=_WRITTEN)

    return written(rows.mapInArrow(write, "archive string, records long"), "warc-written")


_WRITTEN = pa.schema([("archive", pa.string()), ("records", pa.int64())])


def normalise_archives(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite archives (column ``archive``: file names in ``source``) member by member into ``target``.

    Writes each archive under its name and an index beside it (``.idx``, one JSON
    object a line); returns (archive, records). A cut or damaged file raises. A
    file is one task's work, streamed: memory does not grow with it.
    """
    def work(batches):
        at, base = open_folder(source)
        for batch in batches:
            done = []
            for name in batch.column(0).to_pylist():
                with at.open_input_stream(f"{base}/{name}", compression=None) as raw, _File(target, name) as out:
                    index = normalise(raw, out, name)
                with _File(target, f"{name}.idx") as out:
                    out.write("".join(json.dumps(x) + "\n" for x in index).encode())
                done.append({"archive": name, "records": len(index)})
            yield pa.RecordBatch.from_pylist(done, schema=_WRITTEN)

    return written(_spread(archives).mapInArrow(work, "archive string, records long"), "warc-normalised")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of normalised archives, each read alone by its offset; a damaged one raises."""
    def work(batches):
        at, base = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with at.open_input_stream(f"{base}/{name}.idx", compression=None) as raw:
                    index = [json.loads(x) for x in raw.read().decode().splitlines()]
                with at.open_input_file(f"{base}/{name}") as file:
                    for k in range(0, len(index), 1000):
                        rows = []
                        for x in index[k:k + 1000]:
                            file.seek(x["offset"])
                            rows.append(parse(file.read(x["length"]), name))
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    return _spread(archives).mapInArrow(work, "page_id string, payload_bytes long, payload_digest string, "
                                              "record_type string, refers_to string")


_RECORD = pa.schema([("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.string())])


def _spread(archives: DataFrame) -> DataFrame:
    """One row a file, one file a task."""
    place = F.row_number().over(Window.orderBy("archive")) - 1  # a row a file
    return archives.select("archive", place.alias("_at")).repartitionById(
        max(1, archives.count()), F.col("_at")).select("archive")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write pages as monolithic archives, normalise them and read every record back: a row per page."""
    spark: SparkSession = pages.sparkSession
    base = scratch(spark, "warc")
    archives = write_archives(pages, os.path.join(base, "monolithic"), id_col, url_col, html_col)
    archives = normalise_archives(archives, os.path.join(base, "monolithic"), os.path.join(base, "members"))
    kind = dict(pages.dtypes)[id_col]
    back = read_archives(archives, os.path.join(base, "members"))
    return back.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})
