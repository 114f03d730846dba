"""Records of one large file, cut out of byte ranges by many tasks.

A CSV field may hold line ends and a JSON array is one value, so where a byte
range begins says nothing about where a record does. Spark's text reader deals a
file out in ranges of whole pieces (lines of a CSV, text up to a ``}`` of a JSON
array). The scan then takes two passes:

1. Each range tells, for both states it may be entered in (outside or inside a
   quoted field or string), the state it leaves in and by how much it changes the
   depth. These small functions, one row a range, are composed in file order, which
   gives every range the state it really begins in.
2. Each range is read again from that state and cut into records. What lies before
   its first record end and after its last one belongs to records that run over the
   range's edges; these fragments, at most two a range, are put together by a window
   and a grouping.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, travels

travels(__name__)

_BOM = b"\xef\xbb\xbf"
# A field with its comma; a field in quotes, closed; the rest of a field entered inside quotes; a whole JSON string; its rest.
_FIELD = re.compile(rb'(?:[ \t]*+(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+')
_CLOSED = re.compile(rb'[ \t]*+"[^"]*+(?:""[^"]*+)*+"')
_QUOTED = re.compile(rb'[ \t]*+"')
_QUOTED_REST = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
_STRING = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_STRING_REST = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_BETWEEN = re.compile(rb"\s*+,\s*+")
_FIRST = re.compile(rb"\s*+\[\s*+")
_CLOSE = re.compile(rb"\s*+\]\s*+\Z")
_CLOSE_EMPTY = re.compile(rb"\s*+\[\s*+\]\s*+\Z")

WHOLE, OPENS, RUNS_ON, ENDS = 0, 1, 2, 3
_PART = pa.schema([("path", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()), ("text", pa.binary())])


# ---- what a piece does to the state

def _csv_exit(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open after a line (without line ends) that begins inside one or not."""
    if b'"' not in line:
        return inside
    at = 0
    if inside:
        at = _QUOTED_REST.match(line).end()
        if at == len(line):
            return True
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1
    at = _FIELD.match(line, at).end()
    return bool(_QUOTED.match(line, at)) and not _CLOSED.match(line, at)


def _json_exit(piece: bytes, inside: bool) -> tuple[bool, int]:
    """Whether a string is open after a piece, and the change of depth; the ``}`` after the piece is not counted."""
    if inside:
        rest = _STRING_REST.match(piece)
        if not rest:
            return True, 0
        piece = piece[rest.end():]
    bare = _STRING.sub(b"", piece)
    opened = bare.find(b'"')
    if opened >= 0:
        bare = bare[:opened]
    return opened >= 0, bare.count(b"{") + bare.count(b"[") - bare.count(b"}") - bare.count(b"]")


def _pieces(batches) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """(path, start, pieces) of each range of a task; a task's ranges come one after another."""
    rows = ((p, s, v) for b in batches for v, p, s in zip(*(c.to_pylist() for c in b.columns), strict=True))
    row = next(rows, None)
    while row:
        here = row[:2]

        def pieces():
            nonlocal row
            first = here[1] == 0
            while row and row[:2] == here:
                yield row[2].removeprefix(_BOM) if first else row[2]
                first = False
                row = next(rows, None)
        part = pieces()
        yield (*here, part)
        for _ in part:  # what the reader left
            pass


# ---- pass 1

def _csv_effect(batches):
    for path, start, lines in _pieces(batches):
        out = [False, True]
        for line in lines:
            for part in line.split(b"\r"):
                out = [_csv_exit(part, s) for s in out]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (path, start, *map(int, out), 0, 0)], names=_EFFECT)


def _json_effect(batches):
    for path, start, pieces in _pieces(batches):
        out, depth = [False, True], [0, 0]
        for piece in pieces:
            for k in (0, 1):
                out[k], change = _json_exit(piece, out[k])
                depth[k] += change - (not out[k])  # the } that ends a piece closes something unless it is text
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (path, start, *map(int, out), *depth)], names=_EFFECT)


_EFFECT = ["path", "start", "exit0", "exit1", "depth0", "depth1"]


def _entries(pieces: DataFrame, effect) -> tuple[dict, dict]:
    """(inside, depth) in which each range begins, and in which each file ends."""
    rows = pieces.mapInArrow(effect, "path string, start bigint, exit0 bigint, exit1 bigint, depth0 bigint, depth1 bigint").collect()
    begin, end = {}, {}
    for r in sorted(rows, key=lambda r: (r["path"], r["start"])):  # one row a range
        inside, depth = end.get(r["path"], (0, 0))
        begin[r["path"], r["start"]] = inside, depth
        end[r["path"]] = r[f"exit{inside}"], depth + r[f"depth{inside}"]
    return begin, end


# ---- pass 2

def _parts(path: str, start: int, records: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for seq, (kind, text) in enumerate(records):
        rows.append((path, start, seq, kind, text))
        size += len(text) + 64
        if size > 1 << 20:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PART, strict=True)], schema=_PART)


def _csv_records(lines: Iterator[bytes], inside: bool) -> Iterator[tuple[int, bytes]]:
    """Records without their line ends; blank lines are none."""
    held, head = [], inside
    for line in lines:
        parts = line.split(b"\r")
        for k, part in enumerate(parts):
            inside = _csv_exit(part, inside)
            held.append(part)
            if inside:
                held.append(b"\n" if k == len(parts) - 1 else b"\r")
                continue
            text = b"".join(held)
            if head or text.strip():
                yield ENDS if head else WHOLE, text
            held, head = [], False
    if held:
        yield RUNS_ON if head else OPENS, b"".join(held)


def _json_records(path: str, start: int, pieces: Iterator[bytes], inside: bool, depth: int) -> Iterator[tuple[int, bytes]]:
    """Records of an array at depth 1, each from ``{`` to its ``}``; anything else in the array is an error."""
    def wrong(what: str):
        return ValueError(f"not an array of JSON records: {what} in {path} after byte {start}")

    head = inside or depth > 1
    held, begun = [], head or depth == 1
    for piece in pieces:
        if not held and not head:
            if _CLOSE.match(piece) if begun else _CLOSE_EMPTY.match(piece):
                break
            lead = (_BETWEEN if start or begun else _FIRST).match(piece)
            if start and not begun:
                raise wrong("text after its end")
            if not lead or not piece.startswith(b"{", lead.end()):
                raise wrong("something that is no record")
            if not begun:
                depth, begun = 1, True
            piece = piece[lead.end():]
        inside, change = _json_exit(piece, inside)
        depth += change - (not inside)
        held += [piece, b"}"]
        if not inside and depth == 1:
            yield ENDS if head else WHOLE, b"".join(held)
            held, head = [], False
        elif depth < 1:
            raise wrong("an unmatched bracket")
    if held:
        yield RUNS_ON if head else OPENS, b"".join(held)


def _one_line(record: bytes) -> bytes:
    """A JSON record without line ends; a line end in a string is no JSON."""
    if b"\n" in record or b"\r" in record:
        bare = _STRING.sub(b"", record)
        for end in (b"\n", b"\r"):
            if bare.count(end) != record.count(end):
                raise ValueError("a JSON string runs over a line's end")
        record = record.replace(b"\r", b" ").replace(b"\n", b" ")
    return record


def _cutter(kind: str, begin):
    def cut(batches):
        for path, start, pieces in _pieces(batches):
            inside, depth = begin.value[path, start]
            if kind == "csv":
                records = _csv_records(pieces, bool(inside))
            else:
                records = _json_records(path, start, pieces, bool(inside), depth)
            yield from _parts(path, start, records)
    return cut


def _liner(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([_one_line(x) for x in b.column(0).to_pylist()], pa.binary())], names=["text"])


# ---- records

def _read_pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    return spark.read.option("lineSep", end).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"))


def _records(spark: SparkSession, pieces: DataFrame, kind: str, begin: dict) -> DataFrame:
    """(path, start, seq, text) of all records; start and seq are those of a record's first part."""
    cut = pieces.mapInArrow(_cutter(kind, spark.sparkContext.broadcast(begin)),
                            "path string, start bigint, seq bigint, kind int, text binary")
    out = scratch_path(spark, f"{kind}-records")
    cut.write.parquet(out)  # read more than once from here on
    parts = spark.read.parquet(out)
    order = Window.partitionBy("path").orderBy("start", "seq")  # at most two short rows a range
    runs = parts.where(F.col("kind") != WHOLE).withColumn("run", F.sum((F.col("kind") == OPENS).cast("int")).over(order))
    joined = (runs.groupBy("path", "run").agg(F.array_sort(F.collect_list(F.struct("start", "seq", "text"))).alias("p"))
              .select("path", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["seq"].alias("seq"),
                      F.aggregate("p", F.lit(bytearray()), lambda a, x: F.concat(a, x["text"])).alias("text")))
    found = parts.where(F.col("kind") == WHOLE).select("path", "start", "seq", "text").unionByName(joined)
    # files of the result follow the order of the source, so positions taken from them are those of the source
    place = ["path", "start", "seq"]
    return found.repartitionByRange(max(1, len(begin)), *place).sortWithinPartitions(*place)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, seq, text) of the records of CSV files, quoted line ends in them; the header is record (0, 0) of its file.

    A quote opens a field only at the field's beginning, doubled quotes are text, and what follows a closing
    quote up to the comma belongs to the field. A field that is never closed ends with its file.
    """
    pieces = _read_pieces(spark, path, "\n")
    begin, _ = _entries(pieces, _csv_effect)
    out = scratch_path(spark, "csv-in-order")
    _records(spark, pieces, "csv", begin).write.parquet(out)
    return spark.read.parquet(out)


def json_lines(spark: SparkSession, path: str) -> str:
    """Write the records of files that are JSON arrays one a line; the folder. A file that is no array of records raises."""
    pieces = _read_pieces(spark, path, "}")
    begin, end = _entries(pieces, _json_effect)
    for name, (inside, depth) in end.items():
        # the text after the last } has none of its own
        if inside or depth != -1:
            raise ValueError(f"the JSON array does not end: {name}")
    records = _records(spark, pieces, "json", begin)
    out = scratch_path(spark, "json-lines")
    records.select("text").mapInArrow(_liner, "text binary").select(F.col("text").cast("string").alias("value")).write.text(out)
    return out
