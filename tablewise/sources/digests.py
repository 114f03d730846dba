"""Content digests of files as a tree over fixed byte ranges.

A file is cut into chunks of CHUNK_BYTES. Any task may read any run of chunks; a
leaf is the MD5 of one chunk, and up to FANOUT digests in order make the digest
above them, until one is left. The digest depends on the bytes and on the two
constants alone, not on how the chunks were dealt over tasks, and a file of
any size is read by as many tasks as it has runs.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import travels

travels(__name__)

CHUNK_BYTES = 4 << 20
# Chunks that one task reads in a row (64 MB).
RUN_CHUNKS = 16
# Digests that one node of the tree combines.
FANOUT = 1024


def _open(path: str):
    if path.startswith("file:"):
        source, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    elif "://" in path:
        source, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    else:
        source, name = fs.LocalFileSystem(), path
    return source.open_input_file(name)


def _leaves(chunk_bytes: int, run: int):
    """(path, first chunk) to a row for each chunk of the run: place, digest, bytes read."""
    def read(batches):
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                with _open(path) as file:
                    file.seek(min(first * chunk_bytes, file.size()))
                    for chunk in range(first, first + run):
                        piece = file.read(chunk_bytes)
                        if piece or chunk == 0:  # an empty file has one empty chunk
                            rows.append((chunk, hashlib.md5(piece).hexdigest(), len(piece)))
                        if len(piece) < chunk_bytes:
                            break
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(rows), pa.string()), *[pa.array([r[k] for r in rows], t) for k, t in
                                                                 enumerate((pa.int64(), pa.string(), pa.int64()))]],
                    names=["path", "chunk", "digest", "bytes"])
    return read


def file_digests(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, run: int = RUN_CHUNKS, fanout: int = FANOUT) -> DataFrame:
    """(path, digest, bytes_read) of files given as (path, length).

    A file of one chunk has that chunk's MD5. A node with a single child is that child. ``bytes_read``
    is what was hashed; it differs from ``length`` only if the file changed meanwhile.
    """
    spark = files.sparkSession
    most = files.agg(F.max("length")).first()[0]
    chunks = max(1, -(-(most or 0) // chunk_bytes))
    last = F.greatest(F.ceil(F.col("length") / chunk_bytes).cast("bigint") - 1, F.lit(0))
    runs = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(run).cast("bigint"))).alias("first"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = (runs.repartition(width, "path", "first")
             .mapInArrow(_leaves(chunk_bytes, run), "path string, chunk bigint, digest string, bytes bigint"))
    while chunks > 1:  # at most `fanout` digests a group
        under = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "digest"))), lambda x: x["digest"])
        nodes = (nodes.groupBy("path", F.floor(F.col("chunk") / fanout).cast("bigint").alias("node"))
                 .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), under.alias("under"))
                 .select("path", F.col("node").alias("chunk"), "bytes",
                         F.when(F.col("n") == 1, F.col("under")[0]).otherwise(F.md5(F.array_join("under", ""))).alias("digest")))
        chunks = -(-chunks // fanout)
    return nodes.select("path", "digest", F.col("bytes").alias("bytes_read"))
