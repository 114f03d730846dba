"""Sinks: table output (S5) and metadata documents.

Tables go through Spark's commit protocol (task output is promoted only when
the job commits), which gives the all-or-nothing hand-over the original gets
from a temp file and rename. Small JSON documents are written through the
Hadoop FileSystem of the target path (temp file, then rename), so they cost no
Spark job and work on any filesystem the cluster can reach.
"""
from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .readers import nested_to_text


def _default(o):
    if isinstance(o, (_dt.datetime, _dt.date)):
        return o.isoformat()
    if isinstance(o, set):
        return sorted(o)
    if hasattr(o, "item"):
        return o.item()
    return str(o)


def write_table(df: DataFrame, path: str) -> str:
    """Parquet, overwrite; nested / binary columns become text first."""
    nested_to_text(df).write.mode("overwrite").parquet(path)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.mkdirs(p)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones (``_``, ``.``) left out; none if there is no such folder."""
    fs, p, _ = _fs(spark, path)
    names = [str(x.getPath().getName()) for x in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that the library itself wrote; one that is gone already is no error."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a folder of small files (a saved model) within the cluster's file systems."""
    fs, p, jvm = _fs(spark, source)
    to_fs, to, _ = _fs(spark, target)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to_fs, to, False, conf):
        raise OSError(f"{source} could not be copied to {target}")


def write_json(spark: SparkSession, obj, path: str) -> str:
    """One JSON document (dates ISO, sets as lists), replaced atomically where the FS allows."""
    text = json.dumps(obj, default=_default)
    try:
        fs, p, jvm = _fs(spark, path)
        tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
        out = fs.create(tmp, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if fs.exists(p):
            fs.delete(p, True)
        if not fs.rename(tmp, p):
            raise OSError(f"rename failed for {path}")
    except Exception:  # no JVM gateway (e.g. a remote client): write through a one-row DataFrame
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_doc(spark: SparkSession, path: str):
    """Read a document written by ``write_json`` (file, or folder of one text part)."""
    try:
        fs, p, jvm = _fs(spark, path)
        if fs.getFileStatus(p).isFile():
            stream = fs.open(p)
            try:
                text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            return json.loads(text)
    except Exception:
        pass
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else None
