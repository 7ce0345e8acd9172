"""File-system metadata helpers (Hadoop FileSystem API of the session, so
they work on any storage the cluster mounts)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def list_partitions(spark: SparkSession, path: str, column: str) -> list[tuple[str, str]]:
    """(value, folder) of the ``column=value`` folders directly under
    ``path``: a directory listing, bounded by the partition count."""
    jpath, fs = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    out = []
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(column + "="):
            out.append((name.split("=", 1)[1], st.getPath().toString()))
    return out


def file_stats(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of every file under ``path``, sorted."""
    jpath, fs = _fs(spark, path)
    out, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def delete_path(spark: SparkSession, path: str) -> bool:
    jpath, fs = _fs(spark, path)
    return bool(fs.delete(jpath, True))


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _fs(spark, path)
    return bool(fs.exists(jpath))


def publish(spark: SparkSession, src: str, dst: str) -> bool:
    """Move a finished folder to its final name in one rename; False when
    ``dst`` already exists (another writer published first)."""
    jsrc, fs = _fs(spark, src)
    jdst = spark._jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(jdst):
        return False
    parent = jdst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(jsrc, jdst))


def read_text(spark: SparkSession, path: str) -> str:
    jpath, fs = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (none if it doesn't exist)."""
    jpath, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(jpath)) if fs.exists(jpath) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, or return False because it exists. Of several writers
    one succeeds, and no reader sees a part of the content: it is written under another name
    first, which then gets its final one by a hard link (local files) or by a rename that doesn't
    overwrite (atomic on HDFS and on object stores with atomic renames)."""
    jvm = spark._jvm
    jpath, fs = _fs(spark, path)
    fs.mkdirs(jpath.getParent())
    draft, _ = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    uri = fs.makeQualified(jpath).toUri()
    try:
        if uri.getScheme() == "file":
            get = jvm.java.nio.file.Paths.get
            jvm.java.nio.file.Files.createLink(get(uri), get(fs.makeQualified(draft).toUri()))
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration()).rename(draft, jpath, none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)
