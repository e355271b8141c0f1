"""Folder operations through Hadoop's FileSystem, as a PySpark user reaches it.

Metadata calls, and the small files of the catalogue; data is always read and
written by Spark jobs.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _fs(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form (``file:/...``, ``s3a://...``) as Spark reports file paths."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    """``False`` when there was nothing to delete."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, recursive))


def delete_if_empty(spark: SparkSession, path: str) -> bool:
    """Removes a folder that holds nothing; one with entries stays."""
    fs, p = _fs(spark, path)
    try:
        return bool(fs.exists(p) and not list(fs.listStatus(p)) and fs.delete(p, False))
    except Py4JJavaError:  # something was put there meanwhile
        return False


def names_in(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names in a folder, hidden ones left out unless asked for; none when there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if hidden or n[:1] not in "_.")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file whole."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(_jvm(spark).org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def read_bytes_if(spark: SparkSession, path: str) -> bytes | None:
    """A small file whole, or None when it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    try:
        return read_bytes(spark, path)
    except Py4JJavaError:  # gone meanwhile
        if fs.exists(p):
            raise
        return None


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes or replaces a small file; readers may meet it half written."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def size_of(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(files, bytes) of the data files below a folder, hidden names left out; None when it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    n = size = 0
    todo = [p]
    while todo:
        for s in fs.listStatus(todo.pop()):
            if s.getPath().getName()[:1] in "_.":
                continue
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                n, size = n + 1, size + s.getLen()
    return n, size


_NEW_FILE = threading.Lock()


def create_new(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a small file that appears whole, unless ``path`` exists: then nothing
    changes and the answer is False.

    The file is written under a hidden name and renamed without overwriting, which
    HDFS and object stores with atomic rename decide for one of two writers. On a
    local disk the check and the rename are two steps, so writers of one process take a lock.
    """
    jvm = _jvm(spark)
    fs, final = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    flags = spark.sparkContext._gateway.new_array(options, 1)
    flags[0] = options.NONE
    try:
        with _NEW_FILE:
            files.rename(fs.makeQualified(tmp), fs.makeQualified(final), flags)
        return True
    except Py4JJavaError:
        fs.delete(tmp, False)
        if fs.exists(final):
            return False
        raise


# Metadata calls per path are round trips to the storage service; a few run at
# once from the driver (py4j serves each Python thread on its own connection).
METADATA_THREADS = 16


def each(fn: Callable, items: Iterable) -> list:
    """``[fn(x) for x in items]`` with the calls issued concurrently."""
    items = list(items)
    if len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(METADATA_THREADS, len(items))) as pool:
        return list(pool.map(fn, items))
