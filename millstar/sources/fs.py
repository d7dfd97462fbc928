"""File-system listing through the session's Hadoop configuration.

Only directory metadata is touched (``listStatus``, ``exists``); no data file is
opened.  Works for any Hadoop-compatible URI (local, HDFS, object stores) the
cluster is configured for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _fs_and_path(spark, uri)
    return bool(fs.exists(path))


def list_dirs(spark: SparkSession, uri: str) -> list[str]:
    """Names of the direct sub-directories of ``uri`` ([] when it is missing)."""
    fs, path = _fs_and_path(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory())


def has_file(spark: SparkSession, uri: str, suffix: str, recursive: bool = True) -> bool:
    """Whether any (non-hidden) file under ``uri`` ends with ``suffix``; stops at the first."""
    fs, path = _fs_and_path(spark, uri)
    if not fs.exists(path):
        return False
    it = fs.listFiles(path, recursive)
    while it.hasNext():
        p = it.next().getPath()
        name = p.getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            # Skip files inside hidden folders (e.g. an uncommitted _temporary).
            rel = p.toUri().getPath()[len(path.toUri().getPath()):]
            if not any(part.startswith(("_", ".")) for part in rel.split("/")[:-1] if part):
                return True
    return False


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths matching a Hadoop glob ``pattern`` (one listing call; [] when none)."""
    fs, path = _fs_and_path(spark, pattern)
    found = fs.globStatus(path)
    if found is None:
        return []
    return sorted(st.getPath().toString() for st in found)


def delete(spark: SparkSession, uri: str, recursive: bool = True) -> bool:
    """Remove a path the library itself created (e.g. a staging copy)."""
    fs, path = _fs_and_path(spark, uri)
    return bool(fs.delete(path, recursive))


def create_empty(spark: SparkSession, uri: str) -> None:
    """An empty marker file, parents included."""
    fs, path = _fs_and_path(spark, uri)
    fs.create(path, True).close()


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small text file that appears whole: written beside its place, then moved there."""
    fs, path = _fs_and_path(spark, uri)
    _, beside = _fs_and_path(spark, f"{uri.rpartition('/')[0]}/_writing-{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, path):  # most file systems do not rename onto a file
        fs.delete(path, False)
        if not fs.rename(beside, path):
            raise OSError(f"could not write {uri}")


def read_text(spark: SparkSession, uri: str) -> str | None:
    """A small text file, or None when there is none."""
    fs, path = _fs_and_path(spark, uri)
    if not fs.exists(path):
        return None
    data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(fs.open(path))
    return bytes(data).decode()
