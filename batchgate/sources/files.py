"""Small file-system steps over Hadoop's FileSystem: listing, head probes, atomic create."""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession


class FileInfo(NamedTuple):
    path: str
    size: int
    modified: int


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    if not exists(spark, folder):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, folder).listStatus(_path(spark, folder)))


def list_data_files(spark: SparkSession, path: str) -> list[FileInfo]:
    """The file itself, or the part files of a folder written by a job; empty if absent."""
    fs, hadoop_path = _fs(spark, path), _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = [
        FileInfo(plain(s.getPath().toString()), s.getLen(), s.getModificationTime())
        for s in fs.listStatus(hadoop_path)
        if s.isFile() and not s.getPath().getName().startswith(("_", "."))
    ]
    return sorted(found)


def read_head(spark: SparkSession, path: str, limit: int) -> bytes:
    """At most ``limit`` first bytes."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readNBytes(limit))
    finally:
        stream.close()


def read_all(spark: SparkSession, path: str) -> bytes:
    """A whole small file: commit records and the like."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file, or a folder of part files, byte for byte; the target is replaced."""
    delete_tree(spark, target)
    _fs(spark, target).mkdirs(_path(spark, target).getParent())
    copied = spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        _fs(spark, source), _path(spark, source), _fs(spark, target), _path(spark, target),
        False, spark._jsc.hadoopConfiguration())
    if not copied:
        raise OSError(f"{source} was not copied")


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the listing spells it, with scheme and without escapes."""
    return plain(_fs(spark, path).makeQualified(_path(spark, path)).toString())


def plain(path: str) -> str:
    """Local paths have one spelling: ``file:/``."""
    return re.sub(r"\Afile:/+", "file:/", path)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with all of ``text`` or fail; an existing file is never replaced.

    The content is finished under a hidden name first and then renamed (linked on local disks),
    so a reader sees the whole file or none, and of two writers one gets the name.
    """
    jvm = spark._jvm
    target = _path(spark, path)
    fs = _fs(spark, path)
    fs.mkdirs(target.getParent())
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    whole, there = fs.makeQualified(hidden), fs.makeQualified(target)
    try:
        if there.toUri().getScheme() == "file":
            # Local renames look for the target first and then replace it; a link is one step.
            nio = jvm.java.nio.file
            parts = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
            at = [nio.Path.of(p.toUri().getPath(), parts) for p in (there, whole)]
            nio.Files.createLink(*at)
            fs.delete(hidden, False)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                there.toUri(), spark._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(
                jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(whole, there, none)
    except Exception:
        fs.delete(hidden, False)
        raise


def delete_tree(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def replace_tree(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to the place of another one."""
    delete_tree(spark, target)
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"{source} was not moved")
