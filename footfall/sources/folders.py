"""Folders as Spark sees them, on any storage it can reach. Names only, no file is opened."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def subfolders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root``, sorted; none if it does not exist."""
    fs, path = _hadoop(spark, root)
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _hadoop(spark, path)
    return fs.exists(found)


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _hadoop(spark, folder)
    fs.mkdirs(path)


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        fs, path = _hadoop(spark, folder)
        fs.delete(path, True)


def move_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Rename; ``target`` must not exist, folders above it may be missing."""
    fs, path = _hadoop(spark, folder)
    _, to = _hadoop(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(path, to):
        raise OSError(f"cannot rename {folder} to {target}")


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Give a small file new content by one rename: readers see the old or the new."""
    jvm = spark.sparkContext._jvm
    fs, target = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    _, fresh = _hadoop(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is none."""
    fs, found = _hadoop(spark, path)
    if not fs.exists(found):
        return None
    stream = fs.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_only_file(spark: SparkSession, folder: str, target: str) -> None:
    """Give the one data file in ``folder`` another name, in the place of what had it."""
    fs, path = _hadoop(spark, folder)
    _, to = _hadoop(spark, target)
    (only,) = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")]
    fs.mkdirs(to.getParent())
    fs.delete(to, False)
    fs.rename(only, to)


def temporary_folder(spark: SparkSession, folder: str) -> None:
    """Make a folder that goes when the driver ends."""
    fs, path = _hadoop(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)


def literal(path: str) -> str:
    """A path whose characters all stand for themselves where Spark expects a pattern."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)
