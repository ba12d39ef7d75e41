"""Names and pointers in shared folders, through Hadoop's FileSystem (any store that Spark reads).

Data always goes through Spark's readers and writers; these helpers list names, swap pointers and move finished
folders into place. A commit is one rename, which HDFS and local file systems do atomically.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path, configuration) of a path."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place, conf


def names(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """Names in a folder that fit a glob, sorted; none if the folder is missing."""
    fs, place, _ = _at(spark, f"{folder}/{pattern}")
    found = fs.globStatus(place)
    return sorted(f.getPath().getName() for f in found) if found else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, place, _ = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder or file that this package wrote; nothing happens if it is gone."""
    fs, place, _ = _at(spark, path)
    fs.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a finished folder into place; False if the target is there already."""
    fs, a, _ = _at(spark, source)
    _, b, _ = _at(spark, target)
    if fs.exists(b):
        return False
    fs.mkdirs(b.getParent())
    return bool(fs.rename(a, b))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is missing."""
    fs, place, _ = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one."""
    fs, place, conf = _at(spark, path)
    _, fresh, _ = _at(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    fs.mkdirs(place.getParent())
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), conf).rename(
        fs.makeQualified(fresh), fs.makeQualified(place), options)
