"""Small files that must appear whole or not at all, on any file system Spark can reach.

A commit writes its text under a temporary name and renames it; the rename refuses a name that is taken. On HDFS and
local disks that is one atomic step. On object stores, where a rename is a copy, give the folder to a file system that
offers atomic renames, as Spark's own streaming checkpoints need.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.functions.names import logical_file_name


class Taken(Exception):
    """Another writer has committed under this name."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    if not exists(spark, folder):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, folder).listStatus(_path(spark, folder)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step; raises ``Taken`` if it is there already."""
    folder, _, name = path.rpartition("/")
    waiting = f"{folder}/.{name}-{uuid.uuid4().hex}"
    out = _system(spark, path).create(_path(spark, waiting), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(kind, 0)
    target = _path(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    qualified = lambda p: context.makeQualified(_path(spark, p))
    try:
        context.rename(qualified(waiting), qualified(path), none)
    except Py4JJavaError as error:
        _system(spark, path).delete(_path(spark, waiting), False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise Taken(path) from None
        raise


def listed_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """file_id, file_name, file_size, modified_at of every file below ``path`` that has a byte. Nothing of their content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path).select("path", "length", "modificationTime")
    return found.select(
        F.col("path").alias("file_id"),
        logical_file_name(F.col("path")).alias("file_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    )
