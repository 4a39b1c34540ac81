"""File-system questions, answered by Hadoop so that every scheme Spark reads works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _target(spark, path)
    return files.exists(target)


def is_file(spark: SparkSession, path: str) -> bool:
    files, target = _target(spark, path)
    return files.exists(target) and files.getFileStatus(target).isFile()


def remove(spark: SparkSession, path: str) -> None:
    files, target = _target(spark, path)
    files.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _target(spark, path)
    files.mkdirs(target)


def listed(spark: SparkSession, folder: str) -> dict[str, float]:
    """What lies directly in a folder: names with the seconds since 1970 of their last change."""
    files, target = _target(spark, folder)
    if not files.exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000.0 for s in files.listStatus(target)}


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _target(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, text: str, path: str) -> bool:
    """A small file that is there as a whole or not at all, written only if no one else has; tells
    whether it was. Of several writers the file system's rename lets one win."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    files, target = _target(spark, draft)
    stream = files.create(target, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(target), files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), no_options)
    except Py4JJavaError as error:
        files.delete(target, False)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def move(spark: SparkSession, path: str, target: str) -> None:
    files, source = _target(spark, path)
    if not files.rename(source, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {path} to {target}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and without relative parts, as Spark itself would name it."""
    files, target = _target(spark, path)
    return files.makeQualified(target).toString()


def leaf_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of the data files at any depth, as Spark lists them.

    Files that a data source would skip (hidden ones) are not listed; no content is read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length", "modificationTime")


def content_state(spark: SparkSession, path: str) -> str | None:
    """A digest of the leaf files' places, sizes and times, or None where there is no path.

    The files are reduced to three sums, whatever their number or order.
    """
    if not exists(spark, path):
        return None
    file = F.sha2(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")), 256)
    number = lambda start: F.conv(F.substring(file, start, 15), 16, 10).cast("decimal(20,0)")
    row = leaf_files(spark, path).agg(F.count("*"), F.sum("length"), F.sum(number(1)), F.sum(number(16))).head()
    return ":".join(str(value or 0) for value in row)
