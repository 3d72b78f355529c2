"""Folder access through Hadoop's file systems, so the same code serves local, HDFS and S3."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def hadoop_path(spark: SparkSession, path: str):
    """(file system, qualified path) of `path`."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(jpath)


def require_folder(spark: SparkSession, folder: str) -> None:
    fs, path = hadoop_path(spark, folder)
    if not fs.exists(path):
        raise FileNotFoundError(f"folder {folder} does not exist")


def literal(path: str) -> str:
    """`path` for a Spark reader, which takes paths as patterns: special characters escaped."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a (possibly compressed) text file, without reading the rest."""
    jvm = spark._jvm
    fs, jpath = hadoop_path(spark, path)
    factory = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()
    )
    codec = factory.getCodec(jpath)
    stream = fs.open(jpath)
    try:
        data = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def move_file(spark: SparkSession, source: str, target: str) -> None:
    fs, old = hadoop_path(spark, source)
    _, new = hadoop_path(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; False if it is."""
    fs, new = hadoop_path(spark, path)
    fs.mkdirs(new.getParent())
    try:
        stream = fs.create(new, False)
    except Py4JJavaError as error:
        if fs.exists(new):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time, where the file system can."""
    fs, file = hadoop_path(spark, path)
    fs.setTimes(file, millis, -1)


def exists(spark: SparkSession, path: str) -> bool:
    fs, file = hadoop_path(spark, path)
    return fs.exists(file)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; none if it isn't there."""
    fs, path = hadoop_path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = hadoop_path(spark, folder)
    fs.delete(path, True)


def delete_if_empty(spark: SparkSession, folder: str) -> None:
    fs, path = hadoop_path(spark, folder)
    try:
        fs.delete(path, False)
    except Py4JJavaError:  # something is in it
        pass


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for intermediate tables, in the cluster's shared checkpoint folder.

    Only where `spark.checkpoint.dir` is unset (a local session, as in tests) is a folder
    of this machine used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="searchmill-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def export_name(spark: SparkSession, folder: str) -> Column:
    """Name of the export a scanned row belongs to: the entry directly under `folder`.

    An export is one file, or one folder of part files written by Spark. Names keep the
    URI escapes of `_metadata.file_path`.
    """
    _, path = hadoop_path(spark, folder)
    root = path.toUri().toString().rstrip("/") + "/"
    # Local files are reported as file:/a or file:///a.
    roots = {root, root.replace("file:///", "file:/")}
    file_path = F.col("_metadata.file_path")
    name = F.raise_error(F.concat(file_path, F.lit(f" is not under {root}"))).cast("string")
    for known in roots:
        below = F.substr(file_path, F.lit(len(known) + 1))
        name = F.when(file_path.startswith(known), F.substring_index(below, "/", 1)).otherwise(name)
    return name
