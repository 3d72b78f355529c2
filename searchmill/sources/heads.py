"""The headers of CSV and Parquet exports, read in tasks: a line or a footer of each file."""

from __future__ import annotations

import csv
import json
import logging
import sys
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill.schemas import RAW_COLUMNS
from searchmill.sources.discover import export_files
from searchmill.sources.storage import first_line, literal

logger = logging.getLogger(__name__)

# File systems that tasks open themselves; for others the driver asks Hadoop, file by file.
TASK_SCHEMES = ("file", "hdfs")
DRIVER_READERS = 16
FILES_PER_TASK = 64

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_heads(
    spark: SparkSession, folder: str, fmt: str, names: list[str] | None = None
) -> DataFrame:
    """(source_file, file_path, mtime, length, head) of the files of CSV or Parquet exports.

    `head` is a CSV file's first line, or a Parquet file's columns as JSON. Empty CSV files
    are left out.
    """
    files = export_files(spark, folder, fmt).drop("path").where("length > 0")
    if names is not None:
        files = files.where(F.col("source_file").isin(names))
    schemes = files.select(F.substring_index("file_path", ":", 1).alias("s")).distinct().collect()
    if all(r.s in TASK_SCHEMES for r in schemes):
        n_files = files.count()
        spread = files.repartition(max(1, -(-n_files // FILES_PER_TASK)), "file_path")
        return spread.mapInArrow(
            _add_heads(fmt),
            "source_file string, file_path string, mtime timestamp, length long, head string",
        )
    rows = files.collect()

    def head(path: str) -> str:
        if fmt == "csv":
            return first_line(spark, unquote(path)) or ""
        schema = spark.read.parquet(literal(unquote(path))).schema
        return json.dumps([[f.name, f.dataType.simpleString()] for f in schema])

    with ThreadPoolExecutor(DRIVER_READERS) as pool:
        found = list(pool.map(lambda r: head(r.file_path), rows))
    return spark.createDataFrame(
        [(*r, h) for r, h in zip(rows, found, strict=True)], files.schema.add("head", "string")
    )


def _add_heads(fmt: str):
    def run(batches):
        for batch in batches:
            heads = [_head(path, fmt) for path in batch.column("file_path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.string())], [*batch.schema.names, "head"]
            )

    return run


def _head(uri: str, fmt: str) -> str:
    from pyarrow import fs, parquet

    system, path = fs.FileSystem.from_uri(uri)
    if fmt == "parquet":
        with system.open_input_file(path) as file:
            return json.dumps([[f.name, str(f.type)] for f in parquet.read_schema(file)])
    with system.open_input_stream(path, compression="detect") as stream:
        line = b""
        while b"\n" not in line:
            more = stream.read(1 << 16)
            if not more:
                break
            line += more
    return line.split(b"\n")[0].rstrip(b"\r").decode("utf-8-sig")


def csv_columns(head: str) -> list[str]:
    return next(csv.reader([head.lstrip("\ufeff")]), [])


def is_history(head: str) -> bool:
    """The seed file lies among the exports; it is told by its header."""
    return set(csv_columns(head)) == set(RAW_COLUMNS)


def export_heads(heads: DataFrame, fmt: str) -> dict[str, list[str]]:
    """The different heads of each export, by name; history files are left out and logged.

    One row per export and head comes to the driver, as its dates decide the plan.
    """
    found: dict[str, list[str]] = {}
    for row in heads.select("source_file", "head").distinct().orderBy("source_file", "head").collect():
        if fmt == "csv" and is_history(row.head):
            logger.info("%s is a history file, not an export", row.source_file)
        else:
            found.setdefault(row.source_file, []).append(row.head)
    return found
