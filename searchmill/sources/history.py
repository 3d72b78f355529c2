"""Typed scan of the history CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from searchmill.operators.quarantine import check_history
from searchmill.schemas import HISTORY_SCHEMA, require_columns


ROW = "_row"


def read_history(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """History rows with their ids; columns are found by name, in any order.

    Quotes are doubled inside quoted fields. A missing column, a row with more or fewer fields
    than the header, a bad date or a bad number fails. Quoted line breaks need `multi_line`,
    which reads a file in one task.
    """
    rows = _reader(spark, multi_line).option("mode", "FAILFAST").csv(path)
    require_columns(rows, HISTORY_SCHEMA.names)
    # Strict casts (ANSI).
    return rows.select(
        *[
            (F.to_date(f.name, "yyyy-MM-dd") if f.name == "dt" else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in HISTORY_SCHEMA
        ]
    )


def read_checked_history(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """History rows as `check_history` gives them: what can't be read has a `reason`."""
    found = _reader(spark, multi_line).csv(path)
    require_columns(found, HISTORY_SCHEMA.names)
    schema = found.schema.add(ROW, "string")
    rows = _reader(spark, multi_line).option("columnNameOfCorruptRecord", ROW).schema(schema).csv(path)
    texts = [F.col(f.name).cast("string").alias(f.name) for f in HISTORY_SCHEMA]
    misfit = F.when(F.col(ROW).isNotNull(), "fields don't fit the header")
    name = F.col("_metadata.file_name")
    return check_history(rows.select(*texts, misfit.alias("reason"), name.alias("source_file")))


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", "true")
        .option("enforceSchema", "false")
        .option("escape", '"')
        .option("columnPruning", "false")  # so that the fields of each row are counted
        .option("multiLine", str(multi_line).lower())
    )
