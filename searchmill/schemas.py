"""Names, types and table definitions of the search-analytics data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names of the export sheet and what they are called afterwards.
SHEET_IDS = {"Query": "query", "Url": "page_path"}
SHEET_METRICS = {
    "demand": "demand",
    "shows": "impressions",
    "position": "position",
    "clicks": "clicks",
}

# Column order of the facts, of the raw table and of the cleaned table.
FACT_COLUMNS = ["dt", "query", "page_path", "demand", "impressions", "position", "clicks"]
RAW_COLUMNS = ["id", "dt", "page_path", "query", "demand", "impressions", "position", "clicks"]
CLEAN_COLUMNS = ["id", "dt", "query", "page_path", "demand", "impressions", "position", "clicks"]
METRICS = ["demand", "impressions", "position", "clicks"]
COUNT_METRICS = ["demand", "impressions", "clicks"]

# Ids are BIGINT: 100 TB of facts holds far more rows than an INT can number.
SQL_TYPES = {
    "id": "BIGINT",
    "dt": "DATE",
    "page_path": "STRING",
    "query": "STRING",
    "demand": "INT",
    "impressions": "INT",
    "position": "DOUBLE",
    "clicks": "INT",
}

NEVER_NULL = ("id", "dt")

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("dt", T.DateType()),
        T.StructField("page_path", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("demand", T.IntegerType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("position", T.DoubleType()),
        T.StructField("clicks", T.IntegerType()),
    ]
)

DAY_TYPE = T.StructType(
    [T.StructField("dt", T.DateType())] + [T.StructField(m, T.DoubleType()) for m in METRICS]
)

# One row per sheet row whatever its header: the dated columns are packed in `days`.
SHEET_ROW_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("page_path", T.StringType()),
        T.StructField("days", T.ArrayType(DAY_TYPE)),
    ]
)


@dataclass(frozen=True)
class Mart:
    """Catalog names of the two layers."""

    raw: str = "rdl.webm_excel"
    clean: str = "ppl.webmaster_aggregated"


def create_layers(spark: SparkSession, mart: Mart = Mart(), location: str | None = None) -> None:
    """Create both databases and both tables where they do not exist yet.

    Both tables are partitioned by date: a reload then replaces whole partitions, and
    date filters prune. `location` puts the databases under a folder other than the
    session's warehouse.
    """
    for table, columns in ((mart.raw, RAW_COLUMNS), (mart.clean, CLEAN_COLUMNS)):
        database = table.split(".")[0]
        place = f" LOCATION '{location.rstrip('/')}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        fields = ", ".join(
            f"{c} {SQL_TYPES[c]}" + (" NOT NULL" if c in NEVER_NULL else "") for c in columns
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet PARTITIONED BY (dt)"
        )


def create_quarantine(spark: SparkSession, table: str, history: bool = False) -> None:
    """Create a table for rows that can't be read, where it does not exist yet: all as text, with the
    reason, partitioned by the file they are from."""
    columns = RAW_COLUMNS if history else FACT_COLUMNS
    fields = ", ".join(f"{c} STRING" for c in [*columns, "reason", "source_file"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet PARTITIONED BY (source_file)")


def require_columns(df: DataFrame, columns: list[str] | None = None) -> None:
    """Raise a ValueError that names the fact columns missing from `df`."""
    missing = [c for c in (columns or FACT_COLUMNS) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
