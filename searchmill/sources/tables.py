"""Table scans in logical column order (the partition column is stored last)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from searchmill.schemas import CLEAN_COLUMNS, RAW_COLUMNS, Mart
from searchmill.sinks.switch import finish_switch


def current_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as its folders are now; a load that was interrupted at its end is finished first.

    A session keeps the file list of a table it has read, and loads run in other sessions
    too (a stream has its own), so the list is dropped first.
    """
    finish_switch(spark, name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_raw(spark: SparkSession, mart: Mart = Mart()) -> DataFrame:
    return current_table(spark, mart.raw).select(*RAW_COLUMNS)


def read_clean(spark: SparkSession, mart: Mart = Mart()) -> DataFrame:
    return current_table(spark, mart.clean).select(*CLEAN_COLUMNS)
