"""Counts that describe a frame in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_report(facts: DataFrame) -> DataFrame:
    """One row: rows read, rows with traffic, and the rows each cleaning rule changes."""

    def rows_where(condition: Column) -> Column:
        return F.count_if(condition)

    return facts.agg(
        F.count(F.lit(1)).alias("rows_read"),
        rows_where((F.col("demand") > 0) | (F.col("impressions") > 0) | (F.col("clicks") > 0)).alias(
            "rows_kept"
        ),
        rows_where(F.col("page_path").contains("?")).alias("urls_cut"),
        rows_where(F.col("demand") < F.col("impressions")).alias("demand_raised"),
        rows_where(F.col("clicks") > F.col("impressions")).alias("clicks_capped"),
        F.min("dt").alias("first_date"),
        F.max("dt").alias("last_date"),
    )
