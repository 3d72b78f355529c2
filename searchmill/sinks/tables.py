"""Writes to the two layers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from searchmill.operators.keys import highest_id, number_staged, number_table, stage_ordered
from searchmill.operators.merge import keep_winners, latest_export_per_date
from searchmill.operators.quality import clean_facts
from searchmill.schemas import CLEAN_COLUMNS, FACT_COLUMNS, RAW_COLUMNS, Mart, require_columns
from searchmill.sinks.switch import begin_load, dates_of, switch, write_dates
from searchmill.sources.storage import delete_folder, new_folder
from searchmill.sources.tables import current_table


@dataclass(frozen=True)
class WriteReport:
    """What a write did. `rows_staged` counts rows before later exports replaced them."""

    rows_staged: int = 0
    rows_deleted: int = 0
    rows_inserted: int = 0
    rows_set_aside: int = 0
    dates: list[dt.date] = field(default_factory=list)


def replace_by_date(
    facts: DataFrame,
    mart: Mart = Mart(),
    exports: DataFrame | None = None,
    unique_keys: bool = False,
) -> WriteReport:
    """Replace every date present in `facts`; other dates of the raw table stay.

    With `exports` (source_file, mtime) and a `source_file` column, the latest export wins
    each date. New ids continue after the highest id among the rows that stay. Running it
    again gives the same table, ids included. Without rows the table is not touched.
    """
    return _load(facts, mart, exports, unique_keys, replace=True)


def append_facts(facts: DataFrame, mart: Mart = Mart()) -> WriteReport:
    """Add rows to the raw table; an `id` column is dropped, ids continue after the highest."""
    return _load(facts, mart, None, False, replace=False)


def _load(facts, mart, exports, unique_keys, replace) -> WriteReport:
    require_columns(facts)
    by_export = exports is not None
    facts = facts.select(*FACT_COLUMNS, *(["source_file"] if by_export else []))
    spark = facts.sparkSession
    state = begin_load(spark, mart.raw)
    folder = new_folder(spark, "staged-facts")
    try:
        staged = stage_ordered(facts, folder, unique_keys)
        counts = staged.counts
        if by_export:
            winners = latest_export_per_date(counts, exports)
            # Written down, because the dates, the numbers and the ids all come from the
            # remaining counts.
            keep_winners(counts, winners).write.parquet(f"{folder}/won")
            counts = spark.read.parquet(f"{folder}/won")
        per_date = counts.groupBy("dt").agg(F.sum("n").alias("n"), F.count("n").alias("size"))
        found = per_date.collect()
        if not found:
            return WriteReport()
        if any(r.dt is None for r in found):
            raise ValueError("dt must not be null")
        dates = sorted(r.dt for r in found)
        table, deleted = spark.table(mart.raw), 0
        goes = F.col("dt").isin(dates) if replace else F.lit(False)
        # Both counts come from the file footers.
        there = table.agg(F.count_if(goes).alias("gone"), F.count_if(~goes).alias("stays")).first()
        if replace:
            deleted, table = there.gone, table.where(~goes)
        numbered = number_staged(
            staged.rows, counts, base=highest_id(table, there.stays), size=sum(r.size for r in found)
        )
        if replace:
            name, _, _ = write_dates(numbered, state, RAW_COLUMNS)
            switch(spark, mart.raw, state, name, dates)
        else:
            _insert(numbered, mart.raw, RAW_COLUMNS)
        return WriteReport(staged.size, deleted, sum(r.n for r in found), dates=dates)
    finally:
        delete_folder(spark, folder)


def refresh_clean(spark: SparkSession, mart: Mart = Mart()) -> WriteReport:
    """Rebuild the cleaned table from the raw one, with ids from 1.

    Rules, numbering and write are one map-side pass over the raw files. A failure leaves the
    table as it was.
    """
    raw = current_table(spark, mart.raw)
    return _replace_all(clean_facts(number_table(raw)), mart.clean, CLEAN_COLUMNS)


def seed_raw(history: DataFrame, mart: Mart = Mart()) -> WriteReport:
    """Replace the whole raw table by `history`, keeping its ids. A failure leaves it as it was."""
    require_columns(history, RAW_COLUMNS)
    # Rebalancing by date gives whole files per date and lets AQE split a hot date.
    return _replace_all(history.hint("rebalance", "dt"), mart.raw, RAW_COLUMNS)


def delete_by_dates(spark: SparkSession, dates: list[dt.date], mart: Mart = Mart()) -> int:
    """Remove whole dates from the raw table, all or none of them; the number of removed rows."""
    if not dates:
        return 0
    state = begin_load(spark, mart.raw)
    deleted = spark.table(mart.raw).where(F.col("dt").isin(dates)).count()
    switch(spark, mart.raw, state, "", [], gone=dates)
    return deleted


def _replace_all(rows: DataFrame, table: str, columns: list[str]) -> WriteReport:
    """Make `rows` the whole table, in one step; dates that are no longer there go."""
    spark = rows.sparkSession
    state = begin_load(spark, table)
    name, dates, counts = write_dates(rows, state, columns)
    switch(spark, table, state, name, dates, gone=[d for d in dates_of(spark, table) if d not in set(dates)])
    return WriteReport(rows_inserted=counts["rows"], dates=dates)


def _insert(rows: DataFrame, table: str, columns: list[str]) -> None:
    """Append by position, with the partition column last."""
    ordered = rows.select(*[c for c in columns if c != "dt"], "dt")
    rows.sparkSession.sql(f"INSERT INTO {table} SELECT * FROM {{rows}}", rows=ordered)


def set_aside(bad: DataFrame, table: str, names: list[str] | None = None) -> int:
    """Make `bad` the rows that the quarantine table has of these files (of all, without `names`);
    their number."""
    spark = bad.sparkSession
    known = {unquote(r["partition"].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    old = sorted(known if names is None else known & set(names))
    if old:
        parts = ", ".join("PARTITION (source_file = '" + n.replace("'", "\\'") + "')" for n in old)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    seen = Observation()
    rows = bad.observe(seen, F.count(F.lit(1)).alias("rows")).select(spark.table(table).columns)
    spark.sql(f"INSERT INTO {table} SELECT * FROM {{rows}}", rows=rows)
    return seen.get["rows"]
