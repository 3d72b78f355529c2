"""The batch jobs: raw load, cleaned refresh, both, and the history seed."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill.operators.quarantine import bad_facts, good_facts, sheet_rows_to_checked
from searchmill.operators.report import quality_report
from searchmill.operators.reshape import (
    has_repeated_rows,
    rename_ids,
    sheet_rows_to_facts,
    wide_to_facts,
)
from searchmill.schemas import RAW_COLUMNS, Mart, create_layers, create_quarantine
from searchmill.sinks.archive import archive_exports, finish_moves
from searchmill.sinks.tables import WriteReport, refresh_clean, replace_by_date, seed_raw, set_aside
from searchmill.sources.discover import export_files, exports, warn_legacy_files
from searchmill.sources.heads import export_heads, file_heads
from searchmill.sources.history import read_checked_history, read_history
from searchmill.sources.spreadsheet import read_spreadsheets
from searchmill.sources.storage import delete_folder, new_folder
from searchmill.sources.tables import read_raw
from searchmill.sources.wide import parquet_scans, read_wide_csv

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadReport:
    """What a raw load did."""

    exports: int = 0
    write: WriteReport = field(default_factory=WriteReport)
    archived: list[str] = field(default_factory=list)


def export_facts(
    spark: SparkSession,
    folder: str,
    fmt: str = "xlsx",
    names: list[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Facts of the exports in a folder, or of those in `names`, with `source_file`.
    `multi_line` allows line breaks inside quoted CSV fields."""
    if fmt == "xlsx":
        return sheet_rows_to_facts(read_spreadsheets(spark, folder, names))
    if fmt == "csv":
        return sheet_rows_to_facts(read_wide_csv(spark, folder, names, multi_line))
    parts = []
    for wide in parquet_scans(spark, folder, names):
        # The columnar key check costs two columns; it usually saves shuffling all of them.
        unique = not has_repeated_rows(rename_ids(wide))
        parts.append(wide_to_facts(wide, unique_rows=unique))
    return reduce(DataFrame.unionByName, parts)


def load_exports(
    spark: SparkSession,
    folder: str,
    mart: Mart = Mart(),
    fmt: str = "xlsx",
    archive: str | None = None,
    multi_line: bool = False,
    quarantine: str | None = None,
) -> LoadReport:
    """Load every export of `folder` into the raw table, then move the files to `archive`.

    An empty folder, or exports without traffic, leave the table as it is. A history CSV in
    the folder is no export: it stays there. With the name of a `quarantine` table, rows and
    cells of CSV exports that can't be read go there, with a reason; else they fail the load.
    """
    if quarantine and fmt != "csv":
        raise ValueError("only CSV exports have cells to set aside, other formats are typed")
    if archive:
        finish_moves(spark, archive)  # of a run that loaded its exports but didn't move them all
    if fmt == "xlsx":
        warn_legacy_files(spark, folder)
    found = exports(export_files(spark, folder, fmt))
    if fmt == "csv":
        names = list(export_heads(file_heads(spark, folder, fmt), fmt))
        found = found.where(F.col("source_file").isin(names))
    else:
        names = [r.source_file for r in found.select("source_file").collect()]
    if not names:
        logger.warning("no %s exports in %s", fmt, folder)
        return LoadReport()
    if quarantine:
        written = _load_checked(spark, read_wide_csv(spark, folder, names, multi_line, strict=False), mart, found, names, quarantine)
    else:
        written = replace_by_date(
            export_facts(spark, folder, fmt, names, multi_line), mart, exports=found, unique_keys=True
        )
    if not written.dates:
        # As nothing was stored, the files stay where they are.
        logger.error("no rows with traffic in %s", folder)
        return LoadReport(len(names), written)
    moved = archive_exports(spark, folder, archive, names) if archive else []
    return LoadReport(len(names), written, moved)


def _load_checked(spark, rows, mart, found, names, quarantine) -> WriteReport:
    """Good rows to the raw table, bad ones to the quarantine; the exports are read once."""
    create_quarantine(spark, quarantine)
    folder = new_folder(spark, "checked-facts")
    try:
        sheet_rows_to_checked(rows).write.parquet(folder)
        checked = spark.read.parquet(folder)
        written = replace_by_date(good_facts(checked), mart, exports=found, unique_keys=True)
        return replace(written, rows_set_aside=set_aside(bad_facts(checked), quarantine, names))
    finally:
        delete_folder(spark, folder)


def run(
    spark: SparkSession,
    folder: str,
    mart: Mart = Mart(),
    fmt: str = "xlsx",
    archive: str | None = None,
    multi_line: bool = False,
) -> tuple[LoadReport, WriteReport]:
    """Raw load, then cleaned refresh; the refresh also runs when there was nothing to load."""
    create_layers(spark, mart)
    loaded = load_exports(spark, folder, mart, fmt, archive, multi_line)
    if loaded.write.dates:
        fresh = read_raw(spark, mart).where(F.col("dt").isin(loaded.write.dates))
        logger.info("%s", quality_report(fresh).first().asDict())
    refreshed = refresh_clean(spark, mart)
    logger.info("%s", describe(loaded, refreshed))
    return loaded, refreshed


def seed_history(
    spark: SparkSession,
    path: str,
    mart: Mart = Mart(),
    multi_line: bool = False,
    quarantine: str | None = None,
) -> WriteReport:
    """Fill the raw table from the history CSV, replacing all it holds. With the name of a
    `quarantine` table, rows that can't be read go there; else they fail the job."""
    create_layers(spark, mart)
    if not quarantine:
        return seed_raw(read_history(spark, path, multi_line), mart)
    create_quarantine(spark, quarantine, history=True)
    folder = new_folder(spark, "checked-history")
    try:
        read_checked_history(spark, path, multi_line).write.parquet(folder)
        checked = spark.read.parquet(folder)
        written = seed_raw(checked.where("reason IS NULL"), mart)
        bad = checked.where("reason IS NOT NULL").select(
            *[F.col(f"{c}_text").alias(c) for c in RAW_COLUMNS], "reason", "source_file"
        )
        return replace(written, rows_set_aside=set_aside(bad, quarantine))
    finally:
        delete_folder(spark, folder)


def describe(loaded: LoadReport, refreshed: WriteReport) -> str:
    dates: list[dt.date] = loaded.write.dates
    span = f"{dates[0]} to {dates[-1]}" if dates else "none"
    return (
        f"{loaded.exports} exports, {len(dates)} dates ({span}), "
        f"{loaded.write.rows_deleted} rows replaced by {loaded.write.rows_inserted}; "
        f"cleaned table: {refreshed.rows_inserted} rows"
    )
