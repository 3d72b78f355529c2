"""Which exports lie in a folder."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill.sources.storage import export_name, literal, require_folder

logger = logging.getLogger(__name__)

# What a folder is searched for, per format. An export that is a folder of part
# files is named like a file.
PATTERNS = {
    "xlsx": "*.xlsx",
    "csv": "{*.csv,*.csv.gz,*.csv.bz2,*.csv.zst}",
    "parquet": "*.parquet",
}
NAMES = {"xlsx": r"\.xlsx?$", "csv": r"\.csv(\.(gz|bz2|zst))?$", "parquet": r"\.parquet$"}


def export_files(
    spark: SparkSession, folder: str, fmt: str = "xlsx", pattern: str | None = None
) -> DataFrame:
    """The export files of a folder: (source_file, path, file_path, mtime, length).

    The folder itself is listed, not its subfolders, except that CSV and Parquet exports
    may be folders of part files, if they are named like an export: `week.csv.bak`, `old/` and
    an archive inside the folder are no exports. Spark lists in parallel and, as `content` is
    not selected, opens no file. A missing folder raises; an empty one gives no rows.
    """
    if fmt not in PATTERNS:
        raise ValueError(f"unknown export format {fmt!r}, expected one of {sorted(PATTERNS)}")
    require_folder(spark, folder)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern or PATTERNS[fmt])
        .option("recursiveFileLookup", str(fmt != "xlsx").lower())
        .load(literal(folder))
        # "~$name.xlsx" is the lock file of an open spreadsheet.
        .where(~F.col("_metadata.file_name").startswith("~$"))
        .select(
            export_name(spark, folder).alias("source_file"),
            "path",
            "_metadata.file_path",
            F.col("modificationTime").alias("mtime"),
            "length",
        )
        .where(F.col("source_file").rlike(NAMES[fmt]))
    )


def exports(files: DataFrame) -> DataFrame:
    """One row per export: (source_file, mtime, length, files)."""
    return files.groupBy("source_file").agg(
        F.max("mtime").alias("mtime"),
        F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("files"),
    )


def warn_legacy_files(spark: SparkSession, folder: str) -> list[str]:
    """Old binary `.xls` files cannot be read; they are named in the log and left alone."""
    rows = export_files(spark, folder, "xlsx", pattern="*.xls").select("source_file").collect()
    names = sorted(r.source_file for r in rows)
    if names:
        logger.warning("ignoring .xls files, save them as .xlsx: %s", names)
    return names
