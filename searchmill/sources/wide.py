"""Wide exports in native formats: folders of Parquet or CSV files with dated columns."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchmill.functions.headers import Header, HeaderError, parse_header
from searchmill.schemas import DAY_TYPE, METRICS
from searchmill.sources.discover import PATTERNS
from searchmill.sources.heads import csv_columns, export_heads, file_heads
from searchmill.sources.storage import export_name, literal, require_folder

# Files (16 bytes each) that one CSV scan may have: their header numbers go to all tasks.
SCAN_FILES = 4_000_000

# Dates that a Parquet scan spans at most. More scans give the same rows.
SCAN_DATES = 200

RAW = "_raw"

LAYOUT_SCHEMA = T.StructType(
    [
        T.StructField("head", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("query_at", T.IntegerType()),
        T.StructField("page_at", T.IntegerType()),
        T.StructField(
            "layout",
            T.ArrayType(
                T.StructType(
                    [T.StructField("dt", T.DateType())]
                    + [T.StructField(m, T.IntegerType()) for m in METRICS]
                )
            ),
        ),
    ]
)


def read_wide_parquet(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> DataFrame:
    """Parquet exports under `folder` as one wide frame, with `source_file` and `row_no`.

    Columns merge by name: a date an export does not have is null there, which the
    positive-metric filter removes again. `names` limits the scan to those exports.
    """
    require_folder(spark, folder)
    rows = (
        spark.read.option("mergeSchema", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", PATTERNS["parquet"])
        .parquet(*_paths(folder, names))
    )
    return rows.select(
        export_name(spark, folder).alias("source_file"),
        F.struct("_metadata.file_name", "_metadata.row_index").alias("row_no"),
        *["`" + c.replace("`", "``") + "`" for c in rows.columns],
    )


class _Scan:
    """Parquet exports that merge to one frame without changing what any of them says."""

    def __init__(self):
        self.names: list[str] = []
        self.types: dict[str, str] = {}
        self.places: dict[tuple[dt.date, str], str] = {}

    def takes(self, types: dict[str, str], places: dict[tuple[dt.date, str], str]) -> bool:
        """Columns of one name have one type, and a date's metric one name."""
        dates = {d for d, _ in self.places} | {d for d, _ in places}
        return (
            len(dates) <= SCAN_DATES
            and all(self.types.get(c, t) == t for c, t in types.items())
            and all(self.places.get(at, c) == c for at, c in places.items())
        )

    def add(self, name, types, places) -> None:
        self.names.append(name)
        self.types.update(types)
        self.places.update(places)


def parquet_scans(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> list[DataFrame]:
    """The Parquet exports of a folder as wide frames, usually one.

    Each export's own header is checked and says which of its columns count. Exports share
    a scan if that keeps their meaning: same types, same column for a date's metric. Years of
    exports with a few weeks each would merge to thousands of columns that are almost all
    null, so a scan spans SCAN_DATES dates at most (a single export may have more).
    """
    exports: list[tuple[dt.date, str, dict, dict]] = []
    for name, heads in export_heads(file_heads(spark, folder, "parquet", names), "parquet").items():
        types: dict[str, str] = {}
        for head in heads:
            for column, kind in json.loads(head):
                if types.setdefault(column, kind) != kind:
                    raise HeaderError(f"{unquote(name)}: {column} has types {types[column]} and {kind}")
        header = parse_header(list(types), where=unquote(name))
        places = {(c.date, c.metric): c.name for c in header.columns}
        exports.append((header.dates[0], name, types, places))
    scans: list[_Scan] = []
    for _, name, types, places in sorted(exports, key=lambda e: e[:2]):
        scan = next((s for s in scans if s.takes(types, places)), None)
        if scan is None:
            scans.append(scan := _Scan())
        scan.add(name, types, places)
    # A scan has the columns that count only: another of the same date and metric would come first.
    return [
        read_wide_parquet(spark, folder, s.names).drop(
            *[c for c in s.types if c not in s.places.values() and _is_dated(c)]
        )
        for s in scans
    ]


def _is_dated(column: str) -> bool:
    return column[:1].isdigit()


def _paths(folder: str, names: list[str] | None) -> list[str]:
    if names is None:
        return [literal(folder)]
    return [literal(f"{folder.rstrip('/')}/{unquote(name)}") for name in names]


def read_wide_csv(
    spark: SparkSession,
    folder: str,
    names: list[str] | None = None,
    multi_line: bool = False,
    strict: bool = True,
) -> DataFrame:
    """CSV exports under `folder` as packed sheet rows: (source_file, row_no, query,
    page_path, days). `names` limits the scan to those exports.

    If not `strict`, the metrics of the days stay text, and a row that doesn't fit its header has
    a `reason` instead of failing the job.

    Quotes are doubled inside quoted fields. A row with more or fewer fields than its file's
    header fails the job, and so does a quoted line break, unless `multi_line` (which reads
    each file in one task) allows them.

    Spark applies one header to all files of a CSV scan, which would put values on wrong
    dates. So the scan is by position, and two small tables (file -> header, header ->
    layout) say what the positions mean: one scan, and a plan that does not grow with the
    number of headers.
    """
    require_folder(spark, folder)
    heads = file_heads(spark, folder, "csv", names)
    found = export_heads(heads, "csv")
    sizes = {r.source_file: r["count"] for r in heads.groupBy("source_file").count().collect()}
    batches: list[list[str]] = [[]]
    for name in sorted(found):
        if batches[-1] and sum(sizes[n] for n in batches[-1]) + sizes[name] > SCAN_FILES:
            batches.append([])
        batches[-1].append(name)
    scans = [_csv_scan(spark, folder, batch, heads, found, multi_line, strict) for batch in batches]
    return reduce(DataFrame.unionByName, scans)


def _csv_scan(spark, folder, names, heads, found, multi_line, strict) -> DataFrame:
    lines = {line: name for name in names for line in found[name]}
    columns_by_line = {line: csv_columns(line) for line in lines}
    # One column more than the widest header: every row is then short of one, which makes
    # Spark keep the row as it was, and longer rows are noticed.
    width = max(map(len, columns_by_line.values()), default=2) + 1
    cells = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, RAW]])
    if not names:
        rows = spark.createDataFrame([], schema).select(
            F.lit("").alias("source_file"), F.lit(0).alias("row_no"), F.lit("").alias("file_path"),
            F.array(*cells).alias("cells"), RAW,
        )
    else:
        rows = (
            spark.read.schema(schema)
            .option("header", "true")
            .option("enforceSchema", "true")
            .option("escape", '"')
            .option("columnNameOfCorruptRecord", RAW)
            .option("multiLine", str(multi_line).lower())
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", PATTERNS["csv"])
            .csv(_paths(folder, names))
            # Taken on the scan itself: the id orders the rows of one split, the block start
            # orders the splits of one file.
            .select(
                export_name(spark, folder).alias("source_file"),
                F.struct(
                    "_metadata.file_name",
                    "_metadata.file_block_start",
                    F.monotonically_increasing_id().alias("id"),
                ).alias("row_no"),
                "_metadata.file_path",
                F.array(*cells).alias("cells"),
                RAW,
            )
        )
    # Paths go by a 64-bit hash; equal ones would fail the load, not mix its rows.
    files = (
        heads.where(F.col("source_file").isin(names))
        .groupBy(F.xxhash64("file_path").alias("file_key"))
        .agg(
            F.when(F.count("*") == 1, F.first("head"))
            .otherwise(F.raise_error(F.lit("two paths with one hash")).cast("string"))
            .alias("head")
        )
    )
    # At most SCAN_FILES files and as many layouts as the scan has headers.
    rows = (
        rows.withColumn("file_key", F.xxhash64("file_path"))
        .join(F.broadcast(files), "file_key")
        .join(F.broadcast(_layouts(spark, lines, columns_by_line)), "head")
    )
    ids = [F.get("cells", "query_at").alias("query"), F.get("cells", "page_at").alias("page_path")]
    fits = F.coalesce(F.col("width") == _fields(F.col(RAW)), F.lit(False))
    if not strict:
        return rows.select(
            "source_file", "row_no", *ids, F.transform("layout", _text_day).alias("days"),
            F.when(~fits, _what_is_wrong()).alias("reason"),
        )
    wrong = F.raise_error(F.concat(_what_is_wrong(), F.lit(" of "), "file_path"))
    return rows.select(
        "source_file", "row_no", *ids,
        F.when(fits, F.transform("layout", _day))
        .otherwise(wrong.cast(T.ArrayType(DAY_TYPE)))
        .alias("days"),
    )


# A quoted field, which may hold commas and doubled quotes.
QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def _fields(raw: Column) -> Column:
    """Number of a CSV row's fields; null if a quoted field doesn't end in it, or without a row."""
    bare = F.regexp_replace(raw, QUOTED, "$1")
    # Most rows have no quotes, and a count of their commas is enough.
    return F.when(~raw.contains('"'), _commas(raw) + 1).when(~bare.rlike('(^|,)"'), _commas(bare) + 1)


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def _what_is_wrong() -> Column:
    bare = F.regexp_replace(F.col(RAW), QUOTED, "$1")
    return (
        F.when(bare.rlike('(^|,)"'), "quoted line break (see multi_line)")
        .when(_fields(F.col(RAW)) < F.col("width"), "row shorter than the header")
        .otherwise("row longer than the header")
    )


def _day(place: Column) -> Column:
    values = [F.get("cells", place[m]).cast("double").alias(m) for m in METRICS]
    return F.struct(place["dt"].alias("dt"), *values)


def _text_day(place: Column) -> Column:
    return F.struct(place["dt"].alias("dt"), *[F.get("cells", place[m]).alias(m) for m in METRICS])


def _layouts(
    spark: SparkSession, lines: dict[str, str], columns_by_line: dict[str, list[str]]
) -> DataFrame:
    """(head, width, query_at, page_at, layout): where a header's values are."""
    layouts = []
    for line, names in columns_by_line.items():
        header: Header = parse_header([n or None for n in names], where=unquote(lines[line]))
        layout = [
            (date, *[found[m].position if m in found else None for m in METRICS])
            for date, found in header.days()
        ]
        layouts.append((line, len(names), header.query, header.page_path, layout))
    return spark.createDataFrame(layouts, LAYOUT_SCHEMA)
