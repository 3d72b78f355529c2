"""From wide exports to daily facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchmill.functions.columns import any_positive, header_date, header_metric
from searchmill.functions.headers import Header, parse_header
from searchmill.schemas import (
    COUNT_METRICS,
    FACT_COLUMNS,
    METRICS,
    SHEET_IDS,
    SHEET_METRICS,
)

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

# Technical columns a scan may add to the sheet's own columns.
SCAN_COLUMNS = ("source_file", "mtime", "row_no")


def sheet_header(wide: DataFrame) -> Header:
    return parse_header(wide.columns, skip=SCAN_COLUMNS)


def rename_ids(wide: DataFrame) -> DataFrame:
    return wide.withColumnsRenamed(SHEET_IDS)


def with_row_no(wide: DataFrame) -> DataFrame:
    """Number the rows of a frame that does not come from one of our scans."""
    if "row_no" in wide.columns:
        return wide
    return wide.withColumn("row_no", F.monotonically_increasing_id())


def unpivot_cells(wide: DataFrame) -> DataFrame:
    """One row per sheet row and dated column: (..., date_metric, value).

    Metrics are read as double, so integer and text columns unpivot together.
    """
    header = sheet_header(wide)
    wide = with_row_no(rename_ids(wide))
    ids = [c for c in SCAN_COLUMNS if c in wide.columns] + list(SHEET_IDS.values())
    names = [c.name for c in header.columns]
    typed = wide.selectExpr(*ids, *[f"CAST({_quoted(n)} AS double) AS {_quoted(n)}" for n in names])
    return typed.unpivot(ids, names, "date_metric", "value")


def split_header(cells: DataFrame) -> DataFrame:
    """Replace `date_metric` by its two parts, `date` (text) and `metric`."""
    return cells.withColumns(
        {
            "date": header_date(F.col("date_metric")),
            "metric": header_metric(F.col("date_metric")),
        }
    ).drop("date_metric")


def pivot_first(cells: DataFrame) -> DataFrame:
    """Back to one row per date, page and query, with one column per metric.

    Where a sheet repeats a page and query, its first row counts, nulls included. The
    order comes from `row_no`; a plain `first` would depend on task timing. Each metric is
    one (value, row_no) buffer, so rows combine in the map tasks and a plan of one
    exchange results, however frequent a key is and whatever the dates are.
    """
    keys = ["date", "page_path", "query"]
    if "source_file" in cells.columns:
        keys.insert(0, "source_file")
    return cells.groupBy(*keys).agg(
        *[
            F.expr(f"min_by(value, row_no) FILTER (WHERE metric = '{sheet}')").alias(column)
            for sheet, column in SHEET_METRICS.items()
        ]
    )


def type_facts(rows: DataFrame) -> DataFrame:
    """Null metrics become 0 and every column gets its final type.

    Casts are strict (ANSI): a bad date or a count beyond INT fails the job.
    """
    if "dt" not in rows.columns:
        rows = rows.withColumn("dt", F.to_date("date", "yyyy-MM-dd"))
    out: dict[str, Column] = {"dt": F.col("dt"), "query": F.col("query")}
    out["page_path"] = F.col("page_path")
    for metric in METRICS:
        kind = "int" if metric in COUNT_METRICS else "double"
        out[metric] = F.coalesce(F.col(metric).cast(kind), F.lit(0).cast(kind))
    extra = ["source_file"] if "source_file" in rows.columns else []
    return rows.select(*extra, *[out[c].alias(c) for c in FACT_COLUMNS])


def keep_positive(facts: DataFrame) -> DataFrame:
    return facts.where(any_positive(*[F.col(m) for m in COUNT_METRICS]))


def first_rows(rows: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Where one export repeats a query and page (and `extra` columns), keep its first row.

    Every sheet row has a cell in every dated column of its sheet, so the first value per
    date and metric is always the one of the first row: choosing whole rows *before* they
    are spread over dates shuffles each row once instead of once per date. Spark limits
    each group to one row in the map tasks before the shuffle, so a frequent key is small.
    """
    # The query leads, as it tells rows apart early in the sort; exports repeat their name.
    keys = ["query", "page_path"] + [c for c in ("source_file",) if c in rows.columns] + (extra or [])
    order = Window.partitionBy(*keys).orderBy("row_no")
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def has_repeated_rows(rows: DataFrame) -> bool:
    """Whether an export repeats a query and page.

    Reads the key columns only and shuffles 12 bytes of hashes per row. Equal keys always
    have equal hashes, so False is certain; a rare collision only costs the slower path.
    """
    keys = [c for c in ("source_file",) if c in rows.columns] + ["query", "page_path"]
    hashed = rows.groupBy(F.xxhash64(*keys).alias("a"), F.hash(*keys).alias("b"))
    return not hashed.count().where("count > 1").isEmpty()


def wide_to_facts(wide: DataFrame, unique_rows: bool = False) -> DataFrame:
    """Facts of a wide frame with `Query`, `Url` and `<date>_<metric>` columns.

    One generator spreads the dates, instead of an unpivot to four rows per date followed by a
    pivot. Where all columns are numbers, only the days that can have traffic become structs and
    are spread; most days of a query are empty. Text cells are all cast, so that a bad
    number fails the job wherever it is. `unique_rows` skips `first_rows` and with it the only
    shuffle.
    """
    header = sheet_header(wide)
    rows = rename_ids(with_row_no(wide))
    if not unique_rows:
        rows = first_rows(rows)
    kinds = dict(rows.dtypes)
    numbers = all(kinds[c.name].partition("(")[0] in NUMBERS for c in header.columns)
    # As text: a wide sheet has thousands of cells, and one parse beats as many calls.
    days = []
    for date, columns in header.days():
        cells = {
            m: f"CAST({_quoted(columns[m].name) if m in columns else 'NULL'} AS double)" for m in METRICS
        }
        if numbers:
            carries = " OR ".join(f"abs({cells[m]}) >= 1" for m in COUNT_METRICS)
            fields = ", ".join(f"'{m}', {cell}" for m, cell in cells.items())
            days.append(f"CASE WHEN {carries} THEN named_struct('dt', DATE '{date}', {fields}) END")
        else:
            days.append(f"DATE '{date}', {', '.join(cells.values())}")
    ids = [c for c in ("source_file", "query", "page_path") if c in rows.columns]
    if numbers:
        spread = f"inline(array_compact(array({', '.join(days)})))"
    else:
        spread = f"stack({len(days)}, {', '.join(days)}) AS (dt, {', '.join(METRICS)})"
    return keep_positive(type_facts(rows.selectExpr(*ids, spread)))


def sheet_rows_to_facts(rows: DataFrame) -> DataFrame:
    """Facts of packed sheet rows (`days` arrays), as the spreadsheet and CSV scans give.

    Days without traffic are dropped from the arrays before the shuffle: rows whose counts
    all truncate to 0 cannot survive the positive-metric filter.
    """
    carries = lambda x: F.abs(x) >= 1
    packed = rows.withColumn(
        "days",
        F.filter(
            "days",
            lambda d: carries(d["demand"]) | carries(d["impressions"]) | carries(d["clicks"]),
        ),
    )
    ids = [c for c in ("source_file", "query", "page_path") if c in rows.columns]
    return keep_positive(type_facts(first_rows(packed).select(*ids, F.inline("days"))))


def sheet_rows_to_cells(rows: DataFrame) -> DataFrame:
    """Long cells of packed sheet rows: (..., date_metric, value), one per stored metric."""
    ids = [c for c in (*SCAN_COLUMNS, "query", "page_path") if c in rows.columns]
    flat = rows.select(*ids, F.inline("days"))
    cells: list[Column] = []
    for sheet, column in SHEET_METRICS.items():
        cells += [F.concat(F.date_format("dt", "yyyy-MM-dd"), F.lit(f"_{sheet}")), F.col(column)]
    return flat.select(*ids, F.stack(F.lit(len(METRICS)), *cells).alias("date_metric", "value"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
