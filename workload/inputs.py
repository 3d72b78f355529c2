"""Search-analytics inputs derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

import csv
import io
import uuid
from itertools import groupby

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill import Mart, create_layers
from searchmill.schemas import FACT_COLUMNS, METRICS, SHEET_METRICS
from searchmill.sources.storage import delete_folder, new_folder
from workload.xlsx import workbook

# Facts that one task makes a part of a sheet or of a text file of.
PART_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EVENT_FACTS = """
  SELECT CAST(ts AS date) AS dt,
         'q' || (user_id % 7) AS query,
         '/u/' || (user_id % 20) || CASE WHEN event_id % 3 = 0 THEN '?k=1' ELSE '' END AS page_path,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS int) AS demand,
         CAST(count(*) FILTER (WHERE event_type IN ('purchase', 'error')) AS int) AS impressions,
         max(value) AS position,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS int) AS clicks
  FROM events GROUP BY 1, 2, 3
"""

LINE_FACTS = """
  SELECT CAST(date_trunc('month', l_shipdate) AS date) AS dt,
         l_returnflag || l_linestatus AS query,
         '/p/' || l_partkey || '?s=' || l_suppkey AS page_path,
         CAST(l_quantity AS int) AS demand,
         CAST(l_linenumber * 8 AS int) AS impressions,
         l_discount AS position,
         CAST(l_partkey % 60 AS int) AS clicks
  FROM lineitem
"""

# Three years later than the lines, so that about half of the months of each meet the other.
ORDER_FACTS = """
  SELECT CAST(date_trunc('month', o_orderdate + INTERVAL '36' MONTH) AS date) AS dt,
         o_orderpriority AS query,
         '/o/' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN '?s=F' ELSE '' END AS page_path,
         CAST(o_orderkey % 25 AS int) AS demand,
         CAST(o_custkey % 9 AS int) AS impressions,
         o_totalprice AS position,
         CAST(o_orderkey % 4 AS int) AS clicks
  FROM orders
"""


def _sql(spark: SparkSession, sf_dir: str, name: str, statement: str) -> DataFrame:
    return spark.sql(statement.replace(f"FROM {name}", "FROM {source}"), source=table(spark, sf_dir, name))


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts, unique by (dt, query, page_path)."""
    return _sql(spark, sf_dir, "events", EVENT_FACTS)


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monthly fact per order line; keys repeat."""
    return _sql(spark, sf_dir, "lineitem", LINE_FACTS)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monthly fact per order; keys repeat."""
    return _sql(spark, sf_dir, "orders", ORDER_FACTS)


def to_wide(facts: DataFrame) -> DataFrame:
    """The export sheet of facts that are unique by date, query and page.

    The tasks are as many as PART_ROWS asks for. Until it is written, a row has its own days only: a
    pivot would keep a place for each cell of each row of a task.
    """
    # The distinct dates are as many as the sheet has column groups.
    counts = facts.groupBy("dt").count().collect()
    dates = sorted(r.dt for r in counts)
    tasks = 1 + sum(r["count"] for r in counts) // PART_ROWS
    sheet = {column: name for name, column in SHEET_METRICS.items()}
    packed = (
        facts.withColumnsRenamed({"query": "Query", "page_path": "Url"})
        .repartition(tasks, "Query", "Url")
        .groupBy("Query", "Url")
        .agg(F.collect_list(F.struct("dt", *METRICS)).alias("days"))
    )
    cells = []
    for date in dates:
        day = F.get("days", (F.array_position("days.dt", F.lit(date)) - 1).cast("int"))
        cells += [day[m].alias(f"{date}_{sheet[m]}") for m in METRICS]
    return packed.select("Query", "Url", *cells)


def event_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet with one row per event, so that queries and pages repeat: the event's own
    day is filled, the other days are empty. `row_no` is the event's id."""
    events = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("dt"), "event_id", "user_id", "event_type", "value"
    )
    dates = sorted(r.dt for r in events.select("dt").distinct().collect())
    cells = []
    for date in dates:
        today = f"CASE WHEN dt = DATE '{date}'"
        cells += [
            f"{today} AND event_type <> 'error' THEN event_id % 5 END AS `{date}_demand`",
            f"{today} THEN user_id % 4 END AS `{date}_shows`",
            f"{today} THEN value END AS `{date}_position`",
            f"{today} AND event_type = 'click' THEN 1 END AS `{date}_clicks`",
        ]
    return events.selectExpr(
        "event_id AS row_no",
        "CASE WHEN user_id % 11 <> 0 THEN 'q' || (user_id % 7) END AS Query",
        "'/u/' || user_id AS Url",
        *cells,
    )


# First event per query and page, with its own day's metrics.
EVENT_SHEET_FIRST = """
  SELECT CAST(ts AS date) AS dt, query, page_path,
         CAST(CASE WHEN event_type <> 'error' THEN event_id % 5 ELSE 0 END AS int) AS demand,
         CAST(user_id % 4 AS int) AS impressions, value AS position,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks
  FROM (SELECT *, row_number() OVER (PARTITION BY query, page_path ORDER BY event_id) AS nth
        FROM (SELECT *, CASE WHEN user_id % 11 <> 0 THEN 'q' || (user_id % 7) END AS query,
                     '/u/' || user_id AS page_path FROM events))
  WHERE nth = 1
"""


def new_mart(spark: SparkSession, purpose: str) -> Mart:
    """A fresh, empty pair of tables in the shared folder."""
    tag = f"{purpose}_{uuid.uuid4().hex[:8]}"
    mart = Mart(f"rdl_{tag}.webm_excel", f"ppl_{tag}.webmaster_aggregated")
    create_layers(spark, mart, new_folder(spark, "tables"))
    return mart


def chunked(facts: DataFrame) -> DataFrame:
    """Facts with the name of the ten-day export they belong to."""
    part = F.floor((F.dayofmonth("dt") - 1) / 10)
    return facts.withColumn("chunk", F.concat(F.date_format("dt", "yyyy-MM-"), part))


def write_wide_folders(facts: DataFrame, folder: str, fmt: str) -> None:
    """One wide CSV or Parquet export per ten days, each with its own dates as columns."""
    parts = chunked(facts)
    for row in parts.select("chunk").distinct().orderBy("chunk").collect():
        wide = to_wide(parts.where(F.col("chunk") == row.chunk).drop("chunk"))
        wide.write.option("header", True).format(fmt).save(f"{folder}/{row.chunk}.{fmt}")


def store_files(files: DataFrame, folder: str) -> None:
    """Write (name, content) rows as files of the shared folder, in tasks."""

    def store(batches):
        for batch in batches:
            system, root = fs.FileSystem.from_uri(folder)
            system.create_dir(root, recursive=True)
            for name, content in zip(batch["name"], batch["content"]):
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write(content)
            yield batch[["name"]]

    files.mapInPandas(store, "name string").write.format("noop").mode("overwrite").save()


def _sheet(chunk: pd.DataFrame) -> list[list]:
    """Header and rows of the export sheet of some facts."""
    dates = sorted(chunk["dt"].unique())
    sheet: dict[tuple, list] = {}
    for f in chunk.itertuples():
        sheet.setdefault((f.query, f.page_path), []).append(f)
    return [_sheet_head(dates), *[_sheet_row(key, days, dates) for key, days in sheet.items()]]


def _sheet_head(dates: list) -> list[str]:
    names = {column: name for name, column in SHEET_METRICS.items()}
    return ["Query", "Url"] + [f"{d}_{names[m]}" for d in dates for m in METRICS]


def _sheet_row(key: tuple, days, dates: list) -> list:
    cells = [None] * (len(dates) * len(METRICS))
    for f in days:
        at = dates.index(f.dt) * len(METRICS)
        cells[at : at + len(METRICS)] = [getattr(f, m) for m in METRICS]
    return [*key, *cells]


def write_spreadsheets(facts: DataFrame, folder: str, suffix: str = "") -> None:
    """One spreadsheet per ten days, written by the tasks into the shared folder.

    A spreadsheet is one file, so its rows meet in one task; the event facts have a fixed
    key space of 280 rows per sheet however many events there are.
    """

    def build(chunk: pd.DataFrame) -> pd.DataFrame:
        content = workbook(_sheet(chunk))
        return pd.DataFrame({"name": [f"{chunk['chunk'].iloc[0]}{suffix}.xlsx"], "content": [content]})

    parts = chunked(facts).select("chunk", *FACT_COLUMNS)
    store_files(parts.groupBy("chunk").applyInPandas(build, "name string, content binary"), folder)


def _write_text(facts: DataFrame, folder: str, name: str, keys: list[str], columns: list[str], lines) -> None:
    """CSV files per ten days as Python's csv module writes them: quotes doubled, no escapes.

    `lines(rows, dates)` gives the header and rows of a file for facts in the order of `keys`. The
    facts are evaluated once, into a table of their own. Each task writes a range of them row by row,
    to a file called `name` for each ten days it meets; facts of the same keys meet in one file.
    """
    spark = facts.sparkSession
    staging = new_folder(spark, "text")
    order = ["chunk", *keys]

    def write(batches):
        part = TaskContext.get().partitionId()
        system, root = fs.FileSystem.from_uri(folder)
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        for chunk, own in groupby(rows, lambda row: row.chunk):
            path = f"{root}/{name.format(chunk=chunk, part=part)}"
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with io.TextIOWrapper(system.open_output_stream(path), encoding="utf-8", newline="") as out:
                csv.writer(out).writerows(lines(own, dates[chunk]))
            yield pd.DataFrame({"name": [path]})

    try:
        chunked(facts).select("chunk", *columns).write.parquet(staging)
        staged = spark.read.parquet(staging)
        dates: dict[str, list] = {}
        for row in staged.select("chunk", "dt").distinct().collect():
            dates[row.chunk] = sorted([*dates.get(row.chunk, []), row.dt])
        ordered = staged.repartitionByRange(1 + staged.count() // PART_ROWS, *order).sortWithinPartitions(*order)
        ordered.mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    finally:
        delete_folder(spark, staging)


def write_csv_text(facts: DataFrame, folder: str) -> None:
    """One CSV export per ten days, not written by Spark: a folder of part files."""

    def lines(facts, dates):
        yield _sheet_head(dates)
        for key, days in groupby(facts, lambda f: (f.query, f.page_path)):
            yield _sheet_row(key, days, dates)

    _write_text(facts, folder, "{chunk}.csv/part-{part:05d}.csv", ["query", "page_path"], FACT_COLUMNS, lines)


def write_history_text(rows: DataFrame, folder: str, columns: list[str]) -> None:
    """History files with their columns in this order, of ten days each, not written by Spark."""

    def lines(rows, dates):
        yield columns
        for row in rows:
            yield row[1:]

    _write_text(rows, folder, "{chunk}-{part:05d}.csv", ["id"], columns, lines)


AWKWARD = """'say "' || query || '", c:\\dir\\'"""


def awkward(facts: DataFrame) -> DataFrame:
    """Queries with quotes, commas and backslashes."""
    return facts.withColumn("query", F.concat(F.lit('say "'), "query", F.lit('", c:\\dir\\')))


# Facts that are unique by quarter, query and page, and grow with the lines.
QUARTER_FACTS = """
  SELECT CAST(date_trunc('quarter', l_shipdate) AS date) AS dt,
         l_returnflag || l_linestatus AS query,
         '/p/' || l_partkey || '?s=' || l_suppkey AS page_path,
         CAST(sum(l_linenumber) AS int) AS demand,
         CAST(count(*) * 4 AS int) AS impressions,
         min(l_discount) AS position,
         CAST(max(l_linenumber) AS int) AS clicks
  FROM lineitem GROUP BY 1, 2, 3
"""


def quarter_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are dealt out by page first, so that a task groups PART_ROWS of them, and only once."""
    lines = table(spark, sf_dir, "lineitem")
    page = F.expr("'/p/' || l_partkey || '?s=' || l_suppkey")
    dealt = lines.repartition(1 + lines.count() // PART_ROWS, page)
    return spark.sql(QUARTER_FACTS.replace("FROM lineitem", "FROM {source}"), source=dealt)


def write_year_sheets(facts: DataFrame, folder: str) -> None:
    """One wide Parquet export per year, in place of the one of that name."""
    for year, wide in _year_sheets(facts):
        wide.write.mode("overwrite").parquet(f"{folder}/{year}.parquet")


def _year_sheets(facts: DataFrame):
    """(year, sheet) of each year; the facts are evaluated once, into a table with a part per year."""
    spark = facts.sparkSession
    staging = new_folder(spark, "years")
    by_year = facts.withColumn("year", F.year("dt"))
    try:
        by_year.write.partitionBy("year").parquet(staging)
        staged = spark.read.schema(by_year.schema).parquet(staging)
        for row in staged.select("year").distinct().orderBy("year").collect():
            yield row.year, to_wide(staged.where(F.col("year") == row.year).drop("year"))
    finally:
        delete_folder(spark, staging)


# Some metrics of the quarters can't be read: no number, beyond INT, or both in one row.
BAD_TEXTS = """
  SELECT dt, query, page_path,
         CASE WHEN demand % 17 = 3 THEN 'n/a' ELSE CAST(demand AS {string}) END AS demand,
         CAST(impressions AS {string}) AS impressions, CAST(position AS {string}) AS position,
         CASE WHEN (impressions + clicks) % 19 = 5 THEN '3000000000' ELSE CAST(clicks AS {string}) END AS clicks
  FROM quarters
"""


def bad_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    statement = BAD_TEXTS.format(string="STRING").replace("FROM quarters", "FROM {source}")
    return spark.sql(statement, source=quarter_facts(spark, sf_dir))


def write_bad_year_sheets(facts: DataFrame, folder: str) -> None:
    """One wide CSV export per year of facts with text metrics."""
    for year, wide in _year_sheets(facts):
        wide.write.option("header", True).csv(f"{folder}/{year}.csv")


def write_bad_history(rows: DataFrame, folder: str) -> None:
    """History files in which some dates and ids can't be read."""
    dt = F.when(F.col("id") % 13 == 4, F.date_format("dt", "yyyy-MM-'31st'")).otherwise(F.col("dt").cast("string"))
    number = F.when(F.col("id") % 11 == 6, F.concat(F.lit("#"), "id")).otherwise(F.col("id").cast("string"))
    rows.withColumn("dt", dt).withColumn("id", number).write.option("header", True).csv(folder)
