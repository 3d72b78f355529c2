"""Every operator as a query over the given tables, with the same result in SQL.

A query is `(spark, sf_dir) -> DataFrame`; those that load tables do so in fresh ones.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill import (
    append_facts,
    export_facts,
    ingest,
    load_exports,
    refresh_clean,
    replace_by_date,
    run,
    seed_history,
    seed_raw,
)
from searchmill.__main__ import PREVIEW_ROWS
from searchmill.functions.columns import click_cap, demand_floor, strip_url_params
from searchmill.operators.merge import keep_winners, latest_export_per_date
from searchmill.operators.quality import clean_facts, loaded_dates, repeated_ids, repeated_table_ids
from searchmill.operators.report import quality_report
from searchmill.operators.reshape import (
    keep_positive,
    pivot_first,
    sheet_rows_to_cells,
    split_header,
    type_facts,
    unpivot_cells,
    wide_to_facts,
)
from searchmill.schemas import FACT_COLUMNS, RAW_COLUMNS
from searchmill.sinks.switch import ConcurrentLoadError, begin_load, commit, switch, write_dates
from searchmill.sinks.tables import delete_by_dates
from searchmill.sources.spreadsheet import read_spreadsheets
from searchmill.sources.storage import new_folder
from searchmill.sources.tables import current_table, read_clean, read_raw
from workload.inputs import (
    AWKWARD,
    BAD_TEXTS,
    EVENT_FACTS,
    EVENT_SHEET_FIRST,
    LINE_FACTS,
    ORDER_FACTS,
    QUARTER_FACTS,
    awkward,
    bad_texts,
    event_facts,
    event_sheet,
    line_facts,
    new_mart,
    order_facts,
    quarter_facts,
    table,
    to_wide,
    write_bad_history,
    write_bad_year_sheets,
    write_csv_text,
    write_history_text,
    write_spreadsheets,
    write_wide_folders,
    write_year_sheets,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

POSITIVE = "(demand > 0 OR impressions > 0 OR clicks > 0)"
FACTS = ", ".join(FACT_COLUMNS)
CLEAN = """dt, query, split_part(page_path, '?', 1) AS page_path,
  CASE WHEN demand < impressions THEN impressions ELSE demand END AS demand, impressions, position,
  CASE WHEN clicks > impressions THEN impressions ELSE clicks END AS clicks"""
ROW_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("dt", "query", "page_path", "demand", "impressions", "position", "clicks")
)
WITH = (
    f"WITH events_f AS ({EVENT_FACTS}), line_f AS ({LINE_FACTS}), order_f AS ({ORDER_FACTS}),"
    f" quarter_f AS ({QUARTER_FACTS})"
)


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


# --- reshaping ----------------------------------------------------------------------------


@query(f"{WITH} SELECT * FROM events_f WHERE {POSITIVE}")
def wide_to_fact(spark, sf_dir):
    """Wide sheet -> facts with traffic."""
    return wide_to_facts(to_wide(event_facts(spark, sf_dir)))


@query(f"{EVENT_SHEET_FIRST.rstrip()} AND (event_id % 5 > 0 AND event_type <> 'error' OR user_id % 4 > 0 OR event_type = 'click')")
def first_row_wins(spark, sf_dir):
    """A sheet that repeats queries and pages: the first row counts."""
    return wide_to_facts(event_sheet(spark, sf_dir))


@query(f"""{WITH}, keys AS (SELECT DISTINCT query, page_path FROM events_f),
  days AS (SELECT DISTINCT dt FROM events_f),
  cells AS (SELECT k.query, k.page_path, d.dt, f.demand, f.impressions, f.position, f.clicks
            FROM keys k CROSS JOIN days d LEFT JOIN events_f f
              ON f.query = k.query AND f.page_path = k.page_path AND f.dt = d.dt)
  SELECT query, page_path, strftime(dt, '%Y-%m-%d') AS date, m.metric, m.value
  FROM cells, LATERAL (VALUES ('demand', CAST(demand AS double)), ('shows', CAST(impressions AS double)),
    ('position', position), ('clicks', CAST(clicks AS double))) AS m(metric, value)""")
def unpivot_to_cells(spark, sf_dir):
    """Wide sheet -> one row per dated column, with the header split."""
    cells = split_header(unpivot_cells(to_wide(event_facts(spark, sf_dir))))
    return cells.select("query", "page_path", "date", "metric", "value")


@query("""SELECT dt, query, page_path,
    CAST(coalesce(demand, 0) AS int) AS demand, CAST(impressions AS int) AS impressions,
    position, CAST(coalesce(clicks, 0) AS int) AS clicks
  FROM (SELECT *, row_number() OVER (PARTITION BY dt, query, page_path ORDER BY event_id) AS nth
        FROM (SELECT CAST(ts AS date) AS dt, event_id, CASE WHEN user_id % 11 <> 0 THEN 'q' || (user_id % 7) END AS query,
                '/u/' || user_id AS page_path, CASE WHEN event_type <> 'error' THEN event_id % 5 END AS demand,
                user_id % 4 AS impressions, value AS position, CASE WHEN event_type = 'click' THEN 1 END AS clicks
              FROM events))
  WHERE nth = 1""")
def pivot_first_cell(spark, sf_dir):
    """Long cells with repeated keys -> one row per key, first cell of each metric."""
    events = table(spark, sf_dir, "events")
    kind, user = F.col("event_type"), F.col("user_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    metrics = {
        "demand": F.when(kind != "error", F.col("event_id") % 5),
        "shows": user % 4,
        "position": F.col("value"),
        "clicks": F.when(kind == "click", F.lit(1)),
    }
    pairs = []
    for name, value in metrics.items():
        pairs += [F.concat(day, F.lit(f"_{name}")), value.cast("double")]
    cells = events.select(
        F.col("event_id").alias("row_no"),
        F.when(user % 11 != 0, F.concat(F.lit("q"), user % 7)).alias("query"),
        F.concat(F.lit("/u/"), user).alias("page_path"),
        F.stack(F.lit(len(metrics)), *pairs).alias("date_metric", "value"),
    )
    return type_facts(pivot_first(split_header(cells)))


@query("SELECT DISTINCT strftime(CAST(ts AS date), '%Y-%m-%d') AS date FROM events")
def sheet_dates(spark, sf_dir):
    """Distinct dates of a sheet's header."""
    cells = unpivot_cells(to_wide(event_facts(spark, sf_dir)))
    return split_header(cells).select("date").distinct()


@query(f"{WITH} SELECT * FROM events_f WHERE {POSITIVE}")
def positive_metric_filter(spark, sf_dir):
    return keep_positive(event_facts(spark, sf_dir))


# --- cleaning rules -----------------------------------------------------------------------


@query("SELECT page_id, split_part(url, '?', 1) AS url FROM pages")
def strip_params(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", strip_url_params(F.col("url")).alias("url"))


@query(f"""{WITH} SELECT dt, query, page_path, nullif(demand, 9) AS demand,
  CASE WHEN nullif(demand, 9) < nullif(impressions, 16) THEN nullif(impressions, 16)
       ELSE nullif(demand, 9) END AS demand_corr FROM line_f""")
def demand_floor_rule(spark, sf_dir):
    demand, shows = F.nullif(F.col("demand"), F.lit(9)), F.nullif(F.col("impressions"), F.lit(16))
    return line_facts(spark, sf_dir).select(
        "dt", "query", "page_path", demand.alias("demand"), demand_floor(demand, shows).alias("demand_corr")
    )


@query(f"""{WITH} SELECT dt, query, page_path, nullif(clicks, 9) AS clicks,
  CASE WHEN nullif(clicks, 9) > nullif(impressions, 16) THEN nullif(impressions, 16)
       ELSE nullif(clicks, 9) END AS clicks_corr FROM line_f""")
def click_cap_rule(spark, sf_dir):
    clicks, shows = F.nullif(F.col("clicks"), F.lit(9)), F.nullif(F.col("impressions"), F.lit(16))
    return line_facts(spark, sf_dir).select(
        "dt", "query", "page_path", clicks.alias("clicks"), click_cap(clicks, shows).alias("clicks_corr")
    )


@query(f"{WITH} SELECT {CLEAN} FROM line_f")
def funnel_clean(spark, sf_dir):
    """All cleaning rules."""
    return clean_facts(line_facts(spark, sf_dir))


@query(f"""{WITH} SELECT count(*) AS rows_read, count(*) FILTER (WHERE {POSITIVE}) AS rows_kept,
  count(*) FILTER (WHERE page_path LIKE '%?%') AS urls_cut,
  count(*) FILTER (WHERE demand < impressions) AS demand_raised,
  count(*) FILTER (WHERE clicks > impressions) AS clicks_capped,
  min(dt) AS first_date, max(dt) AS last_date FROM order_f""")
def run_report(spark, sf_dir):
    return quality_report(order_facts(spark, sf_dir))


# --- raw table ----------------------------------------------------------------------------

REPLACED = f"""SELECT {FACTS} FROM line_f WHERE dt NOT IN (SELECT dt FROM order_f WHERE {POSITIVE})
  UNION ALL SELECT {FACTS} FROM order_f WHERE {POSITIVE}"""


def _lines_then_orders(spark, sf_dir, name, times=1):
    mart = new_mart(spark, name)
    replace_by_date(line_facts(spark, sf_dir), mart)
    for _ in range(times):
        replace_by_date(keep_positive(order_facts(spark, sf_dir)), mart)
    return mart


TRIPLED = f"{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) * 3 AS id, {FACTS} FROM line_f"


@query(TRIPLED)
def interrupted_switch(spark, sf_dir):
    """A load that ends between its log entry and its switch: who reads next finishes it."""
    mart = new_mart(spark, "interrupted")
    replace_by_date(line_facts(spark, sf_dir), mart)
    state = begin_load(spark, mart.raw)
    tripled = read_raw(spark, mart).withColumn("id", F.col("id") * 3)
    name, dates, _ = write_dates(tripled, state, RAW_COLUMNS)
    commit(spark, mart.raw, state, name, dates)
    return read_raw(spark, mart)


@query(f"{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM line_f")
def failed_loads(spark, sf_dir):
    """The raw table after loads that fail while they write, and one that another has overtaken."""
    mart = new_mart(spark, "failed")
    replace_by_date(line_facts(spark, sf_dir), mart)
    late = begin_load(spark, mart.raw)
    table = read_raw(spark, mart)
    broken = F.when(F.col("clicks") == 7, F.raise_error(F.lit("broken on purpose")).cast("int"))
    for load in (
        lambda: seed_raw(table.withColumn("demand", F.coalesce(broken, "demand")), mart),
        lambda: seed_raw(table.withColumn("id", F.when(F.col("demand") > 3, F.col("id"))), mart),
    ):
        try:
            load()
        except (PySparkException, Py4JJavaError):
            continue
        raise AssertionError("a broken load went through")
    replace_by_date(line_facts(spark, sf_dir), mart)
    try:
        switch(spark, mart.raw, late, *write_dates(table.limit(0), late, RAW_COLUMNS)[:2])
    except ConcurrentLoadError:
        return read_raw(spark, mart)
    raise AssertionError("an overtaken load went through")


@query(f"{WITH} {REPLACED}")
def replace_dates(spark, sf_dir):
    """Reload: the months of the new facts are replaced, the others stay."""
    return read_raw(spark, _lines_then_orders(spark, sf_dir, "replace")).drop("id")


@query(f"""{WITH}, firsts AS (SELECT *, row_number() OVER (ORDER BY {ROW_ORDER}) AS id FROM line_f),
  kept AS (SELECT * FROM firsts WHERE dt NOT IN (SELECT dt FROM order_f WHERE {POSITIVE}))
  SELECT id, {FACTS} FROM kept
  UNION ALL
  SELECT (SELECT max(id) FROM kept) + row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS}
  FROM order_f WHERE {POSITIVE}""")
def replace_dates_twice(spark, sf_dir):
    """Loading the same facts again changes nothing, ids included."""
    return read_raw(spark, _lines_then_orders(spark, sf_dir, "twice", times=2))


@query(f"""{WITH}, quiet AS (SELECT dt, query, page_path, CASE WHEN month(dt) > 6 THEN 0 ELSE demand END AS demand,
    CASE WHEN month(dt) > 6 THEN 0 ELSE impressions END AS impressions, position,
    CASE WHEN month(dt) > 6 THEN 0 ELSE clicks END AS clicks FROM order_f)
  SELECT {FACTS} FROM line_f WHERE dt NOT IN (SELECT dt FROM quiet WHERE {POSITIVE})
  UNION ALL SELECT {FACTS} FROM quiet WHERE {POSITIVE}""")
def replace_skips_filtered_dates(spark, sf_dir):
    """A reload whose rows of a date are all without traffic leaves that date alone."""
    mart = new_mart(spark, "quiet")
    replace_by_date(line_facts(spark, sf_dir), mart)
    silent = F.month("dt") > 6
    quiet = order_facts(spark, sf_dir).withColumns(
        {m: F.when(silent, 0).otherwise(F.col(m)) for m in ("demand", "impressions", "clicks")}
    )
    replace_by_date(keep_positive(quiet), mart)
    return read_raw(spark, mart).drop("id")


@query(f"""{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM line_f""")
def assign_ids(spark, sf_dir):
    """Dense ids over a total order of the rows, without a window over them."""
    mart = new_mart(spark, "ids")
    replace_by_date(line_facts(spark, sf_dir), mart)
    return read_raw(spark, mart)


@query(f"""{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM line_f
  UNION ALL
  SELECT (SELECT count(*) FROM line_f) + row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM order_f""")
def append_rows(spark, sf_dir):
    """Append: columns are checked and put in order, a given id is dropped, ids continue."""
    mart = new_mart(spark, "append")
    append_facts(line_facts(spark, sf_dir), mart)
    append_facts(order_facts(spark, sf_dir).withColumn("id", F.lit(-1)), mart)
    return read_raw(spark, mart)


@query(f"{WITH} SELECT {FACTS} FROM line_f WHERE dt NOT IN (SELECT dt FROM order_f)")
def delete_dates(spark, sf_dir):
    """Remove the dates of one frame from the raw table."""
    mart = new_mart(spark, "delete")
    append_facts(line_facts(spark, sf_dir), mart)
    dates = [r.dt for r in order_facts(spark, sf_dir).select("dt").distinct().collect()]
    delete_by_dates(spark, dates, mart)
    return read_raw(spark, mart).drop("id")


@query("SELECT DISTINCT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS date_str FROM lineitem")
def loaded_date_list(spark, sf_dir):
    mart = new_mart(spark, "dates")
    append_facts(line_facts(spark, sf_dir), mart)
    return loaded_dates(read_raw(spark, mart))


@query("SELECT l_orderkey AS id, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def id_check(spark, sf_dir):
    """Ids that occur more than once, here order keys of lines."""
    return repeated_ids(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "id"))


@query(f"""{WITH}, ids AS (SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM line_f),
  shared AS (SELECT CASE WHEN id % 1000 = 7 THEN id - 5 WHEN id % 5000 = 9 THEN 1 ELSE id END AS id FROM ids)
  SELECT id, count(*) AS count FROM shared GROUP BY id HAVING count(*) > 1""")
def id_check_table(spark, sf_dir):
    """Ids that a loaded table holds more than once; only parts of files whose ids meet are counted."""
    first, mart = new_mart(spark, "first"), new_mart(spark, "shared_ids")
    replace_by_date(line_facts(spark, sf_dir), first)
    if repeated_table_ids(current_table(spark, first.raw)).count():
        raise ValueError("ids are repeated")
    shared = F.when(F.col("id") % 1000 == 7, F.col("id") - 5).when(F.col("id") % 5000 == 9, 1).otherwise(F.col("id"))
    seed_raw(read_raw(spark, first).withColumn("id", shared), mart)
    return repeated_table_ids(current_table(spark, mart.raw))


@query(f"""{WITH}, both_f AS (
    SELECT *, 'lines' AS source_file, 1 AS age FROM line_f WHERE {POSITIVE} UNION ALL
    SELECT *, 'orders' AS source_file, 2 AS age FROM order_f WHERE {POSITIVE})
  SELECT {FACTS}, source_file FROM both_f b
  WHERE age = (SELECT max(age) FROM both_f o WHERE o.dt = b.dt)""")
def latest_export_wins(spark, sf_dir):
    """Two exports with common months: per month, the later one."""
    lines = line_facts(spark, sf_dir).withColumn("source_file", F.lit("lines"))
    orders = order_facts(spark, sf_dir).withColumn("source_file", F.lit("orders"))
    facts = keep_positive(lines.unionByName(orders))
    exports = spark.sql(
        "SELECT * FROM VALUES ('lines', timestamp'2026-06-01'), ('orders', timestamp'2026-06-02')"
        " AS t(source_file, mtime)"
    )
    return keep_winners(facts, latest_export_per_date(facts, exports)).select(*FACT_COLUMNS, "source_file")


# --- cleaned table ------------------------------------------------------------------------


@query(f"{WITH} SELECT {CLEAN} FROM line_f")
def full_refresh(spark, sf_dir):
    """The cleaned table after a refresh."""
    mart = new_mart(spark, "refresh")
    append_facts(line_facts(spark, sf_dir), mart)
    refresh_clean(spark, mart)
    return read_clean(spark, mart).drop("id")


@query(f"""{WITH}, rows_f AS ({REPLACED}), n AS (SELECT dt, count(*) AS n FROM rows_f GROUP BY dt)
  SELECT dt, n AS ids, CAST(sum(n) OVER (ORDER BY dt) AS bigint) - n + 1 AS first_id,
         CAST(sum(n) OVER (ORDER BY dt) AS bigint) AS last_id FROM n""")
def clean_ids(spark, sf_dir):
    """Ids of the cleaned table restart at 1 and leave no gap: one block of ids per date."""
    mart = _lines_then_orders(spark, sf_dir, "clean_ids")
    refresh_clean(spark, mart)
    return (
        read_clean(spark, mart)
        .groupBy("dt")
        .agg(F.countDistinct("id").alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    )


# --- sources and whole runs ---------------------------------------------------------------


@query(f"{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) * 3 AS id, {FACTS} FROM events_f")
def history_seed(spark, sf_dir):
    """Facts with ids written as CSV, then seeded from there."""
    mart = new_mart(spark, "seed")
    replace_by_date(event_facts(spark, sf_dir), mart)
    folder = new_folder(spark, "history")
    history = read_raw(spark, mart).withColumn("id", F.col("id") * 3)
    history.write.option("header", True).csv(folder)
    seed_history(spark, folder, mart)
    return read_raw(spark, mart)


@query(f"{WITH} SELECT * FROM events_f WHERE {POSITIVE}")
def mixed_header_folder(spark, sf_dir):
    """CSV exports whose headers differ, loaded together."""
    folder, mart = new_folder(spark, "csv"), new_mart(spark, "csv")
    write_wide_folders(event_facts(spark, sf_dir), folder, "csv")
    load_exports(spark, folder, mart, fmt="csv")
    return read_raw(spark, mart).drop("id")


@query(f"{WITH} SELECT * FROM events_f WHERE {POSITIVE}")
def parquet_folder(spark, sf_dir):
    """Parquet exports whose columns differ, loaded together."""
    folder, mart = new_folder(spark, "parquet"), new_mart(spark, "parquet")
    write_wide_folders(event_facts(spark, sf_dir), folder, "parquet")
    load_exports(spark, folder, mart, fmt="parquet")
    return read_raw(spark, mart).drop("id")


@query(f"{WITH} SELECT * FROM events_f WHERE {POSITIVE}")
def spreadsheet_ingest(spark, sf_dir):
    """Spreadsheets, loaded together."""
    folder, mart = new_folder(spark, "xlsx"), new_mart(spark, "xlsx")
    write_spreadsheets(event_facts(spark, sf_dir), folder)
    load_exports(spark, folder, mart)
    return read_raw(spark, mart).drop("id")


@query(f"""{WITH} SELECT query, page_path, strftime(dt, '%Y-%m-%d') || '_' || m.metric AS date_metric, m.value
  FROM events_f, LATERAL (VALUES ('demand', CAST(demand AS double)), ('shows', CAST(impressions AS double)),
    ('position', position), ('clicks', CAST(clicks AS double))) AS m(metric, value)""")
def spreadsheet_cells(spark, sf_dir):
    """Long cells of spreadsheets."""
    folder = new_folder(spark, "xlsx")
    write_spreadsheets(event_facts(spark, sf_dir), folder)
    cells = sheet_rows_to_cells(read_spreadsheets(spark, folder))
    return cells.select("query", "page_path", "date_metric", "value")


AWKWARD_FACTS = f"SELECT dt, {AWKWARD} AS query, page_path, demand, impressions, position, clicks FROM quarter_f"


@query(f"{WITH} SELECT * FROM ({AWKWARD_FACTS}) WHERE {POSITIVE}")
def csv_quoted(spark, sf_dir):
    """CSV exports with quotes, commas and backslashes, not written by Spark."""
    folder, mart = new_folder(spark, "csv"), new_mart(spark, "quoted")
    write_csv_text(awkward(quarter_facts(spark, sf_dir)), folder)
    load_exports(spark, folder, mart, fmt="csv")
    return read_raw(spark, mart).drop("id")


@query(f"{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM ({AWKWARD_FACTS})")
def history_quoted(spark, sf_dir):
    """History with awkward queries and columns in another order, not written by Spark."""
    first, mart = new_mart(spark, "first"), new_mart(spark, "history")
    replace_by_date(awkward(quarter_facts(spark, sf_dir)), first)
    folder = new_folder(spark, "history")
    order = ["dt", "clicks", "query", "id", "position", "page_path", "impressions", "demand"]
    write_history_text(read_raw(spark, first), folder, order)
    seed_history(spark, folder, mart)
    return read_raw(spark, mart)


# A second export of the first two quarters of each year, with one more demand.
OVERLAP = f"""later AS (SELECT dt, query, page_path, demand + 1 AS demand, impressions, position, clicks
    FROM quarter_f WHERE month(dt) <= 6),
  won AS (SELECT * FROM later UNION ALL
    SELECT {FACTS} FROM quarter_f WHERE month(dt) > 6 AND {POSITIVE})"""
EVENT_OVERLAP = f"""later AS (SELECT dt, query, page_path, demand + 1 AS demand, impressions, position, clicks
    FROM events_f WHERE day(dt) <= 15),
  won AS (SELECT * FROM later UNION ALL
    SELECT {FACTS} FROM events_f WHERE day(dt) > 15 AND {POSITIVE})"""


def _two_exports(spark, sf_dir, mart, first, second):
    """Load two Parquet exports with common dates in one go; the second one is later."""
    folder = new_folder(spark, "two")
    facts = quarter_facts(spark, sf_dir)
    later = facts.where("month(dt) <= 6").withColumn("demand", F.col("demand") + 1)
    first(to_wide(facts)).write.parquet(f"{folder}/1.parquet")
    second(to_wide(later)).write.parquet(f"{folder}/2.parquet")
    load_exports(spark, folder, mart, fmt="parquet")
    return read_raw(spark, mart)


def _metrics_as(kind):
    return lambda wide: wide.select(
        "Query", "Url", *[F.col(f"`{c}`").cast(kind).alias(c) for c in wide.columns[2:] if "position" not in c],
        *[f"`{c}`" for c in wide.columns[2:] if "position" in c],
    )


def _third_part(suffix):
    return lambda wide: wide.withColumnsRenamed({c: f"{c}_{suffix}" for c in wide.columns[2:]})


@query(f"{WITH}, {OVERLAP} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM won")
def parquet_mixed_types(spark, sf_dir):
    """Two exports of common dates, double and integer: per date the later wins, ids included."""
    return _two_exports(spark, sf_dir, new_mart(spark, "types"), _metrics_as("double"), _metrics_as("int"))


@query(f"{WITH}, {OVERLAP} SELECT {FACTS} FROM won")
def parquet_third_part(spark, sf_dir):
    """Two exports of common dates whose headers have a third part that differs."""
    rows = _two_exports(spark, sf_dir, new_mart(spark, "third"), _third_part("x"), _third_part("y"))
    return rows.drop("id")


@query(f"{WITH}, {EVENT_OVERLAP} SELECT {FACTS} FROM won")
def incremental_ingest(spark, sf_dir):
    """A stream over a folder, a file a batch: all exports, then corrected ones for the days up
    to the 15th. The other days come from the first wave alone."""
    folder, mart = new_folder(spark, "stream"), new_mart(spark, "stream")
    checkpoint = new_folder(spark, "stream-checkpoint")
    facts = event_facts(spark, sf_dir)
    corrected = facts.where("day(dt) <= 15").withColumn("demand", F.col("demand") + 1)
    for suffix, sheets in (("", facts), ("-corrected", corrected)):
        write_spreadsheets(sheets, folder, suffix)
        ingest(spark, folder, checkpoint, mart).awaitTermination()
    table_ids = read_raw(spark, mart)
    if repeated_ids(table_ids).count():
        raise ValueError("ids are repeated")
    return table_ids.drop("id")


QUARTERS = f"""WITH quarters AS ({QUARTER_FACTS}), texts AS ({BAD_TEXTS.format(string="VARCHAR")}),
  judged AS (SELECT *, nullif(concat_ws('; ',
      CASE WHEN demand = 'n/a' THEN 'demand: ''n/a'' is no number' END,
      CASE WHEN clicks = '3000000000' THEN 'clicks: ''3000000000'' is beyond INT' END), '') AS reason FROM texts)"""


def _load_bad_sheets(spark, sf_dir):
    folder, mart = new_folder(spark, "bad"), new_mart(spark, "bad")
    write_bad_year_sheets(bad_texts(spark, sf_dir), folder)
    load_exports(spark, folder, mart, fmt="csv", quarantine=f"{mart.raw}_bad")
    return mart


@query(f"""{QUARTERS}, good AS (SELECT dt, query, page_path, CAST(demand AS int) AS demand,
    CAST(impressions AS int) AS impressions, CAST(position AS double) AS position, CAST(clicks AS int) AS clicks
    FROM judged WHERE reason IS NULL)
  SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM good WHERE {POSITIVE}""")
def quarantine_good(spark, sf_dir):
    """Facts of CSV exports some of whose cells can't be read: the good ones, with ids."""
    return read_raw(spark, _load_bad_sheets(spark, sf_dir))


@query(f"""{QUARTERS} SELECT strftime(dt, '%Y-%m-%d') AS dt, query, page_path, demand, impressions,
    CAST(position AS double) AS position, clicks, reason, year(dt) || '.csv' AS source_file
  FROM judged WHERE reason IS NOT NULL""")
def quarantine_bad(spark, sf_dir):
    """The same load: the others as they were found, with file and reason."""
    mart = _load_bad_sheets(spark, sf_dir)
    return spark.table(f"{mart.raw}_bad").withColumn("position", F.col("position").cast("double"))


IDS = f"{WITH}, ids AS (SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM line_f)"


def _seed_bad_history(spark, sf_dir):
    first, mart = new_mart(spark, "first"), new_mart(spark, "bad_history")
    replace_by_date(line_facts(spark, sf_dir), first)
    folder = new_folder(spark, "history")
    write_bad_history(read_raw(spark, first), folder)
    seed_history(spark, folder, mart, quarantine=f"{mart.raw}_bad")
    return mart


@query(f"{IDS} SELECT id, {FACTS} FROM ids WHERE id % 13 <> 4 AND id % 11 <> 6")
def quarantine_history_good(spark, sf_dir):
    """History with bad dates and ids: the good rows."""
    return read_raw(spark, _seed_bad_history(spark, sf_dir))


@query(f"""{IDS}, texts AS (SELECT query, page_path, demand, clicks,
    CASE WHEN id % 13 = 4 THEN strftime(dt, '%Y-%m-31st') ELSE strftime(dt, '%Y-%m-%d') END AS dt,
    CASE WHEN id % 11 = 6 THEN '#' || id ELSE CAST(id AS varchar) END AS id, id % 13 = 4 AS x, id % 11 = 6 AS y FROM ids)
  SELECT id, dt, query, page_path, demand, clicks, concat_ws('; ',
    CASE WHEN y THEN 'id: ''' || id || ''' is no BIGINT' END,
    CASE WHEN x THEN 'dt: ''' || dt || ''' is no date' END) AS reason
  FROM texts WHERE x OR y""")
def quarantine_history_bad(spark, sf_dir):
    """The same history: the bad rows."""
    mart = _seed_bad_history(spark, sf_dir)
    bad = spark.table(f"{mart.raw}_bad")
    return bad.select(
        "id", "dt", "query", "page_path", F.col("demand").cast("int").alias("demand"),
        F.col("clicks").cast("int").alias("clicks"), "reason",
    )


IN_PLACE = f"""WITH q AS ({QUARTER_FACTS}),
  firsts AS (SELECT *, row_number() OVER (ORDER BY {ROW_ORDER}) AS id FROM q WHERE {POSITIVE}),
  kept AS (SELECT * FROM firsts WHERE year(dt) > 1995),
  later AS (SELECT dt, query, page_path, demand + 1 AS demand, impressions, position, clicks
    FROM q WHERE year(dt) <= 1995)
  SELECT id, {FACTS} FROM kept UNION ALL
  SELECT (SELECT max(id) FROM kept) + row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM later"""


@query(IN_PLACE)
def stream_corrected_in_place(spark, sf_dir):
    """A stream over yearly exports, some of which are then corrected under their old names."""
    folder, mart = new_folder(spark, "in-place"), new_mart(spark, "in_place")
    checkpoint = new_folder(spark, "in-place-checkpoint")
    facts = quarter_facts(spark, sf_dir)
    corrected = facts.where("year(dt) <= 1995").withColumn("demand", F.col("demand") + 1)
    for sheets in (facts, corrected):
        write_year_sheets(sheets, folder)
        stream = ingest(spark, folder, checkpoint, mart, "parquet", files_per_batch=100, corrected=True)
        stream.awaitTermination()
    return read_raw(spark, mart)


CHUNK = "strftime(dt, '%Y-%m-') || CAST(floor((day(dt) - 1) / 10) AS int)"


@query(f"""{WITH} SELECT DISTINCT 'archive' AS place, {CHUNK} || '_stamp.xlsx' AS name FROM events_f""")
def archived_exports(spark, sf_dir):
    """Files after a load with an archive inside the input folder: all moved, with a time stamp."""
    folder, mart = new_folder(spark, "in"), new_mart(spark, "archive")
    write_spreadsheets(event_facts(spark, sf_dir), folder)
    load_exports(spark, folder, mart, archive=f"{folder}/archive")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_replace("_metadata.file_name", r"_\d{8}_\d{6}", "_stamp")
    below = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
    return files.select(below.alias("place"), name.alias("name"))


@query(f"{WITH} SELECT row_number() OVER (ORDER BY {ROW_ORDER}) AS id, {FACTS} FROM line_f")
def refused_loads(spark, sf_dir):
    """The raw table after loads that must be refused: a column missing, a null date, no rows."""
    mart = new_mart(spark, "refused")
    facts = line_facts(spark, sf_dir)
    append_facts(facts, mart)
    for bad in (facts.drop("clicks"), facts.withColumn("dt", F.when(F.col("clicks") > 0, F.col("dt")))):
        try:
            replace_by_date(bad, mart)
        except ValueError:
            continue
        raise AssertionError("a bad load was not refused")
    replace_by_date(facts.where("demand < 0"), mart)
    return read_raw(spark, mart)


@query(f"{WITH} SELECT CAST(least(count(*), 5) AS bigint) AS rows FROM quarter_f WHERE {POSITIVE}")
def preview_rows(spark, sf_dir):
    """Number of facts that a preview of a folder shows."""
    folder = new_folder(spark, "preview")
    write_csv_text(quarter_facts(spark, sf_dir), folder)
    return export_facts(spark, folder, "csv").limit(PREVIEW_ROWS).agg(F.count("*").alias("rows"))


@query(f"WITH q AS ({QUARTER_FACTS}) SELECT {FACTS} FROM q WHERE {POSITIVE}")
def line_sheet_load(spark, sf_dir):
    """A wide sheet of all order lines by quarter, loaded: as many facts as there are lines."""
    folder, mart = new_folder(spark, "lines"), new_mart(spark, "lines")
    to_wide(quarter_facts(spark, sf_dir)).write.parquet(f"{folder}/lines.parquet")
    load_exports(spark, folder, mart, fmt="parquet")
    return read_raw(spark, mart).drop("id")


@query(f"{WITH} SELECT {CLEAN} FROM events_f WHERE {POSITIVE}")
def full_run(spark, sf_dir):
    """Wide Parquet export -> raw table -> cleaned table."""
    folder, mart = new_folder(spark, "exports"), new_mart(spark, "run")
    to_wide(event_facts(spark, sf_dir)).write.parquet(f"{folder}/export.parquet")
    run(spark, folder, mart, fmt="parquet")
    return read_clean(spark, mart).drop("id")
