"""The inputs of the queries, made by tasks of bounded size."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (tasks get the workload with their function)
from searchmill.operators import keys, quarantine
from searchmill.plans.load import export_facts
from searchmill.schemas import FACT_COLUMNS, RAW_COLUMNS
from searchmill.sinks import switch
from searchmill.sinks.tables import append_facts
from searchmill.sources.history import read_history
from searchmill.sources.tables import current_table, read_raw
from searchmill.sources.wide import read_wide_csv
from tests.test_plans import plan
from workload import inputs

D = [dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2026, 1, 25)]
SCHEMA = "dt date, query string, page_path string, demand int, impressions int, position double, clicks int"


def rows(df):
    return sorted((tuple(r) for r in df.select(*FACT_COLUMNS).collect()), key=str)


@pytest.fixture
def facts(spark):
    found = [(d, f'q "{n % 3}", \\', f"/{n}" if n else None, n + 1, 2, 0.5, 0) for n in range(40) for d in D if n % 4 or d != D[0]]
    return spark.createDataFrame(found, SCHEMA)


def test_csv_exports_come_in_parts(spark, facts, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "PART_ROWS", 20)
    inputs.write_csv_text(facts, str(tmp_path / "in"))
    files = glob.glob(f"{tmp_path}/in/*.csv/*.csv")
    # Ranges of rows of one export: several files, none of which has all of its rows.
    assert len({f.split("/")[-2] for f in files}) == 2 and len(files) > 4
    assert max(sum(1 for _ in open(f)) for f in files) < 40
    assert rows(export_facts(spark, str(tmp_path / "in"), "csv")) == rows(facts)


def test_history_files_come_in_parts(spark, facts, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "PART_ROWS", 20)
    history = facts.withColumn("id", F.monotonically_increasing_id())
    columns = [*reversed(RAW_COLUMNS)]
    inputs.write_history_text(history, str(tmp_path / "in"), columns)
    files = glob.glob(f"{tmp_path}/in/*.csv")
    assert len(files) > 4 and max(sum(1 for _ in open(f)) for f in files) < 40
    read = read_history(spark, str(tmp_path / "in"))
    assert sorted(map(str, read.select(*RAW_COLUMNS).collect())) == sorted(map(str, history.select(*RAW_COLUMNS).collect()))


def test_sheets_are_made_by_more_tasks_if_there_are_more_facts(facts, monkeypatch):
    monkeypatch.setattr(inputs, "PART_ROWS", 20)
    wide = inputs.to_wide(facts)
    assert wide.rdd.getNumPartitions() == 1 + facts.count() // 20
    assert "pivotfirst" not in plan(wide)
    got = {(r["Query"], r["Url"]): r for r in wide.collect()}
    assert len(got) == 40
    row = got['q "1", \\', "/4"]
    assert row["2026-01-01_demand"] is None and row["2026-01-25_demand"] == 5 and row["2026-01-02_position"] == 0.5


def test_lines_are_grouped_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "PART_ROWS", 20)
    lines = spark.range(200).selectExpr(
        "id AS l_orderkey", "id % 90 AS l_partkey", "id % 9 AS l_suppkey", "CAST(1 AS int) AS l_linenumber",
        "0.1D AS l_discount", "'A' AS l_returnflag", "'F' AS l_linestatus", "timestamp_ntz'1995-02-03' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    quarters = inputs.quarter_facts(spark, str(tmp_path))
    assert plan(quarters).count("Exchange ") == 1
    assert quarters.rdd.getNumPartitions() == 11 and quarters.count() == 90
    assert quarters.agg(F.sum("demand")).first()[0] == 200


def test_year_sheets_evaluate_the_facts_once(spark, facts, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    facts = facts.withColumn("query", F.lit("q"))
    three = facts.unionByName(facts.withColumn("dt", F.add_months("dt", 12))).unionByName(
        facts.withColumn("dt", F.add_months("dt", 24))
    )
    inputs.write_bad_year_sheets(three.mapInPandas(count, SCHEMA), str(tmp_path / "in"))
    assert seen.value == three.count()
    assert rows(export_facts(spark, str(tmp_path / "in"), "csv")) == rows(three)


def test_cells_are_tried_once(spark, facts, tmp_path):
    inputs.write_bad_year_sheets(facts, str(tmp_path / "in"))
    sheet = read_wide_csv(spark, str(tmp_path / "in"), strict=False)
    text = quarantine.sheet_rows_to_checked(sheet)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("as double") == 4  # one for each metric


def test_rows_are_staged_and_numbered_in_tasks_of_bounded_size(spark, facts, mart, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "SORT_ROWS", 20)
    staged = keys.stage_ordered(facts, str(tmp_path / "staged"))
    parts = staged.counts.select("part").distinct().count()
    assert parts > 3 and staged.rows.count() == facts.count()
    splits = []
    names = switch.file_names
    monkeypatch.setattr(switch, "file_names", lambda s, f: splits.append(s.conf.get(switch.SPLIT)) or names(s, f))
    before = spark.conf.get(switch.SPLIT)
    append_facts(facts, mart)
    state = switch.begin_load(spark, mart.raw)
    switch.write_dates(read_raw(spark, mart), state, RAW_COLUMNS)
    assert splits[-1] == str(switch.TASK_BYTES) and spark.conf.get(switch.SPLIT) == before
    # Files are counted by hash; min and max of their paths would be a sort.
    assert "SortAggregate" not in plan(keys.number_table(current_table(spark, mart.raw)))
