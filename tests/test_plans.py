"""The plans that make the jobs scale."""

import re

import pytest
from pyspark.sql import functions as F

from searchmill.operators.keys import number_table
from searchmill.operators.quality import clean_facts, loaded_dates
from searchmill.operators.reshape import pivot_first, split_header, unpivot_cells, wide_to_facts
from searchmill.sources.tables import read_raw
from searchmill.sources.wide import read_wide_parquet

HEAD = "Query string, Url string, " + ", ".join(
    f"`2026-06-0{d}_{m}` double" for d in (5, 6) for m in ("demand", "shows", "position", "clicks")
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan(df)))


@pytest.fixture
def wide(spark, tmp_path):
    rows = spark.createDataFrame([("q", "/", *[1.0] * 8)], HEAD)
    rows.write.parquet(str(tmp_path / "in" / "a.parquet"))
    return read_wide_parquet(spark, str(tmp_path / "in"))


def test_unique_sheet_needs_no_exchange(wide):
    facts = wide_to_facts(wide, unique_rows=True)
    assert exchanges(facts) == 0 and "Python" not in plan(facts)


def test_repeated_rows_are_limited_before_one_exchange(wide):
    facts = wide_to_facts(wide)
    text = plan(facts)
    assert exchanges(facts) == 1
    partial = text.rindex("WindowGroupLimit")
    assert text.index("Exchange hashpartitioning") < partial, text


def test_pivot_combines_before_one_exchange(wide):
    # A spreadsheet's row number is a long, so the buffers fit a hash aggregate.
    cells = unpivot_cells(wide.withColumn("row_no", F.monotonically_increasing_id()))
    facts = pivot_first(split_header(cells))
    text = plan(facts)
    assert exchanges(facts) == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_scan_reads_only_what_is_used(wide):
    days = wide_to_facts(wide, unique_rows=True).groupBy("dt").agg(F.sum("clicks"))
    schema = re.search(r"ReadSchema: (.*)", plan(days)).group(1)
    assert "2026-06-05_demand" in schema and "Query" not in schema and "Url" not in schema


def test_refresh_is_map_side(spark, mart):
    numbered = clean_facts(number_table(spark.table(mart.raw)))
    text = plan(numbered)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Python" not in text


def test_dates_prune_partitions(spark, mart):
    rows = read_raw(spark, mart).where("dt = date'2026-06-05'")
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ = 2026-06-05", plan(rows))
    schema = re.search(r"ReadSchema: (.*)", plan(loaded_dates(read_raw(spark, mart)))).group(1)
    assert schema.strip() == "struct<>"
