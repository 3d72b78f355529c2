"""Writes, ids and merging."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from searchmill import append_facts, refresh_clean, replace_by_date
from searchmill.operators import keys
from searchmill.operators.keys import highest_id
from searchmill.operators.quality import loaded_dates
from searchmill.schemas import FACT_COLUMNS, create_layers
from searchmill.sinks.tables import delete_by_dates
from searchmill.sources.tables import read_clean, read_raw

FACT_TYPES = "dt date, query string, page_path string, demand int, impressions int, position double, clicks int"
DAYS = [dt.date(2026, 6, d) for d in range(1, 6)]


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT_TYPES)


def random_rows(seed, n, days=DAYS):
    """Rows with null keys, copies, and one day that holds most of them."""
    pick = random.Random(seed)
    return [
        (
            pick.choice([days[0]] * 4 + days),
            pick.choice(["a", "b", None]),
            pick.choice(["/x?1", "/x", None]),
            pick.randrange(3),
            pick.randrange(3),
            pick.choice([0.5, 1.5]),
            pick.randrange(3),
        )
        for _ in range(n)
    ]


def sort_key(row):
    return [(v is not None, v) for v in row]


def raw(spark, mart):
    table = read_raw(spark, mart).select("id", *FACT_COLUMNS)
    return [tuple(r) for r in table.orderBy("id").collect()]


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_loads_equal_a_plain_model(spark, mart, monkeypatch, broadcast_rows):
    """Random loads against a list that is deleted from, sorted and numbered by hand."""
    monkeypatch.setattr(keys, "BROADCAST_ROWS", broadcast_rows)
    model = []
    for seed, days in enumerate([DAYS, DAYS[2:4], DAYS[1:3]]):
        rows = random_rows(seed, 200, days)
        report = replace_by_date(facts(spark, rows).repartition(3), mart)
        kept = [r for r in model if r[1] not in {x[0] for x in rows}]
        base = max((r[0] for r in kept), default=0)
        assert (report.rows_inserted, report.rows_deleted) == (200, len(model) - len(kept))
        model = kept + [(base + n, *r) for n, r in enumerate(sorted(rows, key=sort_key), 1)]
        assert raw(spark, mart) == sorted(model)
    refresh_clean(spark, mart)
    clean = read_clean(spark, mart)
    assert [r.id for r in clean.orderBy("id").collect()] == list(range(1, len(model) + 1))
    by_date = clean.groupBy("dt").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("dt").collect()
    assert all(x.b < y.a for x, y in zip(by_date, by_date[1:]))


def test_append_drops_id_and_needs_all_columns(spark, mart):
    rows = facts(spark, [(DAYS[0], "q", "/", 1, None, None, 1)]).withColumn("id", F.lit(99))
    for _ in range(2):
        append_facts(rows, mart)
    assert raw(spark, mart) == [(n, DAYS[0], "q", "/", 1, None, None, 1) for n in (1, 2)]
    with pytest.raises(ValueError, match="clicks"):
        append_facts(rows.drop("clicks"), mart)


def test_null_date_is_rejected(spark, mart):
    with pytest.raises(ValueError, match="dt must not be null"):
        replace_by_date(facts(spark, [(None, "q", "/", 1, 1, 1.0, 1)]), mart)
    assert raw(spark, mart) == []


def test_empty_frame_changes_nothing(spark, mart):
    append_facts(facts(spark, random_rows(1, 5)), mart)
    before = raw(spark, mart)
    assert replace_by_date(facts(spark, []), mart).dates == []
    assert raw(spark, mart) == before


def test_delete_and_list_dates(spark, mart):
    append_facts(facts(spark, [(d, "q", "/", 1, 1, 1.0, 1) for d in DAYS]), mart)
    assert delete_by_dates(spark, [DAYS[1], DAYS[3], dt.date(2020, 1, 1)], mart) == 2
    assert delete_by_dates(spark, [], mart) == 0
    listed = [r.date_str for r in loaded_dates(read_raw(spark, mart)).collect()]
    assert listed == ["2026-06-01", "2026-06-03", "2026-06-05"]


def test_reload_of_the_only_dates_starts_at_one(spark, mart):
    rows = facts(spark, [(DAYS[0], "q", "/", 1, 1, 1.0, 1)])
    for _ in range(2):
        replace_by_date(rows, mart)
    assert [r[0] for r in raw(spark, mart)] == [1]


@pytest.mark.parametrize("ids", [[], [1, 2, 3], [5, 900, 7], [1, 1, 1, 1], [-3, -2]])
def test_highest_id(spark, ids):
    table = spark.createDataFrame([(i,) for i in ids], "id bigint")
    assert highest_id(table) == max(ids, default=0)


def test_create_layers_twice_keeps_rows(spark, mart):
    append_facts(facts(spark, random_rows(2, 3)), mart)
    create_layers(spark, mart)
    assert len(raw(spark, mart)) == 3
