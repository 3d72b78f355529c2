"""Loads that fail before and after their switch, that meet each other, and that are read meanwhile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from searchmill import append_facts, refresh_clean, replace_by_date, seed_raw
from searchmill.schemas import RAW_COLUMNS
from searchmill.sinks import switch, tables
from searchmill.sinks.tables import delete_by_dates
from searchmill.sources.storage import file_names
from searchmill.sources.tables import read_clean, read_raw
from tests.test_tables import DAYS, facts


def rows(day, n, demand):
    return [(day, f"q{k}", "/", demand, 1, 1.0, 1) for k in range(n)]


def content(spark, mart):
    return sorted(tuple(r) for r in read_raw(spark, mart).collect())


def first_load(spark, mart):
    replace_by_date(facts(spark, [r for d in DAYS for r in rows(d, 3, 1)]), mart)
    return content(spark, mart)


def second(spark):
    return facts(spark, [r for d in DAYS[1:4] for r in rows(d, 2, 9)] + rows(dt.date(2026, 7, 1), 1, 9))


class Stopped(Exception):
    pass


def stop(*_, **__):
    raise Stopped


def test_failure_before_the_switch_keeps_all_old_rows(spark, mart, monkeypatch):
    before = first_load(spark, mart)
    clean = [refresh_clean(spark, mart).rows_inserted, sorted(map(tuple, read_clean(spark, mart).collect()))]
    monkeypatch.setattr(tables, "switch", stop)
    for load in (
        lambda: replace_by_date(second(spark), mart),
        lambda: refresh_clean(spark, mart),
        lambda: seed_raw(read_raw(spark, mart).withColumn("demand", F.lit(7)), mart),
        lambda: delete_by_dates(spark, DAYS[:2], mart),
    ):
        with pytest.raises(Stopped):
            load()
        assert content(spark, mart) == before
        assert [len(clean[1]), sorted(map(tuple, read_clean(spark, mart).collect()))] == clean


def test_a_failing_write_leaves_no_files(spark, mart):
    before = first_load(spark, mart)
    folder = f"{switch.table_place(spark, mart.raw)}/_loads"
    names = set(file_names(spark, folder))
    bad = F.when(F.col("id") % 3 == 0, F.raise_error(F.lit("broken")).cast("int")).otherwise(1)
    with pytest.raises(Exception, match="broken"):
        seed_raw(read_raw(spark, mart).withColumn("clicks", bad), mart)
    with pytest.raises(Exception, match="id must not be null"):
        seed_raw(read_raw(spark, mart).withColumn("id", F.when(F.col("id") > 4, F.col("id"))), mart)
    assert content(spark, mart) == before and set(file_names(spark, folder)) == names


@pytest.mark.parametrize("done", [0, 1, 2])
def test_failure_during_the_switch_shows_all_new_rows(spark, mart, monkeypatch, done):
    """The switch breaks off after none, one or two of its statements; the next reader ends it."""
    before = first_load(spark, mart)
    kept = [r for r in before if r[1] not in DAYS[1:4]]
    session = type(spark)
    plain, left = session.sql, [done]

    def sql(self, query, *args, **kwargs):
        if query.startswith("ALTER TABLE"):
            if not left[0]:
                raise Stopped
            left[0] -= 1
        return plain(self, query, *args, **kwargs)

    monkeypatch.setattr(session, "sql", sql)
    with pytest.raises(Stopped):
        replace_by_date(second(spark), mart)
    monkeypatch.undo()
    after = content(spark, mart)
    base = max(r[0] for r in kept)
    assert [r for r in after if r[1] not in DAYS[1:4] and r[1].month == 6] == kept
    assert sorted(r[0] for r in after) == sorted([r[0] for r in kept] + list(range(base + 1, base + 8)))
    assert {r[4] for r in after if r not in kept} == {9}
    replace_by_date(second(spark), mart)
    assert content(spark, mart) == after


def test_a_reader_sees_one_state(spark, mart):
    """A frame whose files are listed before the switch reads on in the old ones."""
    before = first_load(spark, mart)
    table = read_raw(spark, mart)
    old = table.inputFiles()
    replace_by_date(second(spark), mart)
    assert spark.read.parquet(*old).count() == len(before)
    new = content(spark, mart)
    replace_by_date(facts(spark, rows(DAYS[0], 1, 3)), mart)
    assert len(content(spark, mart)) == len(new) - 2
    place = switch.table_place(spark, mart.raw)
    gone = [f for f in old if not file_names(spark, f.rsplit("/", 1)[0])]
    assert len(gone) == 3 * len(old) // 5, place  # of the days that the load before had replaced


def test_the_second_of_two_loads_fails(spark, mart):
    first_load(spark, mart)
    states = [switch.begin_load(spark, mart.raw) for _ in range(3)]
    numbered = read_raw(spark, mart).where(F.col("dt") == DAYS[0])
    written = [switch.write_dates(numbered.withColumn("demand", F.lit(k)), s, RAW_COLUMNS) for k, s in enumerate(states)]
    switch.switch(spark, mart.raw, states[0], *written[0][:2])
    after = content(spark, mart)
    with pytest.raises(switch.ConcurrentLoadError):
        switch.switch(spark, mart.raw, states[1], *written[1][:2])
    for _ in range(2):
        replace_by_date(facts(spark, rows(DAYS[4], 3, 5)), mart)
    with pytest.raises(switch.ConcurrentLoadError):  # its number is free again by now
        switch.switch(spark, mart.raw, states[2], *written[2][:2])
    assert [r for r in content(spark, mart) if r[1] != DAYS[4]] == [r for r in after if r[1] != DAYS[4]]


def test_an_unfinished_log_file_does_not_count(spark, mart):
    before = first_load(spark, mart)
    state = switch.begin_load(spark, mart.raw)
    switch.create_file(spark, f"{state.place}/_loads/{state.number + 1}.json", '{"folders": {')
    assert content(spark, mart) == before
    replace_by_date(second(spark), mart)
    assert len(content(spark, mart)) == len(before) - 9 + 7


def test_dates_that_go_and_come_back(spark, mart):
    append_facts(facts(spark, [r for d in DAYS for r in rows(d, 2, 1)]), mart)
    replace_by_date(facts(spark, rows(DAYS[0], 1, 2)), mart)
    assert delete_by_dates(spark, DAYS[:2], mart) == 3
    assert {r[1] for r in content(spark, mart)} == set(DAYS[2:])
    append_facts(facts(spark, rows(DAYS[0], 1, 3) + rows(DAYS[1], 1, 3) + rows(DAYS[2], 1, 3)), mart)
    for _ in range(2):  # old folders are deleted, those of dates that came back are not
        replace_by_date(facts(spark, rows(DAYS[4], 1, 4)), mart)
    got = [(r[1], r[4]) for r in content(spark, mart)]
    want = [(DAYS[0], 3), (DAYS[1], 3), (DAYS[2], 1), (DAYS[2], 1), (DAYS[2], 3), (DAYS[3], 1), (DAYS[3], 1), (DAYS[4], 4)]
    assert sorted(got) == want
    assert seed_raw(read_raw(spark, mart).where(F.col("dt") > DAYS[2]), mart).dates == DAYS[3:]
    assert {r[1] for r in content(spark, mart)} == set(DAYS[3:])


def test_a_table_without_files_is_refused(spark, mart):
    read_raw(spark, mart).createOrReplaceTempView("not_a_table")
    with pytest.raises(ValueError, match="no table"):
        switch.table_place(spark, "not_a_table")
