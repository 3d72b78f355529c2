"""CSV dialect, headers of single exports, discovery, and writes that fail."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from searchmill import export_facts, ingest, load_exports, refresh_clean, seed_history
from searchmill.functions.headers import HeaderError
from searchmill.sinks.tables import append_facts
from searchmill.sources import heads
from searchmill.sources.discover import export_files
from searchmill.sources.tables import read_clean, read_raw
from tests.test_loads import D5, D6, D7, header, raw

HISTORY = "id,dt,page_path,query,demand,impressions,position,clicks\n"


def csv(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def test_quotes_and_backslashes_in_exports(spark, mart, tmp_path):
    lines = [
        '"buy ""red shoes"" online",/a,1,1,1.5,1',
        '"a, ""b"", c",/b,2,2,2.5,2',
        '"c:\\dir\\",/c,3,3,3.5,3',
        '5" tire,"/d,""x""",4,4,4.5,4',
        '"""",,5,5,,5',
    ]
    csv(tmp_path, "one.csv", "\ufeff" + ",".join(header(D5)) + "\r\n" + "\r\n".join(lines) + "\r\n")
    load_exports(spark, str(tmp_path), mart, fmt="csv")
    got = {(r.query, r.page_path, r.demand, r.position) for r in read_raw(spark, mart).collect()}
    assert got == {
        ('buy "red shoes" online', "/a", 1, 1.5),
        ('a, "b", c', "/b", 2, 2.5),
        ("c:\\dir\\", "/c", 3, 3.5),
        ('5" tire', '/d,"x"', 4, 4.5),
        ('"', None, 5, 0.0),
    }


@pytest.mark.parametrize(
    "row, message",
    [
        ("q,/a,5,4", "row shorter than the header of .*one.csv"),
        ("q2,/b", "row shorter than the header of .*one.csv"),
        ("q,/a,5,4,1.0,1,9", "row longer than the header of .*one.csv"),
        ('"two\nlines",/a,5,4,1.0,1', "quoted line break.*one.csv"),
    ],
)
def test_rows_that_do_not_fit_fail(spark, tmp_path, row, message):
    csv(tmp_path, "one.csv", ",".join(header(D5)) + "\nok,/a,1,1,1.0,1\n" + row + "\n")
    with pytest.raises(Exception, match=message):
        export_facts(spark, str(tmp_path), "csv").collect()


def test_quoted_line_breaks_if_allowed(spark, mart, tmp_path):
    csv(tmp_path, "one.csv", ",".join(header(D5)) + '\n"two\nlines, ""q""",/a,5,4,1.0,1\nq,/b,1,1,1.0,1\n')
    load_exports(spark, str(tmp_path), mart, fmt="csv", multi_line=True)
    assert {r.query for r in read_raw(spark, mart).collect()} == {'two\nlines, "q"', "q"}


def test_history_by_name_and_quotes(spark, mart, tmp_path):
    csv(
        tmp_path,
        "webm.csv",
        "dt,id,clicks,query,page_path,demand,extra,position,impressions\n"
        '2026-06-05,7,1,"buy ""red shoes"", online","c:\\dir\\",3,x,1.5,2\n',
    )
    seed_history(spark, str(tmp_path / "webm.csv"), mart)
    assert raw(spark, mart) == [(7, D5, "c:\\dir\\", 'buy "red shoes", online', 3, 2, 1.5, 1)]


@pytest.mark.parametrize("row", ["1,2026-06-05,/a,q,1,1,1.0", "1,2026-06-05,/a,q,1,1,1.0,1,1", "1,2026-06-05,/a,q,x,1,1.0,1", "1,05.06.2026,/a,q,1,1,1.0,1", '1,2026-06-05,"a\nb",q,1,1,1.0,1'])
def test_bad_history_leaves_the_table(spark, mart, tmp_path, row):
    csv(tmp_path, "good.csv", HISTORY + "7,2026-06-06,/a,q,1,1,1.0,1\n")
    seed_history(spark, str(tmp_path / "good.csv"), mart)
    before = raw(spark, mart)
    csv(tmp_path, "bad.csv", HISTORY + "8,2026-06-07,/a,q,1,1,1.0,1\n" + row + "\n")
    with pytest.raises(Exception):
        seed_history(spark, str(tmp_path / "bad.csv"), mart)
    assert raw(spark, mart) == before and len(before) == 1


def test_history_line_breaks_if_allowed(spark, mart, tmp_path):
    csv(tmp_path, "webm.csv", HISTORY + '1,2026-06-05,"a\nb",q,1,1,1.0,1\n')
    seed_history(spark, str(tmp_path / "webm.csv"), mart, multi_line=True)
    assert raw(spark, mart)[0][2] == "a\nb"


def test_failed_refresh_and_seed_leave_old_rows(spark, mart, monkeypatch):
    from searchmill.schemas import RAW_COLUMNS
    from searchmill.sinks import tables

    old = spark.createDataFrame(
        [(D5, "q", "/a", 1, 1, 1.0, 1), (D6, "q", "/a", 2, 2, 2.0, 2)],
        "dt date, query string, page_path string, demand int, impressions int, position double, clicks int",
    )
    append_facts(old, mart)
    refresh_clean(spark, mart)
    before = [tuple(r) for r in read_clean(spark, mart).orderBy("id").collect()]
    raw_before = raw(spark, mart)
    append_facts(old.withColumn("dt", F.lit(D7)), mart)

    def broken(facts):
        return facts.withColumn(
            "query", F.when(F.col("dt") == F.lit(D7), F.raise_error(F.lit("broken"))).otherwise(F.col("query"))
        )

    monkeypatch.setattr(tables, "clean_facts", broken)
    with pytest.raises(Exception, match="broken"):
        refresh_clean(spark, mart)
    assert [tuple(r) for r in read_clean(spark, mart).orderBy("id").collect()] == before
    monkeypatch.undo()
    raw_before = raw(spark, mart)
    with pytest.raises(Exception, match="broken"):
        tables.seed_raw(broken(read_raw(spark, mart)).select(*RAW_COLUMNS), mart)
    assert raw(spark, mart) == raw_before and len(raw_before) == 4
    # A refresh drops dates that left the raw table.
    tables.delete_by_dates(spark, [D5], mart)
    refresh_clean(spark, mart)
    assert {r.dt for r in read_clean(spark, mart).collect()} == {D6, D7}


def test_types_and_third_parts_of_parquet_exports(spark, mart, tmp_path):
    metrics = ("demand", "shows", "position", "clicks")
    for n, (suffix, kind) in enumerate((("", "float64"), ("", "int64"), ("_x", "int64"), ("_y", "int64"))):
        day = (D5, D5, D6, D6)[n]
        names = ["Query", "Url", *[f"{day}_{m}{suffix}" for m in metrics]]
        sheet = pd.DataFrame([[f"q{n}", "/", n + 1, 1, 1, 1]], columns=names)
        for c in names[2:]:
            sheet[c] = sheet[c].astype(kind)
        path = tmp_path / f"{n}.parquet"
        sheet.to_parquet(path, index=False)
        os.utime(path, (1_780_000_000 + n, 1_780_000_000 + n))
    facts = export_facts(spark, str(tmp_path), "parquet")
    assert {(r.query, r.dt, r.demand) for r in facts.collect()} == {
        ("q0", D5, 1), ("q1", D5, 2), ("q2", D6, 3), ("q3", D6, 4),
    }
    load_exports(spark, str(tmp_path), mart, fmt="parquet")
    assert [r[1:5] for r in raw(spark, mart)] == [(D5, "/", "q1", 2), (D6, "/", "q3", 4)]


@pytest.mark.parametrize("n_dates", [2, 300])
def test_each_parquet_export_needs_its_metrics(spark, tmp_path, n_dates):
    days = [D5 + dt.timedelta(days=k) for k in range(n_dates)]
    names = header(*days)
    pd.DataFrame([["q", "/", *[1.0] * (len(names) - 2)]], columns=names).to_parquet(tmp_path / "full.parquet")
    short = [c for c in header(D5) if not c.endswith("clicks")]
    pd.DataFrame([["q", "/", 1.0, 1.0, 1.0]], columns=short).to_parquet(tmp_path / "short.parquet")
    with pytest.raises(HeaderError, match="short.parquet.*clicks"):
        export_facts(spark, str(tmp_path), "parquet")


@pytest.mark.parametrize("schemes", [heads.TASK_SCHEMES, ()])
def test_discovery(spark, mart, tmp_path, monkeypatch, schemes):
    monkeypatch.setattr(heads, "TASK_SCHEMES", schemes)
    row = ",".join(header(D5)) + "\nq,/a,1,1,1.0,1\n"
    csv(tmp_path, "week 1 [x].csv", row)
    csv(tmp_path, "week.csv.bak", "not,an,export\n")
    csv(tmp_path / "old", "z.csv", row.replace("q,", "old,"))
    csv(tmp_path / "parts.csv", "part-0.csv", row.replace("q,", "part,"))
    csv(tmp_path, "webm.csv", HISTORY + "1,2026-06-05,/a,seed,1,1,1.0,1\n")
    for _ in range(2):  # `done` in the folder is no export of the second load
        names = {r.source_file for r in export_files(spark, str(tmp_path), "csv").collect()}
        assert names >= {"webm.csv"} and not names & {"week.csv.bak", "old", "done"}
        load_exports(spark, str(tmp_path), mart, fmt="csv", archive=str(tmp_path / "done"))
        assert {r.query for r in read_raw(spark, mart).collect()} <= {"q", "part"}
    assert (tmp_path / "webm.csv").exists() and len(os.listdir(tmp_path / "done")) == 2


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_stream_reads_no_blobs(spark, mart, tmp_path, fmt):
    folder = tmp_path / "in"
    folder.mkdir()
    for n, day in enumerate([D5, D6]):
        sheet = pd.DataFrame([["q" * 200, "/", n + 1, 1, 1.5, 1]], columns=header(day))
        path = folder / f"{n}.{fmt}"
        sheet.to_csv(path, index=False) if fmt == "csv" else sheet.to_parquet(path, index=False)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        ingest(spark, str(folder), str(tmp_path / "checkpoint"), mart, fmt=fmt).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert len(raw(spark, mart)) == 2


def test_csv_rows_are_not_exchanged(spark, tmp_path, monkeypatch):
    from searchmill.sources import wide
    from tests.test_plans import plan

    monkeypatch.setattr(wide, "SCAN_FILES", 0)
    for n in range(2):
        csv(tmp_path, f"{n}.csv", ",".join(header(D5)) + f"\nq{n},/a,1,1,1.0,1\n")
    text = plan(wide.read_wide_csv(spark, str(tmp_path)))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 4
