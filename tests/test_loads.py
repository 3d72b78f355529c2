"""Raw load, cleaned refresh and seed on small hand-made exports."""

import datetime as dt
import os

import pytest

from searchmill import load_exports, refresh_clean, run, seed_history
from searchmill.sources import wide as wide_sources
from searchmill.sources.tables import read_clean, read_raw
from workload.xlsx import workbook

D5, D6, D7 = (dt.date(2026, 6, d) for d in (5, 6, 7))
HEAD = ["Query", "Url"]


def header(*days):
    return HEAD + [f"{d}_{m}" for d in days for m in ("demand", "shows", "position", "clicks")]


def put(folder, name, rows, age=0, **kwargs):
    path = folder / name
    path.write_bytes(workbook(rows, **kwargs))
    os.utime(path, (1_780_000_000 - age, 1_780_000_000 - age))


def raw(spark, mart):
    return [tuple(r) for r in read_raw(spark, mart).orderBy("id").collect()]


def test_spreadsheet_load_and_refresh(spark, mart, tmp_path):
    folder = tmp_path / "in [dir] 1"
    folder.mkdir()
    put(folder, "a b+c.xlsx", [
        header(D5, D6),
        ["шины", "/p?x=1", 5, 9, 3.5, 20, None, None, None, None],
        ["шины", "/p?x=1", 50, 90, 1.5, 2, 1, 1, 1.0, 1],
        [None, "/q", 0, 0, 4.0, 0, 2.9, 1, None, None],
    ])
    report = load_exports(spark, str(folder), mart, archive=str(tmp_path / "out"))
    assert raw(spark, mart) == [
        (1, D5, "/p?x=1", "шины", 5, 9, 3.5, 20),
        (2, D6, "/q", None, 2, 1, 0.0, 0),
    ]
    assert report.exports == 1 and report.write.rows_inserted == 2
    assert not list(folder.iterdir())
    [moved] = os.listdir(tmp_path / "out")
    assert moved.startswith("a b+c_20") and moved.endswith(".xlsx")
    refresh_clean(spark, mart)
    assert [tuple(r) for r in read_clean(spark, mart).orderBy("id").collect()] == [
        (1, D5, "шины", "/p", 9, 9, 3.5, 9),
        (2, D6, None, "/q", 2, 1, 0.0, 0),
    ]


def test_latest_export_wins_each_date(spark, mart, tmp_path):
    put(tmp_path, "old.xlsx", [header(D5, D6), ["a", "/", 1, 1, 1, 1, 1, 1, 1, 1], ["b", "/", 1, 1, 1, 1, 1, 1, 1, 1]], age=100)
    put(tmp_path, "new.xlsx", [header(D6, D7), ["a", "/", 7, 7, 7, 7, 0, 0, 3, 0]], shared=False)
    run(spark, str(tmp_path), mart)
    assert raw(spark, mart) == [
        (1, D5, "/", "a", 1, 1, 1.0, 1),
        (2, D5, "/", "b", 1, 1, 1.0, 1),
        (3, D6, "/", "a", 7, 7, 7.0, 7),
    ]


def test_reload_replaces_only_its_dates(spark, mart, tmp_path):
    first, second = tmp_path / "1", tmp_path / "2"
    first.mkdir(), second.mkdir()
    put(first, "a.xlsx", [header(D5, D6, D7), ["a", "/", 1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3]])
    put(second, "b.xlsx", [header(D5, D6), ["z", "/", 0, 0, 9, 0, 8, 8, 8, 8], ["y", "/", 0, 0, 9, 0, 8, 8, 8, 8]])
    load_exports(spark, str(first), mart)
    expected = [
        (1, D5, "/", "a", 1, 1, 1.0, 1),
        (3, D7, "/", "a", 3, 3, 3.0, 3),
        (4, D6, "/", "y", 8, 8, 8.0, 8),
        (5, D6, "/", "z", 8, 8, 8.0, 8),
    ]
    for _ in range(2):
        report = load_exports(spark, str(second), mart)
        assert raw(spark, mart) == expected
    assert report.write.rows_deleted == 2 and report.write.dates == [D6]


def test_empty_and_missing_folders(spark, mart, tmp_path):
    (tmp_path / "empty").mkdir()
    assert load_exports(spark, str(tmp_path / "empty"), mart).exports == 0
    with pytest.raises(FileNotFoundError):
        load_exports(spark, str(tmp_path / "nowhere"), mart)
    put(tmp_path / "empty", "zero.xlsx", [header(D5), ["a", "/", 0, 0, 2.0, 0]])
    report = load_exports(spark, str(tmp_path / "empty"), mart, archive=str(tmp_path / "out"))
    assert report.write.rows_inserted == 0 and not report.archived
    assert raw(spark, mart) == []
    assert (tmp_path / "empty" / "zero.xlsx").exists()


@pytest.mark.parametrize("scan_files", [0, 4_000_000])
def test_csv_folder_with_different_headers(spark, mart, tmp_path, monkeypatch, scan_files):
    monkeypatch.setattr(wide_sources, "SCAN_FILES", scan_files)
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "one.csv").write_text(",".join(header(D5)) + "\nq,/a?1,5,5,5.5,5\n\"q, r\",,1,,,\n", "utf-8")
    (folder / "two 2+.csv").write_text(
        "Url," + ",".join(header(D6, D7)[2:]) + ",Query,2026-06-07_ctr\n/a,7,7,7,7,,3,,,q,0.5\n/a,8,8,8,8,,8,,,q,0.5\n", "utf-8"
    )
    load_exports(spark, str(folder), mart, fmt="csv")
    assert raw(spark, mart) == [
        (1, D5, "/a?1", "q", 5, 5, 5.5, 5),
        (2, D5, None, "q, r", 1, 0, 0.0, 0),
        (3, D6, "/a", "q", 7, 7, 7.0, 7),
        (4, D7, "/a", "q", 0, 3, 0.0, 0),
    ]


def test_csv_row_longer_than_header_fails(spark, tmp_path):
    from searchmill import export_facts

    (tmp_path / "one.csv").write_text(",".join(header(D5)) + "\nq,/a,5,5,5.5,5,6\n", "utf-8")
    with pytest.raises(Exception, match="row longer than the header"):
        export_facts(spark, str(tmp_path), "csv").collect()


@pytest.mark.parametrize("scan_dates", [1, 200])
def test_parquet_exports_may_be_folders(spark, mart, tmp_path, monkeypatch, scan_dates):
    monkeypatch.setattr(wide_sources, "SCAN_DATES", scan_dates)
    folder = tmp_path / "pq"
    wide = spark.createDataFrame([("a", "/", 1, 2, 3.0, 4), ("b", "/", 1, 2, 3.0, 4)] , header(D5))
    wide.repartition(2, "Query").write.parquet(str(folder / "one.parquet"))
    spark.createDataFrame([("a", "/", 5, 6, 7.0, 8)], header(D6)).write.parquet(str(folder / "two [1] 50%.parquet"))
    report = load_exports(spark, str(folder), mart, fmt="parquet", archive=str(tmp_path / "out"))
    assert report.exports == 2 and len(os.listdir(tmp_path / "out")) == 2 and not os.listdir(folder)
    assert raw(spark, mart) == [
        (1, D5, "/", "a", 1, 2, 3.0, 4),
        (2, D5, "/", "b", 1, 2, 3.0, 4),
        (3, D6, "/", "a", 5, 6, 7.0, 8),
    ]


def test_history_seed_keeps_ids(spark, mart, tmp_path):
    path = tmp_path / "webm.csv"
    path.write_text(
        "id,dt,page_path,query,demand,impressions,position,clicks\n"
        "7,2026-06-05,/a?x=1,q,,3,1.5,9\n40,2026-06-06,,r,1,2,,0\n"
    )
    seed_history(spark, str(path), mart)
    assert raw(spark, mart) == [
        (7, D5, "/a?x=1", "q", None, 3, 1.5, 9),
        (40, D6, None, "r", 1, 2, None, 0),
    ]
    refresh_clean(spark, mart)
    assert [tuple(r) for r in read_clean(spark, mart).orderBy("id").collect()] == [
        (1, D5, "q", "/a", None, 3, 1.5, 3),
        (2, D6, "r", None, 2, 2, None, 0),
    ]
    path.write_text("id,dt,page_path,query,demand,impressions,position,clicks\n")
    seed_history(spark, str(path), mart)
    assert raw(spark, mart) == []
    refresh_clean(spark, mart)
    assert read_clean(spark, mart).count() == 0
