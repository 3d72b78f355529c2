"""Incremental load of a folder."""

import os

import pandas as pd
import pytest

from searchmill import ingest, load_exports
from searchmill.sources.tables import read_raw
from tests.test_loads import D5, D6, D7, header, put, raw


def advance(spark, folder, checkpoint, mart, **options):
    query = ingest(spark, str(folder), str(checkpoint), mart, **options)
    query.awaitTermination()
    return raw(spark, mart)


def test_new_files_once_in_order(spark, mart, tmp_path):
    folder, checkpoint = tmp_path / "in", tmp_path / "checkpoint"
    folder.mkdir()
    put(folder, "b.xlsx", [header(D5, D6), ["q", "/", 1, 1, 1, 1, 2, 2, 2, 2]], age=50)
    put(folder, "a.xlsx", [header(D6, D7), ["q", "/", 8, 8, 8, 8, 9, 9, 9, 9]], age=10)
    (folder / "~$a.xlsx").write_bytes(b"lock")
    loaded = advance(spark, folder, checkpoint, mart)
    assert loaded == [
        (1, D5, "/", "q", 1, 1, 1.0, 1),
        (2, D6, "/", "q", 8, 8, 8.0, 8),
        (3, D7, "/", "q", 9, 9, 9.0, 9),
    ]
    # Nothing new: nothing happens. A known name with new content is not new either.
    put(folder, "a.xlsx", [header(D6), ["q", "/", 5, 5, 5, 5]])
    assert advance(spark, folder, checkpoint, mart) == loaded
    # A late file for an old date replaces that date.
    put(folder, "late.xlsx", [header(D5), ["z", "/", 7, 7, 7, 7]])
    assert advance(spark, folder, checkpoint, mart) == [
        *loaded[1:], (4, D5, "/", "z", 7, 7, 7.0, 7),
    ]


def test_stream_equals_batch(spark, mart, tmp_path):
    from searchmill import Mart, create_layers

    folder = tmp_path / "in"
    folder.mkdir()
    for n, day in enumerate([D5, D6, D5, D7]):
        put(folder, f"{n}.xlsx", [header(day, D7), ["q", f"/{n}", 1, 1, 1, 1, n, 0, 0, 0]], age=100 - n)
    streamed = advance(spark, folder, tmp_path / "checkpoint", mart, files_per_batch=3)
    other = Mart(mart.raw + "_b", mart.clean + "_b")
    create_layers(spark, other)
    load_exports(spark, str(folder), other)
    strip = lambda rows: sorted(r[1:] for r in rows)
    assert strip(streamed) == strip(raw(spark, other))


def test_archive(spark, mart, tmp_path):
    folder, archive = tmp_path / "in", tmp_path / "archive"
    folder.mkdir()
    for n in range(3):
        put(folder, f"{n}.xlsx", [header(D5), ["q", "/", n + 1, 1, 1, 1]], age=100 - n)
    advance(spark, folder, tmp_path / "checkpoint", mart, archive=str(archive))
    moved = {name for _, _, names in os.walk(archive) for name in names if name.endswith(".xlsx")}
    # Spark archives a file while later batches run, so the last one may still be there.
    assert moved | {p.name for p in folder.iterdir()} >= {"0.xlsx", "1.xlsx", "2.xlsx"}
    assert "0.xlsx" in moved
    assert read_raw(spark, mart).first().demand == 3


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_native_formats(spark, mart, tmp_path, fmt):
    folder = tmp_path / "in [x]"
    folder.mkdir()
    for n, day in enumerate([D5, D6, D5]):
        sheet = pd.DataFrame([["q", "/", n + 1, 1, 1.5, 1]], columns=header(day))
        path = folder / f"{n} {{a}}.{fmt}"
        sheet.to_csv(path, index=False) if fmt == "csv" else sheet.to_parquet(path, index=False)
        os.utime(path, (1_780_000_000 + n, 1_780_000_000 + n))
    loaded = advance(spark, folder, tmp_path / "checkpoint", mart, fmt=fmt, files_per_batch=2)
    assert [r[1:] for r in loaded] == [(D6, "/", "q", 2, 1, 1.5, 1), (D5, "/", "q", 3, 1, 1.5, 1)]


def test_corrected_exports_keep_their_names(spark, mart, tmp_path):
    folder, checkpoint, archive = tmp_path / "in", tmp_path / "checkpoint", tmp_path / "archive"
    folder.mkdir()
    go = lambda **more: advance(spark, folder, checkpoint, mart, corrected=True, **more)
    put(folder, "a.xlsx", [header(D5, D6), ["q", "/", 1, 1, 1, 1, 2, 2, 2, 2]], age=50)
    put(folder, "b.xlsx", [header(D7), ["q", "/", 3, 3, 3, 3]], age=40)
    loaded = go()
    assert [r[0] for r in loaded] == [1, 2, 3] and go() == loaded
    # A new time and content; an older one copied over it counts as well; the order is by time.
    put(folder, "a.xlsx", [header(D5), ["q", "/", 8, 8, 8, 8]], age=30)
    put(folder, "b.xlsx", [header(D5, D7), ["q", "/", 5, 5, 5, 5, 6, 6, 6, 6]], age=45)
    assert go() == [(2, D6, "/", "q", 2, 2, 2.0, 2), (4, D7, "/", "q", 6, 6, 6.0, 6), (5, D5, "/", "q", 8, 8, 8.0, 8)]
    put(folder, "a.xlsx", [header(D5), ["q", "/", 9, 9, 9, 9]], age=20)
    assert go(archive=str(archive))[-1][4] == 9
    put(folder, "a.xlsx", [header(D5), ["q", "/", 7, 7, 7, 7]], age=10)
    assert go(archive=str(archive))[-1][4] == 7
    assert sorted(p.name[:2] for p in archive.iterdir() if p.suffix == ".xlsx") == ["a.", "a_"]
    assert [p.name for p in folder.iterdir() if p.suffix == ".xlsx"] == ["b.xlsx"]


@pytest.mark.parametrize("where", ["load", "archive"])
def test_restart_in_the_middle_of_a_batch(spark, mart, tmp_path, monkeypatch, where):
    from searchmill import Mart, create_layers
    from searchmill.streaming import ingest as module

    folder, archive = tmp_path / "in", tmp_path / "archive"
    other = Mart(mart.raw + "_b", mart.clean + "_b")
    create_layers(spark, other)

    def files(where):
        where.mkdir()
        for n, day in enumerate([D5, D6, D5, D7]):
            put(where, f"{n}.xlsx", [header(day, D7), ["q", f"/{n}", 1, 1, 1, 1, n, 0, 0, 0]], age=100 - n)

    files(folder)
    files(tmp_path / "plain")
    want = advance(spark, tmp_path / "plain", tmp_path / "c", other, corrected=True)
    want = raw(spark, other)
    calls = []
    name = "replace_by_date" if where == "load" else "move_file"
    plain = getattr(module, name)

    def fails_once(*args, **kwargs):
        calls.append(1)
        result = plain(*args, **kwargs)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return result

    monkeypatch.setattr(module, name, fails_once)
    options = {"archive": str(archive), "corrected": True}
    with pytest.raises(Exception, match="killed"):
        advance(spark, folder, tmp_path / "checkpoint", mart, **options)
    assert advance(spark, folder, tmp_path / "checkpoint", mart, **options) == want
    assert len([p for p in archive.iterdir() if p.suffix == ".xlsx"]) == 4
