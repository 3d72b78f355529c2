"""Moves to the archive that are interrupted."""

import pytest

from searchmill import load_exports
from searchmill.sinks import archive as module
from searchmill.sinks.archive import MOVES, archive_exports, finish_moves
from tests.test_loads import D5, header, put, raw


def exports_in(folder):
    return sorted(p.name.split("_2")[0] for p in folder.iterdir() if p.suffix == ".xlsx")


@pytest.mark.parametrize("moved", [0, 2, 5])
def test_a_killed_run_is_finished_by_the_next(spark, mart, tmp_path, monkeypatch, moved):
    folder, archive = tmp_path / "in", tmp_path / "in" / "archive"
    folder.mkdir()
    for n in range(5):
        put(folder, f"{n} ä.xlsx", [header(D5), ["q", f"/{n}", n + 1, 1, 1, 1]], age=100 - n)
    plain, calls = module.move_file, []
    monkeypatch.setattr(module, "MOVERS", 1)

    def killed(*args):
        if len(calls) == moved:
            raise KeyboardInterrupt
        calls.append(args)
        plain(*args)

    with monkeypatch.context() as patch:
        patch.setattr(module, "move_file", killed)
        patch.setattr(module, "delete_folder", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            load_exports(spark, str(folder), mart, archive=str(archive))
    before = raw(spark, mart)
    assert len(exports_in(folder)) == 5 - moved and before
    put(folder, "new.xlsx", [header(D5), ["q", "/new", 9, 9, 9, 9]])
    report = load_exports(spark, str(folder), mart, archive=str(archive))
    assert report.exports == 1 and [r[2] for r in raw(spark, mart)] == ["/new"]
    assert exports_in(folder) == [] and len(exports_in(archive)) == 6
    assert not (archive / MOVES).exists() and finish_moves(spark, str(archive)) == 0


def test_moves_again_change_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    moved = archive_exports(spark, str(tmp_path), str(tmp_path / "done"), ["a.csv"])
    assert len(moved) == 1 and finish_moves(spark, str(tmp_path / "done")) == 0
    assert finish_moves(spark, str(tmp_path / "none")) == 0
