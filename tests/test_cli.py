import re

from searchmill.__main__ import main
from searchmill.sources.tables import read_clean
from tests.test_loads import D5, D6, header, put, raw


def test_jobs(spark, mart, tmp_path, capsys):
    names = ["--raw", mart.raw, "--clean", mart.clean]
    folder = tmp_path / "in"
    folder.mkdir()
    main([*names, "create"])
    put(folder, "a.xlsx", [header(D5), ["q", "/a?x", 1, 2, 3, 4]])
    main([*names, "preview", str(folder)])
    assert "/a?x" in capsys.readouterr().out and raw(spark, mart) == []
    main([*names, "run", str(folder), "--archive", str(tmp_path / "done")])
    assert "1 exports, 1 dates (2026-06-05 to 2026-06-05), 0 rows replaced by 1" in capsys.readouterr().out
    assert [tuple(r) for r in read_clean(spark, mart).collect()] == [(1, D5, "q", "/a", 2, 2, 3.0, 2)]
    put(folder, "b.xlsx", [header(D6), ["q", "/b", 1, 2, 3, 4]])
    main([*names, "ingest", str(folder), "--checkpoint", str(tmp_path / "state")])
    main([*names, "dates"])
    assert re.findall(r"^2026.*$", capsys.readouterr().out, re.M) == ["2026-06-05", "2026-06-06"]
    main([*names, "refresh"])
    assert "rows_inserted=2" in capsys.readouterr().out
    history = tmp_path / "webm.csv"
    history.write_text("id,dt,page_path,query,demand,impressions,position,clicks\n5,2026-06-05,/,q,1,1,1,1\n")
    main([*names, "seed", str(history)])
    assert raw(spark, mart) == [(5, D5, "/", "q", 1, 1, 1.0, 1)]
