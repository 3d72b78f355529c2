"""Bad cells and rows beside the good ones."""

import pytest

from searchmill import load_exports, seed_history
from searchmill.sources.tables import read_raw
from tests.test_dialect import HISTORY, csv
from tests.test_loads import D5, D6, header, raw


def aside(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_csv_cells_and_rows(spark, mart, tmp_path):
    table = f"{mart.raw}_bad"
    head = ",".join(header(D5, D6))
    rows = [
        "a,/,1,1,1.0,1,2,2,2.0,2",
        "b,/,x,1,1.0,1,2,2,2.0,2",  # one day of two
        "c,/,1,1,1.0,1,3000000000,2,oops,2",
        "d,/,1,1,1.0",  # too short
        "d,/,1,1,1.0,1,2,2,2.0,2",  # still the first row of its query
        "d,/,1,1,1.0,1,2,2,2.0,2,9",  # too long
        "e,/,0,0,bad,0,0.5,0,1.0,0",  # wrong without traffic; the other day is empty
        "a,/,zz,zz,zz,zz,zz,zz,zz,zz",  # a repeated row doesn't count
        "f,/,NaN,1,1.0,1,,,,",
        '"g, ""h""",/,,5,,,,,,',
    ]
    csv(tmp_path, "it's.csv", "\n".join([head, *rows]) + "\n")
    with pytest.raises(Exception):
        load_exports(spark, str(tmp_path), mart, fmt="csv")
    assert raw(spark, mart) == []
    for _ in range(2):  # once more gives the same
        report = load_exports(spark, str(tmp_path), mart, fmt="csv", quarantine=table).write
        assert report.rows_set_aside == 6
        assert [r[1:4] + r[4:] for r in raw(spark, mart)] == [
            (D5, "/", "a", 1, 1, 1.0, 1), (D5, "/", "c", 1, 1, 1.0, 1), (D5, "/", "d", 1, 1, 1.0, 1),
            (D5, "/", 'g, "h"', 0, 5, 0.0, 0), (D6, "/", "a", 2, 2, 2.0, 2), (D6, "/", "b", 2, 2, 2.0, 2),
            (D6, "/", "d", 2, 2, 2.0, 2),
        ]
        got = [(r[0], r[1], r[3], r[5], r[7]) for r in sorted(spark.table(table).collect(), key=lambda r: (r.query, r.reason))]
        assert got == [
            ("2026-06-05", "b", "x", "1.0", "demand: 'x' is no number"),
            ("2026-06-06", "c", "3000000000", "oops", "demand: '3000000000' is beyond INT; position: 'oops' is no number"),
            (None, "d", None, None, "row longer than the header"),
            (None, "d", None, None, "row shorter than the header"),
            ("2026-06-05", "e", "0", "bad", "position: 'bad' is no number"),
            ("2026-06-05", "f", "NaN", "1.0", "demand: 'NaN' is beyond INT"),
        ]
        assert {r.source_file for r in spark.table(table).collect()} == {"it's.csv"}
    # A corrected export leaves nothing in quarantine.
    csv(tmp_path, "it's.csv", "\n".join([head, rows[0]]) + "\n")
    load_exports(spark, str(tmp_path), mart, fmt="csv", quarantine=table)
    assert aside(spark, table) == [] and read_raw(spark, mart).count() == 2


def test_history_rows(spark, mart, tmp_path):
    table = f"{mart.raw}_bad"
    rows = [
        "7,2026-06-06,/a,q,1,1,1.0,1",
        "8,2026-02-30,/a,q,1,1,1.0,1",
        "x9,2026-06-06,/a,q,1,3000000000,1.0,1",
        ",,/a,q,1,1,1.0,1",
        "10,2026-06-06,/a,q,1,1",
        "11,2026-06-05,/a,q,,,,",
    ]
    csv(tmp_path, "webm.csv", HISTORY + "\n".join(rows) + "\n")
    report = seed_history(spark, str(tmp_path / "webm.csv"), mart, quarantine=table)
    assert (report.rows_inserted, report.rows_set_aside) == (2, 4)
    assert [r[0] for r in raw(spark, mart)] == [7, 11]
    reasons = [r.reason for r in spark.table(table).orderBy("reason").collect()]
    assert reasons == sorted([
        "dt: '2026-02-30' is no date", "fields don't fit the header", "id: missing; dt: missing",
        "id: 'x9' is no BIGINT; impressions: '3000000000' is no INT",
    ])


def test_only_csv(spark, mart, tmp_path):
    with pytest.raises(ValueError, match="only CSV"):
        load_exports(spark, str(tmp_path), mart, fmt="parquet", quarantine="x.y")
