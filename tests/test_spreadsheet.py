"""The spreadsheet decoder, without Spark, and its use on a folder."""

import datetime as dt
import io
import zipfile

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from searchmill.functions.headers import HeaderError
from searchmill.sources import spreadsheet
from searchmill.sources.spreadsheet import first_sheet_rows
from workload.xlsx import column_letters, workbook

HEAD = ["Query", "Url"] + [f"2026-06-05_{m}" for m in ("demand", "shows", "position", "clicks")]
MTIME = pa.scalar(dt.datetime(2026, 6, 6, tzinfo=dt.timezone.utc), pa.timestamp("us", tz="UTC"))


def rows_of(content):
    return list(first_sheet_rows(zipfile.ZipFile(io.BytesIO(content))))


def decode(content, name="a.xlsx"):
    batches = spreadsheet._file_batches(name, MTIME, content)
    return [row for batch in batches for row in batch.to_pylist()]


def replace_part(content, **parts):
    """The workbook with some parts replaced (`__` stands for `/`, `_xml` for `.xml`)."""
    target = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(target, "w") as new:
        for name in old.namelist():
            key = name.replace("/", "__").replace(".xml", "_xml")
            new.writestr(name, parts.get(key, old.read(name)))
    return target.getvalue()


cell_values = st.one_of(
    st.none(),
    st.integers(-10**9, 10**9),
    st.floats(allow_nan=False, allow_infinity=False),
    st.text(st.characters(blacklist_categories=("Cs", "Cc")), min_size=1).filter(lambda s: s.strip() == s),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(cell_values, max_size=40), max_size=12), st.booleans())
def test_written_cells_come_back(rows, shared):
    expected = []
    for number, row in enumerate(rows, 1):
        text = [None if v is None else v if isinstance(v, str) else repr(v) for v in row]
        while text and text[-1] is None:
            text.pop()
        if text:
            expected.append((number, text))
    assert rows_of(workbook(rows, shared)) == expected


@pytest.mark.parametrize("index, letters", [(0, "A"), (25, "Z"), (26, "AA"), (701, "ZZ"), (702, "AAA")])
def test_column_letters(index, letters):
    assert column_letters(index) == letters
    assert spreadsheet._column_index(f"{letters}12", 0) == index


def test_cell_kinds():
    sheet = """<x:worksheet xmlns:x="urn:x"><x:sheetData><x:row>
      <x:c t="str"><x:f>A1</x:f><x:v>made</x:v></x:c><x:c t="b"><x:v>1</x:v></x:c>
      <x:c t="e"><x:v>#N/A</x:v></x:c><x:c r="F1"><x:v>2.5</x:v></x:c><x:c/>
      <x:c t="s"><x:v>0</x:v></x:c></x:row><x:row r="9"><x:c><x:v>7</x:v></x:c></x:row>
      </x:sheetData></x:worksheet>"""
    strings = """<sst xmlns="urn:x"><si><r><rPr><b/></rPr><t>two</t></r><r><t xml:space="preserve"> runs</t></r>
      <rPh sb="0" eb="1"><t>reading aid</t></rPh></si></sst>"""
    content = replace_part(workbook([["a"]]), xl__worksheets__sheet1_xml=sheet, xl__sharedStrings_xml=strings)
    assert rows_of(content) == [
        (1, ["made", "1", None, None, None, "2.5", None, "two runs"]),
        (9, ["7"]),
    ]


@pytest.mark.parametrize("part", ["worksheets/other.xml", "/xl/worksheets/abs.xml"])
def test_first_sheet_is_found_through_its_relation(part):
    content = workbook([["a"]], sheet_part=part.removeprefix("/xl/"))
    if part.startswith("/"):
        relations = zipfile.ZipFile(io.BytesIO(content)).read("xl/_rels/workbook.xml.rels").decode()
        relations = relations.replace('Target="worksheets', 'Target="/xl/worksheets')
        content = replace_part(content, **{"xl___rels__workbook_xml.rels": relations})
    assert rows_of(content) == [(1, ["a"])]


def test_rows_are_packed_by_day(monkeypatch):
    monkeypatch.setattr(spreadsheet, "BATCH_ROWS", 2)
    rows = [[f"q{n}", "/", n, None, 1.5, None] for n in range(5)] + [["empty", "/"]]
    got = decode(workbook([HEAD, *rows]))
    assert [r["query"] for r in got] == ["q0", "q1", "q2", "q3", "q4", "empty"]
    assert [r["row_no"] for r in got] == [2, 3, 4, 5, 6, 7]
    day = {"dt": dt.date(2026, 6, 5), "demand": 3.0, "impressions": None, "position": 1.5, "clicks": None}
    assert got[3]["days"] == [day] and got[5]["days"] == []


def test_numbers_as_query_and_text_as_number():
    got = decode(workbook([HEAD, [2024, "/", "12", " 7 ", "", 0]]))
    assert got[0]["query"] == "2024"
    assert (got[0]["days"][0]["demand"], got[0]["days"][0]["impressions"]) == (12.0, 7.0)


def test_bad_sheets_are_named():
    with pytest.raises(ValueError, match=r"a.xlsx: row 2, 2026-06-05: 'n/a'"):
        decode(workbook([HEAD, ["q", "/", "n/a"]]))
    with pytest.raises(HeaderError, match="a.xlsx: row 2 has a value in a column without a name"):
        decode(workbook([HEAD, ["q", "/", 1, 1, 1, 1, 5]]))
    with pytest.raises(HeaderError, match="a.xlsx: no column for"):
        decode(workbook([["Query", "Url"], ["q", "/"]]))
    assert decode(workbook([])) == []


def test_folder_ignores_other_files(spark, tmp_path):
    from searchmill.sources.discover import export_files, exports, warn_legacy_files
    from searchmill.sources.spreadsheet import read_spreadsheets

    (tmp_path / "a.xlsx").write_bytes(workbook([HEAD, ["q", "/", 1, 2, 3, 4]]))
    (tmp_path / "~$a.xlsx").write_bytes(b"lock")
    (tmp_path / "old.xls").write_bytes(b"binary")
    (tmp_path / "webm.csv").write_text("id\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.xlsx").write_bytes(workbook([HEAD, ["r", "/", 1, 2, 3, 4]]))
    found = exports(export_files(spark, str(tmp_path))).collect()
    assert [(r.source_file, r.files) for r in found] == [("a.xlsx", 1)]
    assert warn_legacy_files(spark, str(tmp_path)) == ["old.xls"]
    assert [r.query for r in read_spreadsheets(spark, str(tmp_path)).collect()] == ["q"]
    with pytest.raises(ValueError, match="unknown export format"):
        export_files(spark, str(tmp_path), "ods")
