import datetime as dt

import pytest

from searchmill.functions.headers import HeaderError, parse_header

METRICS = ("demand", "shows", "position", "clicks")


def header(*extra, ids=("Query", "Url")):
    return [*ids, *[f"2026-06-05_{m}" for m in METRICS], *extra]


def test_locates_columns():
    found = parse_header(header("2026-06-06_shows", "2026-06-05_ctr"))
    assert (found.query, found.page_path) == (0, 1)
    assert found.dates == [dt.date(2026, 6, 5), dt.date(2026, 6, 6)]
    days = dict(found.days())
    assert {m: c.position for m, c in days[dt.date(2026, 6, 5)].items()} == {
        "demand": 2, "impressions": 3, "position": 4, "clicks": 5,
    }
    assert list(days[dt.date(2026, 6, 6)]) == ["impressions"]


def test_first_of_two_columns_for_one_metric_counts():
    found = parse_header(header("2026-06-05_demand_copy", "2026-06-06_demand_old", "2026-06-06_demand"))
    days = dict(found.days())
    assert days[dt.date(2026, 6, 5)]["demand"].position == 2
    assert days[dt.date(2026, 6, 6)]["demand"].name == "2026-06-06_demand_old"


def test_renamed_ids_and_technical_columns():
    found = parse_header(["source_file", *header(ids=("query", "page_path"))], skip=("source_file",))
    assert (found.query, found.page_path) == (1, 2)


@pytest.mark.parametrize(
    "columns, message",
    [
        (header("Total"), "'Total'"),
        (header("2026-6-5_demand"), "'2026-6-5_demand'"),
        (header("2026-13-05_demand"), "'2026-13-05_demand'"),
        (header(ids=("Query", "query")), "Url"),
        (header()[:-1], "clicks"),
        ([], "Query"),
    ],
)
def test_rejects(columns, message):
    with pytest.raises(HeaderError, match=message):
        parse_header(columns, where="a.xlsx")
