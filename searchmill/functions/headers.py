"""The header of an export sheet: dates and metrics live in its column names.

Everything here works on column names only and starts no Spark job.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from searchmill.schemas import SHEET_IDS, SHEET_METRICS

ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


class HeaderError(ValueError):
    """The sheet cannot be read as an export."""


@dataclass(frozen=True)
class DatedColumn:
    position: int
    name: str
    date: dt.date
    metric: str


@dataclass(frozen=True)
class Header:
    query: int
    page_path: int
    columns: tuple[DatedColumn, ...]

    @property
    def dates(self) -> list[dt.date]:
        return sorted({c.date for c in self.columns})

    def days(self) -> list[tuple[dt.date, dict[str, DatedColumn]]]:
        """Per date, the column of each known metric; other metrics are left out."""
        by_date: dict[dt.date, dict[str, DatedColumn]] = {d: {} for d in self.dates}
        for column in self.columns:
            if column.metric in SHEET_METRICS:
                by_date[column.date][SHEET_METRICS[column.metric]] = column
        return list(by_date.items())


def split_name(name: str) -> tuple[dt.date, str]:
    """`2026-06-05_shows` -> (date, 'shows'); a third part is ignored."""
    parts = name.split("_")
    if len(parts) < 2:
        raise HeaderError(f"column {name!r} is not named <YYYY-MM-DD>_<metric>")
    if not ISO_DATE.fullmatch(parts[0]):
        raise HeaderError(f"column {name!r} does not start with a YYYY-MM-DD date")
    try:
        return dt.date.fromisoformat(parts[0]), parts[1]
    except ValueError as error:
        raise HeaderError(f"column {name!r}: {error}") from None


def parse_header(
    columns: list[str | None], skip: tuple[str, ...] = (), where: str = "sheet"
) -> Header:
    """Check a header and locate its columns.

    `skip` names technical columns that are not part of the sheet. When two columns give
    the same date and metric, the first one counts. Raises HeaderError when `Query`, `Url`
    or one of the four metrics is missing, or when any other column is not dated.
    """
    ids: dict[str, int] = {}
    dated: dict[tuple[dt.date, str], DatedColumn] = {}
    try:
        for position, name in enumerate(columns):
            if name is None or name in skip:
                continue
            target = SHEET_IDS.get(name, name)
            if target in SHEET_IDS.values():
                ids.setdefault(target, position)
                continue
            date, metric = split_name(name)
            dated.setdefault((date, metric), DatedColumn(position, name, date, metric))
        missing = [old for old, new in SHEET_IDS.items() if new not in ids]
        present = {c.metric for c in dated.values()}
        missing += [m for m in SHEET_METRICS if m not in present]
        if missing:
            raise HeaderError(f"no column for {missing}")
    except HeaderError as error:
        raise HeaderError(f"{where}: {error}") from None
    return Header(ids["query"], ids["page_path"], tuple(dated.values()))
