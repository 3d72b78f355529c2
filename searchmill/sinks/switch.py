"""Replacing dates of a table all at once: new files beside the old ones, then a switch.

A write goes to a folder of its own, `<table>/_loads/<name>/dt=...`, which no partition points to.
Then a small log file, `<table>/_loads/<number>.json`, is created that says where the dates are
from now on: this is the moment at which the load counts. At last the partitions are pointed there by
`ALTER TABLE`. A failure before the log file leaves all old rows, one after it all new rows: whoever
reads or writes the table next through this library finishes the switch first.

Old files stay until the next load begins, so a query that is running during the switch reads on
in the old ones. The number of the log file is the load's claim: it is created only if it isn't there,
so of two loads that began from the same state the second one fails, with nothing changed.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from searchmill.schemas import NEVER_NULL, SQL_TYPES
from searchmill.sources.storage import (
    create_file,
    delete_folder,
    file_names,
    first_line,
)

logger = logging.getLogger(__name__)

LOADS = "_loads"
LOG = ".json"
DONE = ".done"
CLEAN = ".clean"

# Bytes of files that a task which writes dates reads at most: it sorts its rows by date.
TASK_BYTES = 32 << 20
SPLIT = "spark.sql.files.maxPartitionBytes"


class ConcurrentLoadError(RuntimeError):
    """Another load has changed the table since this one began; nothing was changed."""


@dataclass(frozen=True)
class State:
    """What the last log file says.

    `number` is the highest one taken, `current` that of the log file. `folders` has, for each date that
    was switched, the load its files are in; other dates are where Spark puts them. `new` and `gone` are
    the dates that the last load put in place and took out, `garbage` the folders it left behind.
    """

    place: str
    number: int = 0
    current: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    new: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()
    garbage: tuple[str, ...] = ()


def table_place(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{table} is no table with files of its own")
    return rows[0]["data_type"].rstrip("/")


def _state(spark: SparkSession, place: str) -> tuple[State, set[str]]:
    """The last state that is logged, and the names in the log folder.

    A log file that a failed load left unfinished doesn't count; its number is taken.
    """
    names = set(file_names(spark, f"{place}/{LOADS}"))
    numbers = sorted((int(n[: -len(LOG)]) for n in names if n.endswith(LOG)), reverse=True)
    for number in numbers:
        line = first_line(spark, f"{place}/{LOADS}/{number}{LOG}") or ""
        if line.endswith("}"):
            said = json.loads(line)
            lists = {k: tuple(said[k]) for k in ("new", "gone", "garbage")}
            return State(place, numbers[0], number, said["folders"], **lists), names
    return State(place, numbers[0] if numbers else 0), names


def finish_switch(spark: SparkSession, table: str) -> State:
    """The table's state, after a switch that was logged but not finished is carried out."""
    state, names = _state(spark, table_place(spark, table))
    if state.current and f"{state.current}{DONE}" not in names:
        logger.info("finishing load %d of %s", state.current, table)
        _point(spark, table, state)
    return state


def begin_load(spark: SparkSession, table: str) -> State:
    """The state that a load starts from; what the load before replaced is deleted."""
    state = finish_switch(spark, table)
    mark = f"{state.place}/{LOADS}/{state.current}{CLEAN}"
    if state.garbage and f"{state.current}{CLEAN}" not in file_names(spark, f"{state.place}/{LOADS}"):
        used = _dates_in_catalog(spark, table) - set(state.folders)
        for folder in state.garbage:
            if folder.removeprefix("dt=") not in used:  # a date that came back to its own folder
                delete_folder(spark, f"{state.place}/{folder}")
        create_file(spark, mark, "")
    return state


def write_dates(
    rows: DataFrame, state: State, columns: list[str], **counts
) -> tuple[str, list[dt.date], dict[str, int]]:
    """Write `rows` to a fresh folder of the table, a subfolder for each date.

    Returns its name, the dates, and the counts: `rows` and others given by name, observed
    while the rows are written.
    """
    spark = rows.sparkSession
    name = uuid.uuid4().hex
    folder = f"{state.place}/{LOADS}/{name}"
    seen = Observation()
    typed = [(_required(c) if c in NEVER_NULL else F.col(c)).cast(SQL_TYPES[c]).alias(c) for c in columns]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()])
    split = spark.conf.get(SPLIT)
    try:
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split) > TASK_BYTES:
            spark.conf.set(SPLIT, str(TASK_BYTES))
        rows.select(*typed).write.partitionBy("dt").parquet(folder)
        found = [n for n in file_names(spark, folder) if n.startswith("dt=")]
    except BaseException:
        delete_folder(spark, folder)
        raise
    finally:
        spark.conf.set(SPLIT, split)
    return name, sorted(dt.date.fromisoformat(n[3:]) for n in found), seen.get


def _required(column: str) -> Column:
    """A table checks its NOT NULL columns itself, a folder doesn't."""
    missing = F.raise_error(F.lit(f"{column} must not be null")).cast(SQL_TYPES[column])
    return F.when(F.col(column).isNull(), missing).otherwise(F.col(column))


def switch(
    spark: SparkSession, table: str, state: State, name: str, dates: list[dt.date], gone=()
) -> None:
    """Make the folder `name` the place of `dates`, and take the dates in `gone` out."""
    logged = commit(spark, table, state, name, dates, gone)
    _point(spark, table, logged)
    for old in {state.current, state.number} - {0}:  # the new file says it all
        for end in (LOG, DONE, CLEAN):
            delete_folder(spark, f"{state.place}/{LOADS}/{old}{end}")


def commit(
    spark: SparkSession, table: str, state: State, name: str, dates: list[dt.date], gone=()
) -> State:
    """Log the switch: from here on the load counts, whatever happens to this process."""
    new, gone = [d.isoformat() for d in dates], [d.isoformat() for d in gone]
    present = _dates_in_catalog(spark, table)
    garbage = [_folder(state, d) for d in [*new, *gone] if d in present]
    folders = {d: f for d, f in state.folders.items() if d not in set(gone)} | dict.fromkeys(new, name)
    number = state.number + 1
    log = f"{state.place}/{LOADS}/{number}{LOG}"
    line = json.dumps({"folders": folders, "new": new, "gone": gone, "garbage": garbage})
    claimed = create_file(spark, log, line)
    if not claimed or _state(spark, state.place)[0].number > number:
        if claimed:  # later loads have removed the file that took this number
            delete_folder(spark, log)
        if name:
            delete_folder(spark, f"{state.place}/{LOADS}/{name}")
        raise ConcurrentLoadError(f"another load has changed {table}, run this one again")
    return State(state.place, number, number, folders, tuple(new), tuple(gone), tuple(garbage))


def _folder(state: State, date: str) -> str:
    return f"{LOADS}/{state.folders[date]}/dt={date}" if date in state.folders else f"dt={date}"


def _point(spark: SparkSession, table: str, state: State) -> None:
    """Point the partitions of a logged state to its folders; doing it again changes nothing."""
    present = _dates_in_catalog(spark, table)

    def there(date: str) -> str:
        where = f"{state.place}/{_folder(state, date)}".replace("'", "\\'")
        return f"PARTITION (dt = DATE '{date}') LOCATION '{where}'"

    added = [d for d in state.new if d not in present]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(map(there, added))}")
    for date in state.new:
        if date in present:
            spark.sql(f"ALTER TABLE {table} {there(date).replace(' LOCATION ', ' SET LOCATION ')}")
    out = [d for d in state.gone if d in present]
    for date in out:
        # Dropping a partition deletes its folder; the old files go with the next load.
        empty = f"{state.place}/{LOADS}/empty/dt={date}"
        create_file(spark, f"{empty}/_none", "")
        empty = empty.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} PARTITION (dt = DATE '{date}') SET LOCATION '{empty}'")
    if out:
        parts = ", ".join(f"PARTITION (dt = DATE '{d}')" for d in out)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    create_file(spark, f"{state.place}/{LOADS}/{state.current}{DONE}", "")
    spark.catalog.refreshTable(table)


def dates_of(spark: SparkSession, table: str) -> list[dt.date]:
    """The dates that the table has partitions of: one row per calendar date."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(dt.date.fromisoformat(r["partition"].split("=", 1)[1]) for r in rows)


def _dates_in_catalog(spark: SparkSession, table: str) -> set[str]:
    return {d.isoformat() for d in dates_of(spark, table)}
