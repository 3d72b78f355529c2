"""Moving processed exports out of the input folder."""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

from searchmill.sources.storage import (
    create_file,
    delete_folder,
    delete_if_empty,
    exists,
    file_names,
    first_line,
    move_file,
)

MOVERS = 16
MOVES = "_moves"


def archive_name(name: str, when: dt.datetime) -> str:
    """`week.xlsx` -> `week_20260605_134500.xlsx`."""
    stem, suffix = posixpath.splitext(name)
    return f"{stem}_{when:%Y%m%d_%H%M%S}{suffix}"


def archive_exports(spark: SparkSession, folder: str, archive: str, names: list[str]) -> list[str]:
    """Move the named exports from `folder` to `archive`, stamped with the time; new paths.

    The moves are listed in a file of the archive first, which goes when all are done: if the
    process ends in between, `finish_moves` carries out the rest.
    """
    when = dt.datetime.now()
    moves = []
    for name in sorted(names):
        plain = unquote(name)
        moves.append((f"{folder.rstrip('/')}/{plain}", f"{archive.rstrip('/')}/{archive_name(plain, when)}"))
    listed = f"{archive.rstrip('/')}/{MOVES}/{uuid.uuid4().hex}.json"
    create_file(spark, listed, json.dumps(moves))
    _move_all(spark, moves)
    delete_folder(spark, listed)
    delete_if_empty(spark, f"{archive.rstrip('/')}/{MOVES}")
    return [target for _, target in moves]


def finish_moves(spark: SparkSession, archive: str) -> int:
    """Carry out what an interrupted run had listed but not moved; the number of files moved.

    Moving again what was moved is no fault: a file that is no longer at its old place, or has
    one of its name at the new one, is left alone.
    """
    place, done = f"{archive.rstrip('/')}/{MOVES}", 0
    for name in file_names(spark, place):
        moves = json.loads(first_line(spark, f"{place}/{name}") or "[]")
        left = [(a, b) for a, b in moves if exists(spark, a) and not exists(spark, b)]
        _move_all(spark, left)
        delete_folder(spark, f"{place}/{name}")
        done += len(left)
    delete_if_empty(spark, place)
    return done


def _move_all(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda move: move_file(spark, *move), moves))
