"""Which exports are new: small numbered files, one a batch, that a stream can follow.

Spark's file stream knows files by their path, so it misses a corrected export under its old name,
and it takes files by their time, so it could take a copied old one before its turn. Here the
folder is listed by Spark, compared with what was announced before, and what is new or has
changed is announced: `<checkpoint>/announced/<number>.json` names up to so many exports, the
oldest first. Announcements are never changed; their modification time is their number, by which
the stream keeps them in order.
"""

from __future__ import annotations

import json
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchmill.sources.discover import export_files, exports
from searchmill.sources.storage import create_file, file_names, literal, set_time

ANNOUNCED = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("mtime", T.LongType()),  # microseconds
        T.StructField("length", T.LongType()),
    ]
)


def announced_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/announced"


def unannounced(
    spark: SparkSession, folder: str, checkpoint: str, fmt: str, corrected: bool
) -> DataFrame:
    """(source_file, mtime, length) of the exports that weren't announced yet; with `corrected` also
    of those whose time or length is another now."""
    found = exports(export_files(spark, folder, fmt)).select(
        "source_file", F.unix_micros("mtime").alias("mtime"), "length"
    )
    place = announced_folder(checkpoint)
    if not file_names(spark, place):
        return found
    known = spark.read.schema(ANNOUNCED).json(literal(place))
    keys = ANNOUNCED.names if corrected else ["source_file"]
    return found.join(known.select(*keys).distinct(), keys, "left_anti")


def announce(
    spark: SparkSession, folder: str, checkpoint: str, fmt: str, per_batch: int, corrected: bool = False
) -> int:
    """Announce what is new, `per_batch` exports at a time; how many announcements were added."""
    place = announced_folder(checkpoint)
    numbers = [int(n.split(".")[0]) for n in file_names(spark, place) if n.endswith(".json")]
    number = first = max(numbers, default=0) + 1
    new = unannounced(spark, folder, checkpoint, fmt, corrected).orderBy("mtime", "source_file")
    # Sorted by Spark, and fetched a partition at a time: names only.
    for some in batched(new.toLocalIterator(), per_batch):
        path = f"{place}/{number}.json"
        if not create_file(spark, path, "\n".join(json.dumps(r.asDict()) for r in some)):
            raise RuntimeError(f"{path} is there already: another ingest uses this checkpoint")
        set_time(spark, path, number * 1000)
        number += 1
    return number - first
