"""Incremental raw load: a stream over the exports that are new in a folder."""

from __future__ import annotations

import datetime as dt
import logging
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from searchmill.plans.load import export_facts
from searchmill.schemas import Mart
from searchmill.sinks.archive import archive_name
from searchmill.sinks.tables import replace_by_date
from searchmill.sources.storage import create_file, exists, literal, move_file, require_folder
from searchmill.streaming.announce import ANNOUNCED, announce, announced_folder

logger = logging.getLogger(__name__)

# Spark skips files this much older than the newest one seen; announcements are never too old.
MAX_FILE_AGE = "36500d"


def ingest(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    mart: Mart = Mart(),
    fmt: str = "xlsx",
    archive: str | None = None,
    files_per_batch: int = 1,
    corrected: bool = False,
) -> StreamingQuery:
    """Load the exports that are new in `folder`, oldest first, then stop.

    One export per batch is the order of loading them by hand; larger batches give the same
    rows because the latest export wins each date. The checkpoint records what was loaded. An
    export counts as new by its name; with `corrected` also if its time or length has changed, so
    a corrected export may keep its name. A batch that runs again after a failure rewrites the
    same dates with the same rows and ids. No state is kept, so a late file for an old date simply
    replaces that date.

    With `archive`, an export is moved there when its batch is loaded. An export that is no longer
    there when its turn comes (a batch that runs again may have moved it) is skipped.
    """
    require_folder(spark, folder)
    place = announced_folder(checkpoint)
    create_file(spark, f"{place}/_announced", "")
    announce(spark, folder, checkpoint, fmt, files_per_batch, corrected)
    files = (
        spark.readStream.schema(ANNOUNCED)
        .option("maxFilesPerTrigger", 1)
        .option("maxFileAge", MAX_FILE_AGE)
        .json(literal(place))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession
        # files_per_batch rows at most.
        found = [r for r in batch.collect() if exists(here, f"{folder.rstrip('/')}/{unquote(r.source_file)}")]
        if not found:
            return
        names = [r.source_file for r in found]
        facts = export_facts(here, folder, fmt, names)
        exports = here.createDataFrame(found, ANNOUNCED).withColumn("mtime", F.timestamp_micros("mtime"))
        report = replace_by_date(facts, mart, exports=exports, unique_keys=True)
        logger.info("batch %d: %s", batch_id, report)
        if archive:
            for row in found:
                _archive(here, folder, archive, unquote(row.source_file), row.mtime)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _archive(spark: SparkSession, folder: str, archive: str, name: str, mtime: int) -> None:
    """Under its own name, or with its time where an export of that name is there already."""
    target = f"{archive.rstrip('/')}/{name}"
    if exists(spark, target):
        when = dt.datetime.fromtimestamp(mtime / 1e6, dt.UTC)
        target = f"{archive.rstrip('/')}/{archive_name(name, when)}"
    move_file(spark, f"{folder.rstrip('/')}/{name}", target)
