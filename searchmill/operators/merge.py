"""Several exports at once: per date, the latest export that carries the date wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_export_per_date(counts: DataFrame, exports: DataFrame) -> DataFrame:
    """(dt, source_file) of the winners, at most one row per calendar date.

    `counts` has rows per date and export (any finer grain will do), taken after the
    positive-metric filter; `exports` has `source_file, mtime`. The outcome is the same as
    loading the exports one after another by time.
    """
    contenders = counts.select("dt", "source_file").distinct()
    return (
        contenders.join(exports.select("source_file", "mtime"), "source_file")
        .groupBy("dt")
        .agg(F.max_by("source_file", F.struct("mtime", "source_file")).alias("source_file"))
    )


def keep_winners(facts: DataFrame, winners: DataFrame) -> DataFrame:
    """Facts of the winning export of each date.

    The winners are one row per calendar date, so their size is bounded by the calendar
    and they are broadcast: a join by date would send a hot date to one task.
    """
    return facts.join(F.broadcast(winners), ["dt", "source_file"], "left_semi")
