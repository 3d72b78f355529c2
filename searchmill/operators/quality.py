"""Rules of the cleaned layer and checks on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchmill.functions.columns import click_cap, date_text, demand_floor, strip_url_params


def clean_urls(facts: DataFrame) -> DataFrame:
    return facts.withColumn("page_path", strip_url_params(F.col("page_path")))


def repair_funnel(facts: DataFrame) -> DataFrame:
    """demand >= impressions and clicks <= impressions, both against the given impressions."""
    return facts.withColumns(
        {
            "demand": demand_floor(F.col("demand"), F.col("impressions")),
            "clicks": click_cap(F.col("clicks"), F.col("impressions")),
        }
    )


def clean_facts(facts: DataFrame) -> DataFrame:
    """All rules of the cleaned layer. Rows are never merged: pages that differ only in
    their parameters stay separate rows."""
    return repair_funnel(clean_urls(facts))


def require_dates(facts: DataFrame) -> DataFrame:
    """Fail the job on a null date. Catalog tables check this themselves; folders do not."""
    checked = F.when(
        F.col("dt").isNull(), F.raise_error(F.lit("dt must not be null")).cast("date")
    ).otherwise(F.col("dt"))
    return facts.withColumn("dt", checked)


def loaded_dates(table: DataFrame) -> DataFrame:
    """Distinct dates as text, in order. Reads the partition column only."""
    return table.select(date_text(F.col("dt")).alias("date_str")).distinct().orderBy("date_str")


def repeated_ids(table: DataFrame) -> DataFrame:
    """Ids that occur more than once; empty for a sound table."""
    return table.groupBy("id").count().where("count > 1")


def repeated_table_ids(table: DataFrame) -> DataFrame:
    """`repeated_ids` of a Parquet table, for which ids are only shuffled where they may repeat.

    One pass over the id column gives the least and greatest id of each part of a file, and
    whether its ids ascend. Parts that ascend and whose range no other part's range meets can't
    hold an id twice. Only the rows of the other parts are counted. The parts are some hundred
    bytes each and as many as the scan has; null ids are no ids.
    """
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    located = table.select("id", file, block)
    located = located.where("id IS NOT NULL").withColumn("file", F.xxhash64("file"))
    parts = located.mapInArrow(
        _id_ranges, "file long, block long, least long, greatest long, ascending boolean"
    ).groupBy("file", "block").agg(
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        # A part that came in several pieces is looked at closely.
        (F.min("ascending") & (F.count("*") == 1)).alias("ascending"),
    )
    before = Window.orderBy("least", "greatest").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("least", "greatest").rowsBetween(1, Window.unboundedFollowing)
    meets = (F.max("greatest").over(before) >= F.col("least")) | (F.min("least").over(after) <= F.col("greatest"))
    doubtful = parts.withColumn("meets", F.coalesce(meets, F.lit(False))).where("meets OR NOT ascending")
    doubtful = doubtful.select("file", "block")
    few = doubtful.limit(DOUBTFUL_PARTS + 1).collect()
    if not few:
        return table.select("id", F.lit(0).cast("long").alias("count")).limit(0)
    if len(few) <= DOUBTFUL_PARTS:
        doubtful = F.broadcast(table.sparkSession.createDataFrame(few, doubtful.schema))
    return repeated_ids(located.join(doubtful, ["file", "block"], "left_semi"))


# Parts of files (16 bytes each) that are sent to all tasks; more are joined by shuffle.
DOUBTFUL_PARTS = 100_000
RANGE = ["file", "block", "least", "greatest", "ascending"]


def _id_ranges(batches):
    """A row per run of rows of one part of a file."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([(c, pa.int64()) for c in RANGE[:4]] + [(RANGE[4], pa.bool_())])
    open_ = None  # the part that the last batch ended in
    for batch in batches:
        ids, file, block = (batch.column(k).to_numpy() for k in range(3))
        if not len(ids):
            continue
        cut = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        done = []
        for a, b in zip([0, *cut], [*cut, len(ids)], strict=True):
            part = ids[a:b]
            ascends = bool((part[1:] > part[:-1]).all())
            if open_ and open_[:2] == [file[a], block[a]]:
                ascends = ascends and open_[4] and int(part[0]) > open_[5]
                low, high = min(open_[2], int(part.min())), max(open_[3], int(part.max()))
                open_ = [*open_[:2], low, high, ascends, int(part[-1])]
            else:
                done += [open_] if open_ else []
                open_ = [*map(int, (file[a], block[a], part.min(), part.max())), ascends, int(part[-1])]
        yield pa.RecordBatch.from_pylist([dict(zip(RANGE, part, strict=False)) for part in done], schema)
    if open_:
        yield pa.RecordBatch.from_pylist([dict(zip(RANGE, open_, strict=False))], schema)
