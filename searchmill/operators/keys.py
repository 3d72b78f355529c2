"""Surrogate ids 1..N without a window over the whole table.

`row_number()` over everything runs in one task, and per date it still puts a hot date in
one task. Both functions here number rows by their place in rows that are already written,
so they need only a small table of row counts and a map-side pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# Sort order of new raw rows. The metrics only matter where keys repeat.
ROW_ORDER = ["dt", "source_file", "query", "page_path"]
TIE_ORDER = ["demand", "impressions", "position", "clicks"]

# monotonically_increasing_id() puts the task number above the lower 33 bits.
PART_BITS = 33
ROW_MASK = (1 << PART_BITS) - 1

# Count tables up to this many rows (about 24 bytes each) are broadcast.
BROADCAST_ROWS = 1_000_000

# Rows that a task sorts when rows are staged (42 to 75 MB, as measured), however many there are.
SORT_ROWS = 250_000


@dataclass(frozen=True)
class StagedRows:
    """Rows written in global order, each with its place `pos`, and their counts.

    `counts` has one row per (part, dt, source_file): its rows `n` and its `first_pos`; `size` is the
    number of all rows.
    """

    rows: DataFrame
    counts: DataFrame
    size: int


def stage_ordered(facts: DataFrame, folder: str, unique_keys: bool = False) -> StagedRows:
    """Write `facts` under `folder` in the order of date, export, query and page.

    `facts` is evaluated once, into a table of its own, and counted on the way. The range exchange
    is over that table, as it reads its input twice (first to sample the ranges). It splits a hot
    date over as many tasks as it needs, with SORT_ROWS rows each (few rows: as Spark chooses). Copies of a row could still fill one range, so unless the
    keys are known to be unique they are spread by their place in the written files, which
    is the same when a lost task is repeated.
    """
    spark = facts.sparkSession
    seen = Observation()
    counted = facts.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("compression", "lz4").parquet(f"{folder}/facts")
    facts = spark.read.schema(facts.schema).parquet(f"{folder}/facts")
    order = [c for c in ROW_ORDER if c in facts.columns]
    spread = order
    if not unique_keys:
        order = order + TIE_ORDER
        spread = [*order, "_tie"]
        facts = facts.withColumn("_tie", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    tasks = 1 + seen.get["rows"] // SORT_ROWS
    # Fewer rows than the cores can take are left to Spark's own choice.
    number = [tasks] if tasks >= spark.sparkContext.defaultParallelism else []
    (
        facts.repartitionByRange(*number, *spread)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .withColumn("pos", F.monotonically_increasing_id())
        .write.parquet(f"{folder}/rows")
    )
    rows = spark.read.parquet(f"{folder}/rows")
    keys = ["dt", *[c for c in ("source_file",) if c in rows.columns]]
    (
        rows.groupBy(_part().alias("part"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
        .write.parquet(f"{folder}/counts")
    )
    return StagedRows(rows, spark.read.parquet(f"{folder}/counts"), seen.get["rows"])


def number_staged(rows: DataFrame, counts: DataFrame, base: int, size: int) -> DataFrame:
    """Staged rows with ids that continue after `base`, in the staged order.

    Rows of (part, dt, source_file) groups that are not in `counts` are left out, and the
    others are numbered without gaps. `counts` has `size` rows: about one per task of the
    staging write and per date, so it is small beside the rows. Up to BROADCAST_ROWS it is
    broadcast; beyond, the join is left to Spark's own choice.
    """
    # One task sums the counts: they are as many as written files and dates, never rows.
    before = Window.orderBy("dt", "part").rowsBetween(Window.unboundedPreceding, -1)
    first_id = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.lit(base + 1)
    keys = ["part", "dt", *[c for c in ("source_file",) if c in rows.columns]]
    starts = counts.select(*keys, "first_pos", first_id.alias("first_id"))
    if size <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    numbered = rows.withColumn("part", _part()).join(starts, keys)
    return numbered.withColumn("id", F.col("first_id") + F.col("pos") - F.col("first_pos")).drop(
        "part", "pos", "first_pos", "first_id"
    )


def number_table(table: DataFrame, base: int = 0) -> DataFrame:
    """Rows of a Parquet table with ids base+1.. by date, file (in the order of its path's hash)
    and place in the file.

    No row is shuffled or sorted: the counts per file come from the file footers, the place
    is the Parquet row index. Any `id` column is replaced.
    """
    path = F.col("_metadata.file_path")
    located = table.withColumns({"_file": F.xxhash64(path), "_row": F.col("_metadata.row_index")})
    # Files go by a 64-bit hash of their path: 24 bytes each, 20 MB for 100 TB in files of
    # 128 MB. The driver has the list of paths itself, so this smaller table is always sent
    # to all tasks; equal hashes would fail the job. One task sums the counts.
    before = Window.orderBy("dt", "_file").rowsBetween(Window.unboundedPreceding, -1)
    collision = F.raise_error(F.lit("two files have one hash")).cast("bigint")
    starts = (
        # The path is a key, as its least and greatest would make each task sort its rows.
        located.groupBy("dt", "_file", path.alias("_path"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("dt", "_file")
        .agg(F.when(F.count(F.lit(1)) == 1, F.sum("n")).otherwise(collision).alias("n"))
        .select(
            F.col("_file"),
            (F.coalesce(F.sum("n").over(before), F.lit(0)) + F.lit(base + 1)).alias("_first"),
        )
    )
    return (
        located.drop("id")
        .join(F.broadcast(starts), "_file")
        .withColumn("id", F.col("_first") + F.col("_row"))
        .drop("_file", "_row", "_first")
    )


def highest_id(table: DataFrame, count: int | None = None) -> int:
    """max(id), 0 for an empty table. `count` is the table's number of rows, if known.

    Unique positive ids reach at least the row count, which the file footers give. So only
    ids from there on are looked at, and Parquet skips all row groups below. If there are
    none (ids were repeated or negative), the whole column is read.
    """
    count = table.count() if count is None else count
    if count == 0:
        return 0
    top = table.where(F.col("id") >= count).agg(F.max("id")).first()[0]
    return top if top is not None else (table.agg(F.max("id")).first()[0] or 0)


def _part() -> Column:
    return F.shiftright("pos", PART_BITS)
