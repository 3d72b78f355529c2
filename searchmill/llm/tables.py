"""Reading the given tables, and written steps in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; only a session that has none (as in tests) gets a local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='searchmill-llm-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """`df` as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = fresh_folder(spark, purpose)
    df.write.option("compression", compression).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def rows_and_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Number of rows, and UTF-8 bytes of all texts, in one pass."""
    n_bytes = F.sum(F.octet_length(F.col(text)).cast("bigint"))
    row = docs.agg(F.count("*").alias("rows"), n_bytes.alias("bytes")).first()
    return row["rows"], int(row["bytes"] or 0)


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: one number, to size the partitions by."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)).cast("bigint")).alias("n")).first()
    return int(row["n"] or 0)


def parts(n_bytes: int, per_part: int) -> int:
    return max(1, -(-n_bytes // per_part))


def small(df: DataFrame, most: int) -> DataFrame:
    """`df` as a side to broadcast if it has at most `most` rows, else as it is, for a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


HOT_SHARE = 1 << 16


def join_counted(
    left: DataFrame, right: DataFrame, on: str | list[str], n: str, total: int | None = None
) -> DataFrame:
    """`left` with the columns of `right`, which has one row for each value of `on` in `left` and in
    column `n` how many rows of `left` have it; `left` has `total` rows (else they are summed).

    Values with more than a `HOT_SHARE`th of all rows are fewer than `HOT_SHARE`, whatever the
    size of the tables: they are broadcast, so their rows aren't shuffled. The others' rows are.
    """
    if total is None:
        total = right.agg(F.sum(n).alias("total")).first()["total"] or 0
    on = [on] if isinstance(on, str) else on
    limit = max(1024, -(-total // HOT_SHARE))
    hot, cold = right.where(F.col(n) > limit), right.where(F.col(n) <= limit)
    there = left.join(F.broadcast(hot), on)
    rest = left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return there.unionByName(rest)
