"""Chat formatting by perspective rotation: each participant becomes the assistant once.

For every participant of a conversation the whole dialogue is rendered with that speaker as
`assistant` and everybody else as `user` with a name; only the assistant's words are learnt
from, so each rendered turn carries a mask span. System turns stay `system` everywhere and are
no participant. A dialogue is returned as its turns in order, each with its place (characters)
in the rendered dialogue: the turns' `rendered` by `position` make up the dialogue, and the
mask spans are offsets into it. That keeps a conversation of any length out of a single row.

Places are prefix sums in two levels: sums per block of turn numbers, running sums over the
blocks (one row per block), running sums inside a block. A block with more than `MOST_TURNS` turns
(null, equal or restarting numbers) is cut into ranges of turn, speaker and text first, and equal
turns are dealt to several ranges. A conversation that holds a third of all rows is so spread
over its blocks and ranges. The texts are shuffled once, by conversation, block and range; those
of large blocks once more before, into a written table.

Null role: the participant `unknown`. Null text: empty. Null conversation: one conversation of
its own. Null turn: before all others. Turns with the same number are ordered by role and text;
equal ones are all kept. A conversation with system turns only has no perspective. A very long turn
is one value; extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchmill.llm.tables import parts, small, written

BLOCK = 256
MOST_TURNS = 4096
"""Turns of a block that are not cut further. Ranges have about as many, unless there would be more
ranges than `spark.sql.shuffle.partitions`."""
LARGE_BLOCKS = 1 << 17
"""Large blocks that may be sent to all tasks; more are shuffled."""
KEY = ["conv", "no_conv"]
PLACE = [*KEY, "block", "cut"]
ORDER = ["turn", "speaker", "text"]
END = "<|end|>\n"


def _head(role: str, name: Column | None = None) -> Column:
    if name is None:
        return F.lit(f"<|{role}|>\n")
    return F.concat(F.lit(f"<|{role}|> "), name, F.lit("\n"))


def _before(*keys: str) -> Window:
    return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)


def block_rows(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns with their conversation and block of turn numbers."""
    return turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce(F.floor(F.col("turn") / block), F.lit(-(2**62))).alias("block"),
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def cut_blocks(rows: DataFrame, most: int = MOST_TURNS) -> DataFrame:
    """`rows` with `cut`: ascending ranges of the turns of a block that has more than `most`, else 0.

    The ranges are written, so that counts and turns see the same ones. Copies are spread by a tie
    breaker: a task's rows counted after a local sort by hash, so that a repeated task gives them
    the same ties.
    """
    spark = rows.sparkSession
    large = rows.groupBy(*KEY, "block").agg(F.count("*").alias("n")).where(F.col("n") > most)
    total = large.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        return rows.withColumn("cut", F.lit(0))
    n_ranges = min(parts(total, most), int(spark.conf.get("spark.sql.shuffle.partitions")))
    large = small(large.drop("n"), LARGE_BLOCKS)
    ranges = (
        rows.join(large, [*KEY, "block"], "left_semi")
        .withColumn("_hash", F.xxhash64(*KEY, "block", *ORDER))
        .sortWithinPartitions("_hash")
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(n_ranges, *KEY, "block", *ORDER, "_tie")
        .select(*rows.columns, F.spark_partition_id().alias("cut"))
    )
    others = rows.join(large, [*KEY, "block"], "left_anti").withColumn("cut", F.lit(0))
    return others.unionByName(written(ranges, "large-blocks", "zstd"))


def rotate_perspectives(
    turns: DataFrame, block: int = BLOCK, most: int = MOST_TURNS
) -> DataFrame:
    """(conv_id, perspective, position, turn, role, name, rendered, start, mask_start, mask_end).

    `position` counts the dialogue's turns from 0. `start` is the place of `rendered` in the
    dialogue; the mask span covers the assistant's text and its end mark and is null elsewhere.
    """
    rows = cut_blocks(block_rows(turns, block), most)
    # Size of a turn as rendered for the others; for its speaker the head differs by `delta`.
    as_other = F.when(F.col("speaker") == "system", _head("system")).otherwise(
        _head("user", F.col("speaker"))
    )
    size = (F.length(as_other) + F.length("text") + len(END)).cast("bigint")

    def delta(name: str) -> Column:
        return F.length(_head("assistant")) - F.length(_head("user", F.col(name)))

    counts = rows.groupBy(*PLACE, "speaker").agg(
        F.count("*").alias("n"), F.sum(size).alias("size")
    )
    blocks = counts.groupBy(*PLACE).agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    earlier = _before(*KEY).orderBy("block", "cut")
    blocks = blocks.select(
        *PLACE,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size"),
    )
    people = counts.where("speaker <> 'system'").select(*KEY, "speaker").distinct()
    own_earlier = _before(*KEY, "speaker").orderBy("block", "cut")
    bases = (
        blocks.join(people, KEY)
        .join(counts.select(*PLACE, "speaker", "n"), [*PLACE, "speaker"], "left")
        .withColumn("own", F.coalesce(F.sum("n").over(own_earlier), F.lit(0)))
        .groupBy(*PLACE, "first")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("speaker").alias("perspective"),
                    (F.col("size") + F.col("own") * delta("speaker")).alias("base"),
                )
            ).alias("people")
        )
    )

    in_block = _before(*PLACE).orderBy(*ORDER)
    seen = (
        rows.join(bases, PLACE)
        .withColumn("position", F.col("first") + F.count(F.lit(1)).over(in_block))
        .withColumn("inside", F.coalesce(F.sum(size).over(in_block), F.lit(0)))
        .select("*", F.inline("people"))
        .drop("people")
    )
    is_own = F.col("speaker") == F.col("perspective")
    so_far = _before(*PLACE, "perspective").orderBy("position")
    own = F.coalesce(F.sum(is_own.cast("int")).over(so_far), F.lit(0))
    start = F.col("base") + F.col("inside") + own * delta("perspective")
    head = F.when(is_own, _head("assistant")).otherwise(as_other)
    role = F.when(is_own, "assistant").when(F.col("speaker") == "system", "system")
    done = seen.select(
        "conv_id",
        "perspective",
        "position",
        "turn",
        role.otherwise("user").alias("role"),
        F.when(~is_own & (F.col("speaker") != "system"), F.col("speaker")).alias("name"),
        F.concat(head, "text", F.lit(END)).alias("rendered"),
        start.alias("start"),
        is_own.alias("is_own"),
    )
    body = F.col("start") + F.length(_head("assistant"))
    return done.select(
        *done.columns[:-1],
        F.when(F.col("is_own"), body).alias("mask_start"),
        F.when(F.col("is_own"), F.col("start") + F.length("rendered") - 1).alias("mask_end"),
    )
