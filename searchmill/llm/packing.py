"""Best-fit packing of documents into sequences by patterns and non-negative least squares.

1. Each document's ids (with the end id) are one piece, or several if they are more than a
   sequence holds: full pieces, and the rest as the first. The pieces are written once, in the
   order of the input, each with its number among its partition's pieces of the same length.
2. Only the histogram of lengths (at most `SIZE` numbers) comes to the driver. Patterns of two
   or three lengths that fill a sequence exactly are enumerated; non-negative least squares
   says how often to use each so that they use up the histogram; the counts are rounded to
   what is there. What is left is packed best fit: the largest length first, then again and
   again the largest that still fits, the same pattern as often as its lengths allow.
3. The plan says for each length which numbers go to which sequences. A piece's number among all
   of its length is its number in the partition plus the counts of the partitions before (prefix
   sums per length), so pieces find their places without being gathered or sorted.

Null text: no ids but the end id. Rows with equal or null doc_ids are packed one by one. A very long
text is encoded alone, in chunks, and cut into pieces (20 MB of text add some 475 MB). Extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchmill.llm.tables import small, written
from searchmill.llm.token_files import vocabulary_path
from searchmill.llm.tokens import END_ID, Encoder
from searchmill.llm.windows import in_pieces

SIZE = 1024
ROUNDS = 400
COUNT_ROWS = 1 << 20
"""Counts per partition and length that may be sent to all tasks; more are shuffled."""


def _cut(tokenizer: str, size: int, end_id: int):
    def run(batches):
        encoder = Encoder.of(vocabulary_path(tokenizer))
        met = np.zeros(size + 1, np.int64)  # pieces of each length so far
        for batch in in_pieces(batches, 1):
            ids, ends = encoder.encode(batch.column(1))
            to = ends + np.arange(1, len(ends) + 1)
            whole = np.full(int(to[-1]), end_id, "<u4")
            mask = np.ones(len(whole), bool)
            mask[to - 1] = False
            whole[mask] = ids
            begin = np.concatenate(([0], to[:-1]))
            n = to - begin
            pieces = -(-n // size)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = (n - 1) % size + 1
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * size)
            length = np.where(piece == 0, first[doc], size)
            # Its number among those of the same length.
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=size + 1)
            nth = np.empty(len(length), np.int64)
            firsts = np.cumsum(counts) - counts
            nth[order] = np.arange(len(length)) - firsts[length[order]]
            nth += met[length]
            met += counts
            at = begin[doc] + start
            offsets = np.concatenate((at, [len(whole)])) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(nth, pa.int64()),
                    pa.Array.from_buffers(
                        pa.large_binary(),
                        len(doc),
                        [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(whole.tobytes())],
                    ).cast(pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "nth", "ids"],
            )

    return run


def exact_patterns(counts: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence, of lengths that occur."""
    size = len(counts) - 1
    lengths = np.flatnonzero(counts[:size])
    lengths = lengths[lengths > 0]
    a, b = np.meshgrid(lengths, np.append(0, lengths), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = size - a - b
    ok = (c >= a) & (a >= b) & (c > 0) & (c < size)
    rows = np.stack((c[ok], a[ok], b[ok]), 1)
    return rows[counts[rows[:, 0]] > 0]


def least_squares(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative uses x of the patterns that fit the histogram best: min |A x - counts|^2,
    by accelerated projected gradients."""
    size = len(counts)
    flat = patterns.ravel()
    there = flat > 0
    target = counts.astype(float)
    target[0] = 0

    def used(x):
        return np.bincount(flat, weights=np.repeat(x, 3) * there, minlength=size)

    def back(r):
        return (r[flat] * there).reshape(-1, 3).sum(1)

    bound = back(used(np.ones(len(patterns)))).max()  # of the largest eigenvalue
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(rounds):
        nxt = np.maximum(y - back(used(y) - target) / bound, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x


def plan_patterns(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """(lengths, times) that use up the histogram `counts` (by length, up to a sequence's size)."""
    size = len(counts) - 1
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan = []
    if left[size]:
        plan.append(([size], int(left[size])))
        left[size] = 0
    patterns = exact_patterns(left)
    if len(patterns):
        x = least_squares(patterns, left)
        for k in np.argsort(-x, kind="stable"):
            times = int(x[k] + 0.5)
            if not times:
                break
            lengths = [int(n) for n in patterns[k] if n]
            for n in set(lengths):
                times = min(times, int(left[n]) // lengths.count(n))
            if times:
                plan.append((lengths, times))
                for n in lengths:
                    left[n] -= times
    while left.any():
        room, taken = size, left.copy()
        lengths = []
        while True:
            fits = np.flatnonzero(taken[: room + 1])
            if not len(fits):
                break
            n = int(fits[-1])
            lengths.append(n)
            taken[n] -= 1
            room -= n
        times = min(int(left[n]) // lengths.count(n) for n in set(lengths))
        plan.append((lengths, times))
        for n in lengths:
            left[n] -= times
    return plan


def places(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, number from, number to, sequence of the first, offset in a sequence)."""
    met: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for n in lengths:
            low = met.get(n, 0)
            out.append((n, low, low + times, sequence, offset))
            met[n] = low + times
            offset += n
        sequence += times
    return out


def pack_documents(
    docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of each piece of (doc_id, text)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(
        _cut(tokenizer, size, end_id),
        f"doc_id {kind}, piece int, start long, length long, nth long, ids binary",
    )
    pieces = written(pieces.withColumn("part", F.spark_partition_id()), "pieces", "zstd")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(size + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    plan = spark.createDataFrame(
        places(plan_patterns(histogram)),
        "in_length long, low long, high long, first long, offset long",
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("part").alias("in_part"),
        F.col("length").alias("of_length"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
    )
    numbered = pieces.join(
        small(bases, COUNT_ROWS),
        (F.col("part") == F.col("in_part")) & (F.col("length") == F.col("of_length")),
    ).withColumn("number", F.col("base") + F.col("nth"))
    # The plan has some thousand rows however many documents there are.
    return numbered.join(
        F.broadcast(plan),
        (F.col("length") == F.col("in_length"))
        & (F.col("number") >= F.col("low"))
        & (F.col("number") < F.col("high")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
        (F.col("first") + F.col("number") - F.col("low")).alias("sequence_id"),
        "offset",
    )


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    packed = pack_documents(docs, tokenizer)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
