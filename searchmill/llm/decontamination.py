"""Benchmark decontamination by winnowing.

Words are lower-cased runs of letters, digits and non-ASCII characters. Of every `WIDTH - GRAM + 1`
neighbouring hashes of `GRAM` words the smallest is kept as a fingerprint, in documents and in
benchmark items alike; so any span of `WIDTH` words that both hold has a fingerprint in common.
Document fingerprints are joined with those of the benchmark, and each hit is extended: the
windows of `WIDTH` words around it are compared by content (128 bits) with the windows of the
benchmark. An item of fewer words is one window of its own; as its length is below what
winnowing guarantees, all of a document's spans of that length are fingerprints for it.

Most fingerprints of documents are in no item. Before the join they are held against a bit map
of the benchmark's fingerprints: it has a fixed size (`MAP_BITS` bits) whatever the benchmark's
size, and only lets fingerprints through that the join then drops; a large benchmark fills it
and so makes the join larger, not wrong.

Documents that hit the same set of windows are collapsed before the set's items are listed, so
a passage that a third of all documents hold is looked up once. Windows are joined as distinct
contents: no pairs of documents and items arise but those that the list of items consists of.

Null or wordless texts have no words and no hits. Null doc_ids and repeated rows are kept and
judged each by its own text. Items with the same item_id count as one; a null item_id is left
out of lists and counts, but its words still make documents hit. Texts are read in pieces of about a
megabyte, a longer one alone and in slices of a million words (20 MB of text add some 220 MB); extra
columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchmill.llm.tables import small, written
from searchmill.llm.windows import (
    U64,
    Hasher,
    ends_at,
    in_pieces,
    mix,
    segments,
    text_buffer,
    word_hashes,
    word_spans,
)

WIDTH = 10
GRAM = 5
MAP_BITS = 24
ID_ROWS = 1 << 20
"""Contaminated documents (16 bytes each) that may be sent to all tasks; more are shuffled."""

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def read_words(column):
    """(lower-cased bytes, word start, word end, words up to each text's end, word hashes)."""
    data, ends = text_buffer(column)
    data = LOWER[data]
    start, end, word_ends = word_spans(data, ends, LETTERS)
    return data, start, end, word_ends, word_hashes(data, start, end)


def contents(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple:
    """128-bit content hash of the spans of `size` words from each start on."""
    out = np.empty(len(start), U64), np.empty(len(start), U64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for a in range(0, len(at), 1 << 15):
            some = at[a : a + (1 << 15)]
            grid = words[start[some, None] + np.arange(n)]
            for seed, target in enumerate(out):
                up, _ = Hasher.powers(seed, n)
                target[some] = mix((grid * up[:n]).sum(1, dtype=U64) + U64(n))
    return out


def windows_of(words, ends, width: int, gram: int, short: list[int] | None, passes):
    """(start, size, fingerprint) of the windows whose fingerprint `passes`.

    `short`: sizes below `width` to take from everywhere; None: the whole of each short text.
    """
    starts, sizes, prints = [], [], []
    for a, _, start, count, anchor in segments(lambda at: words[at], ends, width, gram):
        ok = passes(anchor)
        start, count, anchor = start[ok] + a, count[ok], anchor[ok]
        first = np.repeat(start - (np.cumsum(count) - count), count)
        starts.append(first + np.arange(len(first)))
        sizes.append(np.full(len(first), width))
        prints.append(np.repeat(anchor, count))
    begin = np.concatenate(([0], ends[:-1])).astype(np.int64)
    whole = ends - begin
    for n in range(1, width) if short is None else short:
        for a in range(0, len(words), 1 << 20):
            if short is None:
                at = begin[(whole == n) & (begin >= a) & (begin < a + (1 << 20))]
            else:
                b = min(a + (1 << 20), len(words))
                at = np.arange(a, b)
                at = at[at + n <= ends_at(ends, a, b)]
            size = np.full(len(at), n)
            h = contents(words, at, size)[0]
            ok = passes(h)
            starts.append(at[ok])
            sizes.append(size[ok])
            prints.append(h[ok])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64)
    return tuple(np.concatenate(x) for x in (starts, sizes, prints))


def _everything(hashes: np.ndarray) -> np.ndarray:
    return np.ones(len(hashes), bool)


def _item_windows(width: int, gram: int):
    """The windows of benchmark items."""

    def run(batches):
        for batch in in_pieces(batches, 1):
            _, _, _, ends, words = read_words(batch.column(1))
            start, size, found = windows_of(words, ends, width, gram, None, _everything)
            h1, h2 = contents(words, start, size)
            item = np.searchsorted(ends, start, "right")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(item)),
                    pa.array(found.view(np.int64)),
                    pa.array(h1.view(np.int64)),
                    pa.array(h2.view(np.int64)),
                    pa.array(size, pa.int32()),
                ],
                ["item_id", "print", "h1", "h2", "size"],
            )

    return run


def _candidates(width: int, gram: int, short: list[int], bitmap: np.ndarray):
    """Of documents: the number of words, and the windows that pass the bit map."""

    def passes(h):
        bit = (h >> U64(64 - MAP_BITS)).astype(np.int64)
        return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0

    def run(batches):
        for batch in in_pieces(batches, 2):
            _, _, _, ends, words = read_words(batch.column(2))
            begin = np.concatenate(([0], ends[:-1])).astype(np.int64)
            start, size, found = windows_of(words, ends, width, gram, short, passes)
            row = np.searchsorted(ends, start, "right")
            order = np.argsort(row, kind="stable")
            start, size, found, row = start[order], size[order], found[order], row[order]
            h1, h2 = contents(words, start, size)
            cut = np.searchsorted(row, np.arange(len(ends) + 1))
            windows = pa.StructArray.from_arrays(
                [
                    pa.array(start - begin[row] if len(row) else start, pa.int64()),
                    pa.array(size, pa.int32()),
                    pa.array(found.view(np.int64)),
                    pa.array(h1.view(np.int64)),
                    pa.array(h2.view(np.int64)),
                ],
                ["start", "size", "print", "h1", "h2"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(ends - begin, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), windows),
                ],
                ["doc_id", "text_hash", "n_words", "windows"],
            )

    return run


def _bitmap(windows: DataFrame) -> np.ndarray:
    """2^MAP_BITS bits, set where a fingerprint begins with these bits: at most 2 MB collected."""
    bit = F.shiftrightunsigned("print", 64 - MAP_BITS)
    words = (
        windows.select(bit.alias("bit"))
        .select(
            F.shiftright("bit", 6).alias("at"),
            F.expr("shiftleft(1L, cast(bit & 63 AS int))").alias("bits"),
        )
        .groupBy("at")
        .agg(F.bit_or("bits").alias("bits"))
    )
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in words.collect():
        bitmap[row["at"]] = row["bits"]
    return bitmap.view(np.uint8)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, gram: int = GRAM
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items, spans) for each row of `docs`.

    `n_hit` words lie in `spans` (start, length: in words), the union of the occurrences of
    benchmark windows; `items` are the ids with such windows, as strings in order.
    """
    items = benchmark.select("item_id", "text").mapInArrow(
        _item_windows(width, gram),
        f"item_id {benchmark.schema['item_id'].dataType.simpleString()},"
        " print long, h1 long, h2 long, size int",
    )
    items = written(items.distinct(), "benchmark-windows")
    short = sorted(r["size"] for r in items.select("size").distinct().collect() if r["size"] < width)
    body = F.coalesce(F.col("text"), F.lit(""))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.xxhash64(body).alias("text_hash"), body.alias("text")).mapInArrow(
        _candidates(width, gram, short, _bitmap(items)),
        f"doc_id {id_type}, text_hash long, n_words long,"
        " windows array<struct<start: long, size: int, print: long, h1: long, h2: long>>",
    )
    # One row a document, and windows for few of them: written, as it is used twice.
    found = written(
        found.select("*", F.monotonically_increasing_id().alias("row")), "document-windows"
    )

    key = ["print", "h1", "h2"]
    hits = found.select("row", F.inline("windows")).join(items.select(*key).distinct(), key)
    window_id = F.struct("h1", "h2")
    by_row = hits.groupBy("row").agg(
        F.array_sort(F.collect_set(window_id)).alias("window_set"),
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("at"),
    )
    by_row = by_row.select(
        "row", "window_set", F.xxhash64("window_set").alias("set1"),
        F.xxhash64(F.lit(1), "window_set").alias("set2"), "at",
    ).mapInArrow(
        _united,
        "row long, window_set array<struct<h1: long, h2: long>>, set1 long, set2 long,"
        " spans array<struct<start: long, length: long>>",
    )
    sets = by_row.groupBy("set1", "set2").agg(F.first("window_set").alias("window_set"))
    listed = (
        sets.select("set1", "set2", F.inline("window_set"))
        .join(items.where("item_id IS NOT NULL").select("item_id", "h1", "h2"), ["h1", "h2"])
        .groupBy("set1", "set2")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    rows = by_row.drop("window_set").join(listed, ["set1", "set2"], "left").drop("set1", "set2")
    nothing = F.array().cast("array<string>")
    no_spans = F.array().cast("array<struct<start: long, length: long>>")
    spans = F.coalesce("spans", no_spans)
    return (
        found.drop("windows")
        .join(rows, "row", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_hit"),
            F.size(F.coalesce("items", nothing)).cast("long").alias("n_items"),
            F.coalesce("items", nothing).alias("items"),
            spans.alias("spans"),
        )
    )


def _united(batches):
    """Sorted (start, end) spans of each row, united where they touch or overlap, as (start, length)."""
    for batch in batches:
        at = batch.column(4)
        flat = at.flatten()
        start = flat.field("start").to_numpy(zero_copy_only=False)
        end = flat.field("end").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False))
        # The farthest end so far in the row: rows are set apart by more than any end.
        apart = row * (int(end.max(initial=0)) + 1)
        reach = np.maximum.accumulate(end + apart) - apart if len(end) else end
        new = np.ones(len(start), bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(start[first], pa.int64()), pa.array(reach[last] - start[first], pa.int64())],
            ["start", "length"],
        )
        cuts = np.searchsorted(row[first], np.arange(len(at) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.ListArray.from_arrays(pa.array(cuts), spans)],
            ["row", "window_set", "set1", "set2", "spans"],
        )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without benchmark windows, all columns kept."""
    dirty = (
        find_contamination(docs, benchmark)
        .where("n_hit > 0")
        .select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    dirty = small(written(dirty, "contaminated"), ID_ROWS)
    # Columns by frame, as `docs` may have columns of any name.
    same = docs["doc_id"].eqNullSafe(dirty["_doc"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == dirty["_hash"]
    )
    return docs.join(dirty, same, "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
