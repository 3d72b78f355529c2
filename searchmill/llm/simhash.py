"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has 64 bits; each is the majority of that bit over the XXH64 hashes (seed
42) of its shingles of `NGRAM` words. Documents whose fingerprints differ in at most `RADIUS`
= 2 bits are linked, and a component has all that can be reached over links.

Every bit is given a non-zero vector of three bits (its class, 1 to 7). For each non-zero vector v
a table keeps the bits whose class has an odd product with v: four of the seven classes, 36 or 37
bits. Any two bits in which two fingerprints differ have classes that some v is orthogonal to,
so that table keeps neither, and the pair meets in one of its buckets: none within the radius is
missed, whatever the fingerprints are.

1. Equal fingerprints are one node, found by a count that combines in the map tasks.
2. Nodes go to their seven buckets. The buckets are counted first: the nodes of one with more than
   `HOT` don't meet in it. They agree in the bits that the table keeps, and the 27 or 28 others are
   covered by seven tables in the same way; of a bucket of these at most 12 bits are free, so it
   has 4,096 different fingerprints at most, however many there are in all.
3. Buckets stream through their tasks in sorted order. All pairs of a bucket are compared by
   shifting the sorted column against itself. What is linked is returned as the edges of a
   binary tree per connected group, not as pairs: at most one edge per node and bucket, and no
   node with more than three in a bucket.
4. Components of the trees (`ngram_join.components`), the smallest doc_id of each, and a join back by
   fingerprint in which frequent fingerprints are broadcast (see `tables.join_counted`).

Null and empty texts and those of white space have fingerprint zero and link like any other. A
text of fewer words than a shingle is one shingle. Very long texts are hashed in slices of 1 MB.
Every row is returned, repeated ones as often as they occur. Rows are linked through their
fingerprints alone, so two texts under one doc_id are two rows with their own components. A null
doc_id is linked like any other but names no component; where a component has no other, its
component_id is null. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from searchmill.llm.ngram_join import components
from searchmill.llm.tables import join_counted, small, written
from searchmill.llm.windows import U64, in_pieces
from searchmill.llm.words import word_slices

NGRAM = 3
SEED = 42
RADIUS = 2
BITS = 64
CLASSES = (1 << (RADIUS + 1)) - 1
HOT = 512
"""Different fingerprints of a bucket that are compared with one another as they are."""
BROADCAST_ROWS = 1 << 16
"""Hot buckets (17 bytes each) that may be sent to all tasks; more are shuffled."""


def fingerprint(text: bytes, ngram: int = NGRAM, slice_bytes: int | None = None) -> int:
    """The majority of the shingles' hashes, bit by bit; 0 for a text without words."""
    counts, n = np.zeros(BITS, np.int64), 0
    before: list[bytes] = []
    for found in word_slices(text.lower(), slice_bytes):  # bytes.lower() changes A-Z alone
        words = before + found
        if len(words) >= ngram:
            joined = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words)) + 1
            end = np.cumsum(size) - 1
            start = (end - size + 1)[: len(words) - ngram + 1].tolist()
            hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start, end[ngram - 1 :].tolist(), strict=True)]
            counts += bit_counts(np.array(hashes, U64))
            n += len(hashes)
        before = words[max(len(words) - ngram + 1, 0) :]
    if not n and before:
        counts, n = bit_counts(np.array([xxh64_intdigest(b" ".join(before), SEED)], U64)), 1
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, the lowest bit first."""
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        octets = hashes[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return counts


def _fingerprints(ngram: int):
    def run(batches):
        for batch in in_pieces(batches, 1):
            # A text's buffer is read in place, not copied.
            texts = batch.column(1).cast(pa.binary())
            found = [0 if t is None else fingerprint(t, ngram) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["doc_id", "print"]
            )

    return run


def covering_masks(bits: list[int]) -> list[int]:
    """The bits that each table keeps: of any `RADIUS` of them, some table keeps none."""
    of_class = {bit: k % CLASSES + 1 for k, bit in enumerate(bits)}
    return [
        sum(1 << bit for bit, c in of_class.items() if (c & v).bit_count() % 2) for v in range(1, CLASSES + 1)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


MASKS = covering_masks(list(range(BITS)))
FINER = [
    [mask | finer for finer in covering_masks([b for b in range(BITS) if not mask >> b & 1])]
    for mask in MASKS
]
"""For each table, the seven that its hot buckets are dealt to instead."""


def _buckets(nodes: DataFrame) -> DataFrame:
    """(print, place, key): a node's bucket in each table."""
    keys = F.array(*[F.col("print").bitwiseAND(F.lit(_signed(m))) for m in MASKS])
    return nodes.select("print", F.posexplode(keys).alias("place", "key"))


def _finer(crowded: DataFrame) -> DataFrame:
    """(print, place, key): the buckets that stand for the crowded ones; tables count on."""
    masks = F.array(*[F.array(*[F.lit(_signed(m)) for m in finer]) for finer in FINER])
    keys = F.transform(masks[F.col("place")], lambda m: F.col("print").bitwiseAND(m))
    dealt = crowded.select("print", "place", F.posexplode(keys).alias("at", "key"))
    return dealt.select("print", (F.col("place") * CLASSES + CLASSES + F.col("at")).alias("place"), "key")


def _groups(values: np.ndarray, same: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest index that each fingerprint is linked to, directly or over others of its bucket.

    `same` numbers the buckets, ascending.
    """
    shift = 1
    live = np.arange(len(values))
    while True:
        live = live[live + shift < len(values)]
        live = live[same[live] == same[live + shift]]
        if not len(live):
            return label
        apart = values[live] ^ values[live + shift]
        for _ in range(RADIUS):
            apart &= apart - U64(1)  # drops the lowest bit; 0 - 1 leaves 0
        _unite(label, live[apart == 0], live[apart == 0] + shift)
        shift += 1


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a and b, in place; labels stay flat."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label[:] = further


def _trees(batches):
    """Edges (first, other) of the links in each bucket; rows come sorted by bucket."""
    kept = None
    for batch in batches:
        rows = [batch.column(k).to_numpy() for k in range(3)]
        if kept is not None:
            rows = [np.concatenate(pair) for pair in zip(kept, rows, strict=True)]
        place, key, value = rows
        if not len(key):
            continue
        # The last bucket may go on in the next batch.
        last = (place == place[-1]) & (key == key[-1])
        kept = [x[last] for x in rows]
        yield _edges(*[x[~last] for x in rows])
    if kept is not None:
        yield _edges(*kept)


def _edges(place: np.ndarray, key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    new = np.ones(len(key), bool)
    new[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1])
    label = _groups(value.view(U64), np.cumsum(new), np.arange(len(key)))
    order = np.argsort(label, kind="stable")
    begin = np.searchsorted(label[order], label[order])  # of its group, in `order`
    nth = np.arange(len(order)) - begin
    child = np.flatnonzero(nth > 0)
    parent = begin[child] + (nth[child] - 1) // 2
    return pa.RecordBatch.from_arrays(
        [pa.array(value[order[child]], pa.int64()), pa.array(value[order[parent]], pa.int64())],
        ["first", "other"],
    )


def _linked(buckets: DataFrame) -> DataFrame:
    dealt = buckets.select("place", "key", "print").repartition("place", "key")
    ordered = dealt.sortWithinPartitions("place", "key", "print")
    return ordered.mapInArrow(_trees, "first long, other long")


def links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges (first, other) between the different fingerprints `print` of `nodes`, all within the
    radius over a path of others within it."""
    buckets = _buckets(nodes)
    crowded = written(
        buckets.groupBy("place", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
        .select(F.col("place").alias("hot_place"), F.col("key").alias("hot_key")),
        "crowded-buckets",
    )
    if not crowded.limit(1).count():
        return _linked(buckets)
    judged = buckets.join(
        small(crowded, BROADCAST_ROWS),
        (F.col("place") == F.col("hot_place")) & (F.col("key") == F.col("hot_key")),
        "left",
    )
    whole = judged.where("hot_place IS NULL").select("print", "place", "key")
    return _linked(whole.unionByName(_finer(judged.where("hot_place IS NOT NULL"))))


def similar_prints(docs: DataFrame, ngram: int = NGRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, print, component_id) for each row of (doc_id, text): its fingerprint as a signed
    64-bit number, and the smallest doc_id that can be reached over links, itself included."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = written(
        docs.select("doc_id", "text").mapInArrow(_fingerprints(ngram), f"doc_id {kind}, print long"), "prints"
    )
    nodes = written(
        prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes"
    )
    labels = components(written(links(nodes.select("print"), hot).distinct(), "links"))
    labelled = written(
        nodes.join(labels.withColumnRenamed("node", "print"), "print", "left").withColumn(
            "label", F.coalesce("label", "print")
        ),
        "labelled",
    )
    classes = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    named = written(
        join_counted(labelled, written(classes, "classes"), "label", "prints").select("print", "n", "component_id"),
        "components",
    )
    return join_counted(prints, named, "print", "n").select("doc_id", "print", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    found = similar_prints(docs)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
