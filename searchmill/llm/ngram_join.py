"""N-gram Jaccard join by MinHash banding: documents whose sets of word n-grams are alike.

Words are lower-cased runs of letters, digits and non-ASCII characters; a document's set has its
n-grams of `NGRAM` words, or the whole of a shorter text. Two documents are linked if their
sets' Jaccard similarity is `THRESHOLD` or more.

1. Documents with equal sets are one member; copies are counted, not compared.
2. A MinHash signature per member is cut into bands; `plan_bands` chooses how many bands of how
   many rows give the target recall at the threshold. Members are shuffled on band hashes.
3. Every bucket of a band has a pivot, its smallest member. A member goes, with its whole set,
   to each of its pivots; pivots gather the buckets of several bands that are about the same
   documents. A pivot's members are cut into chunks of `CHUNK`; each pair of chunks is a task's
   group (a tile), so no group grows with a hot pivot. In a tile all pairs that agree in a band
   are verified on the full sets, as products of sparse 0/1 rows. A pair that agrees in several
   bands is judged only under the pivot of the first of them, so it counts once.
4. Tiles return per document the number of linked documents, and the edges of a spanning forest
   of what they linked: no pairs. Classes are the components of these edges, found by passing on
   the smallest label until nothing changes; each round is cut by a written table.

The work for a pivot grows with the square of the members whose sets differ (copies don't
count), as each of these pairs may or may not be a link; it is spread over tiles.

Documents without words link with nothing, not even with each other, and are classes of their
own. Null text: no words. Rows with the same doc_id and set are one document; a doc_id with
several sets is in the smallest of their classes, and their links add up. A null doc_id is left
out, as no class can be named by it. A very long text is read alone, in slices of a million
words (20 MB of text add some 290 MB); its whole set goes to each of its tiles. Extra columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchmill.llm.decontamination import contents, read_words
from searchmill.llm.tables import small, written
from searchmill.llm.windows import U64, Hasher, ends_at, in_pieces, mix, released

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.99999
ROWS = 4
CHUNK = 256
SEED = 11
BROADCAST_ROWS = 1 << 16
"""Members (some hundred bytes each) that may be sent to all tasks; more are shuffled."""
ID_ROWS = 1 << 20
"""The same for bare ids."""


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of `rows` rows that find a pair at the threshold with probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def shingles(words: np.ndarray, ends: np.ndarray, n: int):
    """(hashes, up to each text's end): the sorted set of each text's n-grams."""
    begin = np.concatenate(([0], ends[:-1])).astype(np.int64)
    size = ends - begin
    found, owner = [], []
    for a in range(0, len(words), 1 << 20):
        b = min(a + (1 << 20), len(words))
        grams = Hasher(words[a : min(b + n - 1, len(words))]).grams(n)
        at = np.arange(a, a + min(b - a, len(grams)))
        ok = at + n <= ends_at(ends, a, a + len(at))
        found.append(grams[: len(at)][ok])
        owner.append(np.searchsorted(ends, at[ok], "right"))
    short = np.flatnonzero((size > 0) & (size < n))
    found.append(contents(words, begin[short], size[short])[0])
    owner.append(short)
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(ends)), "right")


def band_hashes(found: np.ndarray, to: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of non-empty sets."""
    begin = np.concatenate(([0], to[:-1])).astype(np.int64)
    out = np.zeros((len(to), bands), U64)
    keys = mix(np.arange(1, bands * rows + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(SEED))
    for band in range(bands):
        for row in range(rows):
            k = band * rows + row
            hashed = (found ^ keys[k]) * (keys[k] | U64(1))
            hashed ^= hashed >> U64(29)
            hashed *= U64(0xBF58476D1CE4E5B9)
            least = np.minimum.reduceat(hashed, begin)
            out[:, band] = mix(out[:, band] * U64(0xD1B54A32D192ED03) + least)
    return out


def _set_hashes(found: np.ndarray, begin: np.ndarray, to: np.ndarray):
    """128-bit hashes of sets: sums over mixed elements."""
    h1 = np.concatenate(([U64(0)], np.cumsum(mix(found + U64(1)), dtype=U64)))
    h2 = np.concatenate(([U64(0)], np.cumsum(mix(found ^ U64(BASE)), dtype=U64)))
    return (h1[to] - h1[begin]).view(np.int64), (h2[to] - h2[begin]).view(np.int64)


def _signatures(ngram: int, bands: int, rows: int):
    """A row per text: size and hash of its set, and its band hashes."""

    def run(batches):
        for batch in in_pieces(batches, 1):
            _, _, _, ends, words = read_words(batch.column(1))
            found, to = shingles(words, ends, ngram)
            begin = np.concatenate(([0], to[:-1])).astype(np.int64)
            some = np.flatnonzero(to > begin)
            full = np.zeros((len(to), bands), U64)
            if len(some):
                full[some] = band_hashes(found, to[some], bands, rows)
            h1, h2 = _set_hashes(found, begin, to)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(to - begin, pa.int64()),
                    pa.array(h1),
                    pa.array(h2),
                    _lists(full.view(np.int64)),
                ],
                ["doc_id", "size", "set1", "set2", "bands"],
            )

    return run


def _lists(grid: np.ndarray) -> pa.ListArray:
    n, width = grid.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(grid.ravel())
    )


def _with_sets(ngram: int):
    """The set of each text that is the member it was joined with."""

    def run(batches):
        for batch in in_pieces(batches, 0):
            _, _, _, ends, words = read_words(batch.column(0))
            found, to = shingles(words, ends, ngram)
            begin = np.concatenate(([0], to[:-1])).astype(np.int64)
            h1, h2 = _set_hashes(found, begin, to)
            member = batch.column(1)
            same = (h1 == member.field("set1").to_numpy()) & (h2 == member.field("set2").to_numpy())
            raw = found.tobytes()
            grams = pa.array([raw[8 * a : 8 * b] for a, b in zip(begin, to, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([member, grams], ["member", "grams"]).filter(pa.array(same))

    return run


BASE = 0xA0761D6478BD642F


def _tile(threshold: float):
    """Links between (or inside) two chunks of a pivot's members."""
    top = round(threshold * 10_000)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        pivot = table["pivot"][0].as_py()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        _, once = np.unique(table["sid"].to_numpy(), return_index=True)  # repeated rows
        table = table.take(pa.array(once)).combine_chunks()
        doc, chunk = table["sid"].to_numpy(), table["chunk"].to_numpy()
        copies, size = table["copies"].to_numpy(), table["size"].to_numpy()
        bands = np.stack(table["bands"].to_numpy())
        pivots = np.stack(table["pivots"].to_numpy())
        left = np.flatnonzero(chunk == low)
        right = np.flatnonzero(chunk == high)
        first = np.full((len(left), len(right)), -1, np.int64)
        judged = np.zeros((len(left), len(right)), bool)
        for band in range(bands.shape[1]):
            same = (bands[left, band][:, None] == bands[right, band][None, :]) & ~judged
            judged |= same
            first[same] = np.broadcast_to(pivots[left, band][:, None], same.shape)[same]
        pairs = judged & (first == pivot)
        if low == high:
            pairs &= left[:, None] < right[None, :]
        a, b = np.nonzero(pairs)
        common = np.zeros(len(a), np.int64)
        if len(a):
            common = _common(table["grams"], left, right)[a, b]
        a, b = left[a], right[b]
        linked = common * 10_000 >= top * (size[a] + size[b] - common)
        a, b = a[linked], b[linked]
        n = np.bincount(a, weights=copies[b], minlength=len(doc)) + np.bincount(
            b, weights=copies[a], minlength=len(doc)
        )
        # Spanning forest: each document points to a smaller one of its component.
        label = np.arange(len(doc))
        while len(a):
            before = label.copy()
            np.minimum.at(label, a, label[b])
            np.minimum.at(label, b, label[a])
            label = label[label]
            if (label == before).all():
                break
        some = np.flatnonzero(n > 0)
        return pa.table(
            {
                "sid": pa.array(doc[some], pa.int64()),
                "n": pa.array(n[some].astype(np.int64)),
                "other": pa.array(doc[label[some]], pa.int64()),
            }
        )

    return run


def _common(grams, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    a = [np.frombuffer(grams[int(i)].as_py(), U64) for i in left]
    b = [np.frombuffer(grams[int(i)].as_py(), U64) for i in right]
    out = np.zeros((len(a), len(b)), np.float32)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    row_a = np.repeat(np.arange(len(a)), [len(x) for x in a])
    row_b = np.repeat(np.arange(len(b)), [len(x) for x in b])
    both = np.intersect1d(flat_a, flat_b)
    at_a, at_b = np.searchsorted(both, flat_a), np.searchsorted(both, flat_b)
    step = 4096  # columns of the 0/1 matrices at a time
    in_a = (at_a < len(both)) & (both[np.minimum(at_a, len(both) - 1)] == flat_a) if len(both) else at_a < 0
    in_b = (at_b < len(both)) & (both[np.minimum(at_b, len(both) - 1)] == flat_b) if len(both) else at_b < 0
    at_a, row_a, at_b, row_b = at_a[in_a], row_a[in_a], at_b[in_b], row_b[in_b]
    for low in range(0, len(both), step):
        x = np.zeros((len(a), step), np.float32)
        y = np.zeros((len(b), step), np.float32)
        here = (at_a >= low) & (at_a < low + step)
        x[row_a[here], at_a[here] - low] = 1
        here = (at_b >= low) & (at_b < low + step)
        y[row_b[here], at_b[here] - low] = 1
        out += x @ y.T
    return np.rint(out).astype(np.int64)


def similar_documents(
    docs: DataFrame, threshold: float = THRESHOLD, ngram: int = NGRAM,
    recall: float = RECALL, rows: int = ROWS, chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, class_id, n_links) for each different (doc_id, text) of `docs`.

    `n_links` counts the other documents whose similarity is at least `threshold`; `class_id`
    is the smallest doc_id that can be reached over links.
    """
    bands = plan_bands(threshold, recall, rows)
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    slim = written(
        texts.mapInArrow(
            _signatures(ngram, bands, rows),
            "doc_id long, size long, set1 long, set2 long, bands array<long>",
        ),
        "signatures",
    )
    members = written(
        slim.where("size > 0")
        .groupBy("set1", "set2", "size")
        .agg(
            F.min("doc_id").alias("first"),
            F.count_distinct("doc_id").alias("copies"),
            F.min("bands").alias("bands"),  # equal in all
        )
        .withColumn("sid", F.monotonically_increasing_id()),
        "members",
    )

    banded = members.select("sid", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("sid").alias("pivot"), F.count("*").alias("n"))
    pivots = (
        banded.join(buckets.where("n > 1").drop("n"), ["band", "hash"])
        .groupBy("sid")
        .agg(F.map_from_entries(F.collect_list(F.struct("band", "pivot"))).alias("pivots"))
    )
    every_band = F.sequence(F.lit(0), F.lit(bands - 1))
    wanted = written(
        members.join(pivots, "sid").select(
            F.col("first").alias("doc_id"),
            F.struct(
                "sid", "copies", "size", "set1", "set2", "bands",
                F.transform(
                    every_band, lambda b: F.coalesce(F.col("pivots")[b], F.lit(-1).cast("long"))
                ).alias("pivots"),
            ).alias("member"),
        ),
        "pivots",
    )

    own = F.array_distinct(F.filter("member.pivots", lambda p: p >= 0))
    counts = wanted.select(F.explode(own).alias("pivot")).groupBy("pivot").agg(F.count("*").alias("n"))
    counts = counts.select("pivot", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    sets = texts.join(small(wanted, BROADCAST_ROWS), "doc_id").select("text", "member").mapInArrow(
        _with_sets(ngram), f"member {wanted.schema['member'].dataType.simpleString()}, grams binary"
    )
    tiles = (
        sets.withColumn("pivot", F.explode(own))
        .join(small(counts, BROADCAST_ROWS), "pivot")
        .withColumn("chunk", F.pmod(F.xxhash64("member.sid"), F.col("chunks")).cast("int"))
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "pivot",
            F.least("chunk", "partner").alias("low"),
            F.greatest("chunk", "partner").alias("high"),
            "chunk",
            "member.sid",
            "member.copies",
            "member.size",
            "member.bands",
            "member.pivots",
            "grams",
        )
    )
    links = written(
        tiles.groupBy("pivot", "low", "high").applyInArrow(released(_tile(threshold)), "sid long, n long, other long"),
        "links",
    )

    labels = components(links.where("sid <> other").select(F.col("sid").alias("first"), "other").distinct())
    linked = (
        members.select("sid", "set1", "set2", "size", "first", "copies")
        .join(links.groupBy("sid").agg(F.sum("n").alias("n")), "sid", "left")
        .join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        .withColumn("label", F.coalesce("label", "sid"))
    )
    classes = linked.groupBy("label").agg(F.min("first").alias("class_id"))
    by_set = linked.join(classes, "label").select(
        "set1", "set2", "size", "class_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")
    )
    return (
        slim.select("doc_id", "set1", "set2", "size")
        .distinct()
        .join(by_set, ["set1", "set2", "size"], "left")
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.min("class_id"), F.col("doc_id")).alias("class_id"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_links"),
        )
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node reaches over (first, other) edges.

    Each round every node takes the smallest label around it, then its label's label, so
    the number of rounds grows with the logarithm of a path's length.
    """
    both = written(
        edges.select(F.col("first").alias("a"), F.col("other").alias("b"))
        .unionByName(edges.select(F.col("other").alias("a"), F.col("first").alias("b")))
        .distinct(),
        "edges",
    )
    labels = written(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("label")
        ),
        "labels",
    )
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        better = labels.join(around, labels["node"] == around["a"]).select(
            "node", "label", F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        moved = written(
            better.join(jump, better["next"] == jump["at"]).select(
                "node", F.least("next", "beyond").alias("label"), (F.col("label") != F.least("next", "beyond")).alias("moved")
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if not moved.where("moved").limit(1).count():
            return labels


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are the first of their class, all columns kept; rows with a null
    doc_id stay."""
    later = written(
        similar_documents(docs).where("doc_id <> class_id").select(F.col("doc_id").alias("_later")),
        "later-documents",
    )
    later = small(later, ID_ROWS)
    # Columns by frame, as `docs` may have columns of any name.
    return docs.join(later, docs["doc_id"] == later["_later"], "left_anti")
