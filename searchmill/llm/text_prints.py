"""Document fingerprints by prefix polynomial hashes.

A text's prefix array holds, modulo a prime, the sum of code point x base^place up to each place;
two bases modulo 2^31 - 1 make 62 bits. From prefix arrays the hash of any span is a difference
and a product, so spans compare in constant time, and the longest common extension of two places
is found by binary search over span lengths.

A fingerprint is, in hexadecimal: the number of code points (16 digits), the hash of the whole
text (16 digits), and the `KEPT` smallest different hashes of its spans of `SPAN` code points (16
digits each, ascending; a shorter text has itself as its only span, an empty one none). Equal
texts have equal fingerprints. The likeness of two fingerprints is 1 if they are equal, and else
the share of common hashes among the `KEPT` smallest of both: an estimate of the Jaccard
similarity of the texts' sets of spans.

Null texts are empty texts. Neighbours in descending order of doc_id: rows with the same doc_id
are in the order of their texts' hashes, null doc_ids come last. Each text is shuffled once, to a
range of doc_ids; the first text of a range is sent to the range before it as well. A very long text
is hashed in slices of a million code points; its prefix arrays take eight bytes for each. Extra
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchmill.llm.tables import parts, total_bytes
from searchmill.llm.windows import in_pieces

PRIME = np.uint64((1 << 31) - 1)
BASES = (911382323, 1587329573)
INVERSES = {base: pow(base, -1, (1 << 31) - 1) for base in BASES}
SPAN = 16
KEPT = 64
RANGE_BYTES = 4 << 20
MOST_RANGES = 1 << 14


SLICE = 1 << 20
"""Code points that are hashed at once; of longer texts, only the prefix arrays are held whole."""


class Powers:
    """Powers of a base or its inverse modulo PRIME: a slice of them, and a step between slices."""

    _made: dict = {}

    @classmethod
    def of(cls, base: int) -> np.ndarray:
        """The first `SLICE` powers."""
        if base not in cls._made or len(cls._made[base]) < SLICE:
            powers = np.ones(1, np.uint64)
            while len(powers) < SLICE:
                step = np.uint64(pow(base, len(powers), int(PRIME)))
                powers = np.concatenate((powers, powers * step % PRIME))
            cls._made[base] = powers
        return cls._made[base]

    @classmethod
    def at(cls, base: int, places: np.ndarray) -> np.ndarray:
        far = int(places.max(initial=0)) // SLICE
        steps = np.array([pow(base, k * SLICE, int(PRIME)) for k in range(far + 1)], np.uint64)
        return reduced(cls.of(base)[places % SLICE] * steps[places // SLICE])


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME for x below 2^63: the bits above 31 count as much as those below."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.minimum(x, x - PRIME)  # below PRIME, the difference wraps around


def _after(x: np.ndarray, base: int, places: int) -> np.ndarray:
    """x times the power of `base` at a place."""
    return reduced(x * np.uint64(pow(base, places, int(PRIME)))) if places else x


class Prefixes:
    """Prefix arrays of a text's code points: four bytes each for each base."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.sums = []
        for base in BASES:
            sums = np.zeros(self.n + 1, np.uint32)
            for a in range(0, self.n, SLICE):
                values = points[a : a + SLICE].astype(np.uint64) + np.uint64(1)
                terms = _after(reduced(values * Powers.of(base)[: len(values)]), base, a)
                # Below 2^31 times a slice: no overflow.
                sums[a + 1 : a + 1 + len(values)] = reduced(np.cumsum(terms, dtype=np.uint64) + sums[a])
            self.sums.append(sums)

    def value(self, which: int, place: int) -> int:
        """Of the array of a base."""
        return int(self.sums[which][place])

    def spans(self, start, size) -> np.ndarray:
        """Hashes of the spans of `size` code points from each start on."""
        start = np.asarray(start, np.int64)
        size = np.asarray(size, np.int64)
        out = np.zeros(np.broadcast(start, size).shape, np.uint64)
        for base, sums in zip(BASES, self.sums, strict=True):
            apart = reduced(sums[start + size].astype(np.uint64) + PRIME - sums[start])
            one = reduced(apart * Powers.at(INVERSES[base], start))
            out = (out << np.uint64(31)) | one
        return out

    def span_slices(self, size: int, stop: int | None = None):
        """Hashes of the spans of `size` code points in order, of the first `stop` of them."""
        n = max(self.n - size + 1, 0)
        n = n if stop is None else min(n, max(stop, 0))
        for a in range(0, n, SLICE):
            b = min(a + SLICE, n)
            out = np.zeros(b - a, np.uint64)
            for base, sums in zip(BASES, self.sums, strict=True):
                apart = reduced(sums[a + size : b + size].astype(np.uint64) + PRIME - sums[a:b])
                one = reduced(apart * Powers.of(INVERSES[base])[: b - a])
                out = (out << np.uint64(31)) | _after(one, INVERSES[base], a)
            yield out


class Spliced:
    """Prefix arrays of the first `keep` code points of one text and `taken` ones of another, by
    place: nothing is copied."""

    def __init__(self, first: Prefixes, keep: int, second: Prefixes, taken: int):
        self.first, self.keep, self.second = first, keep, second
        self.n = keep + taken
        self.shifts = [pow(base, keep, int(PRIME)) for base in BASES]

    def value(self, which: int, place: int) -> int:
        if place <= self.keep:
            return self.first.value(which, place)
        tail = self.second.value(which, place - self.keep) * self.shifts[which]
        return (self.first.value(which, self.keep) + tail) % int(PRIME)


def whole_hash(prefixes) -> int:
    out = 0
    for which in range(len(BASES)):
        out = out << 31 | prefixes.value(which, prefixes.n)
    return out


def common_extension(a, at: int, b, to: int) -> int:
    """Longest common extension of place `at` in a and place `to` in b, by binary search.

    Spans are equal if their sums are, each shifted by the other's place."""
    prime = int(PRIME)
    sides = [
        (which, a.value(which, at), pow(base, to, prime), b.value(which, to), pow(base, at, prime))
        for which, base in enumerate(BASES)
    ]
    low, high = 0, min(a.n - at, b.n - to)
    while low < high:
        middle = (low + high + 1) // 2
        if all(
            ((a.value(k, at + middle) - x0) * up - (b.value(k, to + middle) - y0) * other) % prime == 0
            for k, x0, up, y0, other in sides
        ):
            low = middle
        else:
            high = middle - 1
    return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def smallest(hashes: np.ndarray, kept: int) -> np.ndarray:
    """The `kept` smallest different hashes, in order."""
    few = min(4 * kept, len(hashes))
    # Repeated spans may fill the smallest places: take more until enough differ.
    while True:
        some = np.unique(np.partition(hashes, few - 1)[:few] if few < len(hashes) else hashes)
        if len(some) >= kept or few == len(hashes):
            return some[:kept]
        few = min(4 * few, len(hashes))


def sketch(prefixes, slices, kept: int = KEPT) -> tuple[int, int, np.ndarray]:
    """(code points, hash of the whole text, smallest of its spans' hashes)."""
    whole = whole_hash(prefixes)
    least = np.empty(0, np.uint64)
    if prefixes.n and prefixes.n < SPAN:
        least = spread(np.array([whole], np.uint64))
    for hashes in slices:
        if len(least) == kept:
            hashes = hashes[hashes < least[-1]]
        if len(hashes):
            least = np.unique(np.concatenate((least, smallest(hashes, kept))))[:kept]
    return prefixes.n, whole, least


def text_sketch(text: str) -> tuple[int, int, np.ndarray]:
    prefixes = Prefixes(code_points(text))
    return sketch(prefixes, map(spread, prefixes.span_slices(SPAN)))


def spread(h):
    """A bijection of 64 bits, so that small polynomial hashes aren't those of like spans."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(31))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def as_text(print_: tuple[int, int, np.ndarray]) -> str:
    n, whole, least = print_
    return f"{n:016x}{whole:016x}" + least.astype(">u8").tobytes().hex()


def from_text(text: str) -> tuple[int, int, np.ndarray]:
    least = np.frombuffer(bytes.fromhex(text[32:]), ">u8").astype(np.uint64)
    return int(text[:16], 16), int(text[16:32], 16), least


def likeness(a, b, kept: int = KEPT) -> float:
    if a[:2] == b[:2]:
        return 1.0
    x, y = set(a[2].tolist()), set(b[2].tolist())
    # The smallest hashes of both together, of which neither side lacks one unseen.
    both = sorted(x | y)[:kept]
    return sum(h in x and h in y for h in both) / len(both) if both else 0.0


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many (or all) of the following text's."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


NAMES = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint"]
NAMES += ["near_edited", "near_next", "same_as_edited", "same_as_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
KINDS += [pa.float64(), pa.float64(), pa.int64(), pa.int64()]


@dataclass
class Text:
    bucket: int
    borrowed: int
    doc_id: int | None
    text: str

    def __post_init__(self):
        self.prefixes = Prefixes(code_points(self.text))
        # Those of a text of one slice are kept, as they are needed up to three times.
        self.kept = None
        if self.prefixes.n <= SLICE:
            self.kept = np.concatenate([np.empty(0, np.uint64), *self.hashes()])
        self.sketch = sketch(self.prefixes, self.hashes())

    def hashes(self, stop: int | None = None):
        """Hashes of the first `stop` spans, in slices."""
        if self.kept is not None:
            return iter([self.kept[: None if stop is None else max(stop, 0)]])
        return map(spread, self.prefixes.span_slices(SPAN, stop))

    def before(self, following: Text) -> tuple:
        """The result row of this text, if `following` is the next one.

        Prefix arrays and span hashes of the edited text come from those of the two texts;
        only the spans that cross the seam are hashed anew.
        """
        changed = edited(self.text, following.text)
        keep = self.prefixes.n - self.prefixes.n // 3
        taken = len(changed) - keep
        prefixes = Spliced(self.prefixes, keep, following.prefixes, taken)
        seam = Prefixes(code_points(changed[max(keep - SPAN + 1, 0) : keep + SPAN - 1]))
        slices = chain(
            self.hashes(keep - SPAN + 1),
            map(spread, seam.span_slices(SPAN)),
            following.hashes(taken - SPAN + 1),
        )
        changed_sketch = sketch(prefixes, slices)
        return (
            self.doc_id,
            self.prefixes.n,
            changed,
            as_text(self.sketch),
            as_text(changed_sketch),
            likeness(self.sketch, changed_sketch),
            likeness(self.sketch, following.sketch),
            common_extension(self.prefixes, 0, prefixes, 0),
            common_extension(self.prefixes, 0, following.prefixes, 0),
        )


def _prints(batches):
    """Rows (bucket, borrowed, doc_id, text) in order; a bucket's borrowed row comes last."""
    held = None
    for batch in in_pieces(batches, 3, 2 << 20):
        done = []
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            same = held is not None and held.bucket == values[0]
            if same and held.borrowed:
                continue  # other rows with the doc_id of the borrowed one
            text = Text(*values)
            if same:
                done.append(held.before(text))
            held = text
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], NAMES
            )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next,
    same_as_edited, same_as_next): `edited` is the text with its last third replaced by the
    start of the next text in descending order of doc_id (after the last: the first); the last
    two columns are lengths of common prefixes."""
    spark = docs.sparkSession
    number = F.col("doc_id").cast("bigint")
    rows = docs.select(number.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n_ranges = min(parts(total_bytes(docs), RANGE_BYTES), MOST_RANGES)
    # Range 0 holds the largest doc_ids; rows without one are the last range.
    at = [k / n_ranges for k in range(1, n_ranges)]
    cuts = rows.approxQuantile("doc_id", at, 0.1 / n_ranges) if at else []
    bucket = _range_number(np.array(sorted({int(c) for c in cuts}), np.int64))
    rows = rows.withColumn("bucket", bucket(F.col("doc_id")))
    # Each range's first document is borrowed by the range before it (the first of all by the
    # last range); a row for each range.
    heads = sorted(
        (r["bucket"], r["head"])
        for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()
    )
    lent = spark.createDataFrame(
        [(head, heads[k - 1][0], lender) for k, (lender, head) in enumerate(heads)],
        "head long, borrower long, lender long",
    )
    borrowed = rows.join(
        F.broadcast(lent), (F.col("bucket") == F.col("lender")) & F.col("doc_id").eqNullSafe(F.col("head"))
    ).select("doc_id", "text", F.col("borrower").alias("bucket"), F.lit(1).alias("borrowed"))
    ordered = (
        rows.select("doc_id", "text", "bucket", F.lit(0).alias("borrowed"))
        .unionByName(borrowed)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "borrowed", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
        .select("bucket", "borrowed", "doc_id", "text")
    )
    return ordered.mapInArrow(
        _prints,
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, same_as_edited long, same_as_next long",
    )


def _range_number(cuts: np.ndarray):
    """The number of a doc_id's range, from the largest ids down."""

    @F.pandas_udf("long")
    def bucket(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna()
        number = len(cuts) - np.searchsorted(cuts, doc_id.fillna(0).astype("int64"), "right")
        return pd.Series(np.where(known, number, len(cuts) + 1))

    return bucket


def digest(docs: DataFrame) -> DataFrame:
    return fingerprint_documents(docs).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        F.col("same_as_edited").alias("common_prefix_edited"),
        F.col("same_as_next").alias("common_prefix_next"),
    )
