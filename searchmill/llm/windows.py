"""Hashes over sequences of units (bytes or words) and content-defined segments of windows.

A polynomial hash modulo 2^64 over random unit values, then mixed: spans up to some hundred
units long, far below the length at which that modulus has weaknesses. `Hasher(1)` is a
second, independent one; both together are 128 bits and stand for equality. Words, which have
any length, get their values by `word_hashes`.

The anchor of a window of `w` units is the smallest of the hashes of its `k`-grams (the first
of equal ones). Equal windows have equal anchors at equal places, so windows that start one
after the other and share an anchor can travel as one segment under the anchor's hash.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

U64 = np.uint64
SLICE = 1 << 20
PLACE_BITS = U64(24)
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(BASES[seed]) + U64(seed))


class Hasher:
    """Span hashes of a slice of units by prefix sums of value x base^place."""

    _powers: dict = {}

    def __init__(self, values: np.ndarray, seed: int = 0):
        up, self.down = self.powers(seed, len(values) + 1)
        self.sums = np.empty(len(values) + 1, U64)
        self.sums[0] = 0
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    @classmethod
    def powers(cls, seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if seed not in cls._powers or len(cls._powers[seed][0]) < n:
            n = max(n, SLICE + 4096)
            base = BASES[seed] | 1
            inverse = pow(base, -1, 1 << 64)
            cls._powers[seed] = tuple(
                np.cumprod(np.concatenate(([U64(1)], np.full(n - 1, x, U64))), dtype=U64)
                for x in (base, inverse)
            )
        return cls._powers[seed]

    def grams(self, k: int) -> np.ndarray:
        """Hash of each span of `k` units."""
        n = len(self.sums) - k
        if n <= 0:
            return np.empty(0, U64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:n])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each `w` neighbours."""
    width = 1
    while 2 * width <= w:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    return np.minimum(v[: len(v) - (w - width)], v[w - width :]) if w > width else v


def slices(ends: np.ndarray, w: int):
    """(from, to, last) of pieces of the units: windows start in from..to, units end at last."""
    n = int(ends[-1]) if len(ends) else 0
    for a in range(0, n, SLICE):
        yield a, min(a + SLICE, n), min(a + SLICE + w - 1, n)


def ends_at(ends: np.ndarray, a: int, b: int) -> np.ndarray:
    """The end of its document for each unit in a..b; `ends` are cumulative."""
    first = int(np.searchsorted(ends, a, "right"))
    last = int(np.searchsorted(ends, b - 1, "right")) if b > a else first
    cuts = np.concatenate(([a], ends[first:last], [b]))
    return np.repeat(ends[first : last + 1], np.diff(cuts))


def segments(values, ends: np.ndarray, w: int, k: int):
    """For each slice: (first unit of the slice, hasher, start, n windows, anchor) of its segments.

    `values(index)` gives the unit values at a slice. Starts are places in the slice. Windows don't
    cross documents; a document of fewer than `w` units has none.
    """
    for a, b, last in slices(ends, w):
        if last - a < w:
            continue
        hasher = Hasher(values(slice(a, last)))
        grams = hasher.grams(k)
        packed = (grams & ~((U64(1) << PLACE_BITS) - U64(1))) | np.arange(len(grams), dtype=U64)
        least = sliding_min(packed, w - k + 1)
        n = min(b - a, len(least))
        place = (least[:n] & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
        first = np.arange(a, a + n)
        valid = first + w <= ends_at(ends, a, a + n)
        new = np.empty(n, bool)
        new[:1] = True
        new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, n))
        ok = valid[start]
        start, count = start[ok], count[ok]
        yield a, hasher, start, count, grams[place[start]]


def word_spans(data: np.ndarray, ends: np.ndarray, inside: np.ndarray):
    """(start, end, number of words before each document's end) of the words in `data`.

    `inside` tells for each byte value whether it belongs to words.
    """
    flags = np.zeros(len(data) + 2, bool)
    flags[1:-1] = inside[data]
    change = flags[1:] != flags[:-1]
    inner = ends[:-1]  # a document ends a word
    inner = inner[(inner > 0) & (inner < len(data))]
    inner = np.unique(inner)
    both = inner[flags[inner] & flags[inner + 1]]
    edges = np.flatnonzero(change)
    if len(both):
        edges = np.sort(np.concatenate((edges, both, both)))
    start, end = edges[0::2], edges[1::2]
    return start, end, np.searchsorted(start, ends, "left")


LONG_WORD = 64
"""Bytes up to which words are hashed block by block for all at once; longer ones go one by one."""
BLOCK_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def blocks_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, zeros after the end; one more place than `data`."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word, which depends on its bytes alone.

    Its blocks of eight bytes are mixed in one after the other, which is a bijection for each: words
    of one block never have equal hashes, longer ones only by chance. Long words are hashed by
    XXH64. (Words have any length, so a polynomial modulo 2^64 wouldn't do: it has one value for
    words of 1,024 letters that anyone can write down.)
    """
    blocks = blocks_at(data)
    size = end - start
    out = mix(size.astype(U64) * U64(BASES[seed] | 1) + U64(seed + 1))
    live = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    done = 0
    while len(live):
        left = np.minimum(size[live] - done, 8)
        out[live] = mix(out[live] ^ (blocks[start[live] + done] & BLOCK_MASKS[left]))
        done += 8
        live = live[size[live] > done]
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] ^= U64(xxh64_intdigest(data[start[k] : end[k]].tobytes(), seed))
    return mix(out)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, cumulative ends) of an Arrow string or binary column; null: empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at[1:] - at[0]


def release() -> None:
    """Give freed memory back to the system: Python workers live on between tasks, and those of
    an executor share its memory with the JVM. Tables of powers are soon made again."""
    import ctypes

    import pyarrow as pa

    Hasher._powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


RELEASE_BYTES = 1 << 19


def released(run):
    """`run`, a task function of one or two tables, with its memory given back when it is over, if
    the tables were of some size."""

    def of_one(table):
        try:
            return run(table)
        finally:  # the function's own arrays are gone by now
            if table.nbytes > RELEASE_BYTES:
                release()

    def of_two(left, right):
        try:
            return run(left, right)
        finally:
            if left.nbytes + right.nbytes > RELEASE_BYTES:
                release()

    return of_one if run.__code__.co_argcount == 1 else of_two


def in_pieces(batches, column, most: int = 1 << 20):
    """The batches cut into runs of rows with up to about `most` bytes of text each, so that
    the arrays made from them stay small. `column`: a number, or a function of a batch."""
    for batch in batches:
        _, ends = text_buffer(column(batch) if callable(column) else batch.column(column))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, done + most, "right")), at + 1)
            yield batch.slice(at, to - at)
            at = to
    release()
