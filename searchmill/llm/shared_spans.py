"""Spans that a document shares with one of smaller doc_id, found without pairing documents.

What two documents share is found through windows of `width` units (words or bytes):

1. Texts that are equal as a whole are settled first, on hashes: each but the first is covered.
2. Documents are dealt into blocks of about `BLOCK_BYTES` of text. Each block sends the distinct
   anchors of its segments (see `windows`) to their shards, five bytes each, and hears which of
   them other blocks have too. An anchor is sent once per block however often it occurs.
3. Segments under shared anchors are sent to the shards of a search method, which says which of
   their windows start in an earlier document. Equal segments of a block are sent once, for
   their first document; the later ones are covered anyhow. Where more segments lie under one
   anchor than a shard should hold (see `Units.hot`), the windows of those that are sent are dealt
   one by one, so a passage that a third of all documents hold doesn't meet in one shard. A shard
   collapses equal segments again, and searches those whose anchor different segments of different
   documents have, some `SEARCH_UNITS` at a time: others share no window.
4. Each block cuts the covered units out of its documents.

All steps are shuffles by block or shard; blocks and shards are sized by the number of bytes,
so they stay small as the input grows. The texts themselves are shuffled once: the steps use
the same exchange. Nothing but that number goes through the driver.

A null text has no units. A null doc_id counts as larger than any number. Rows with the same
doc_id are not smaller than one another; rows that are equal get equal results. A very long document
makes its block larger: windows are hashed in slices of a million units, while its text and one
number per unit are held whole. Extra columns are passed on, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchmill.llm.tables import join_counted, parts, rows_and_bytes, written
from searchmill.llm.windows import (
    BASES,
    U64,
    PLACE_BITS,
    Hasher,
    byte_values,
    segments,
    text_buffer,
    mix,
    released,
    word_hashes,
    word_spans,
)

BLOCK_BYTES = 4 << 20
ANCHOR_SHARD_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
SEARCH_UNITS = 1 << 20
HOT = 1024
LOW = U64(0xFFFFFFFF)


@dataclass(frozen=True)
class Units:
    """What texts are made of.

    `read(data, ends)` gives (values, unit ends, state): `values(index)` the units' 64-bit values
    at a slice or an array of places, and `state[0]` the units as they are sent. `keep(data,
    ends, unit ends, state, mask)` gives the text of the units in the mask as (bytes, ends).
    An anchor is hot with more than `hot` times `HOT` segments: about a megabyte. Windows that are
    dealt one by one take some ten times what their segments take, so fewer shouldn't count as many:
    the number of segments under an anchor grows with the input, and ever more anchors would be hot.
    """

    read: Callable
    keep: Callable
    dtype: type
    kept_type: T.DataType
    hot: int = 1


def _read_bytes(data, ends):
    table = byte_values(0)
    return (lambda at: table[data[at]]), ends, (data,)


def _keep_bytes(data, ends, unit_ends, state, kept):
    so_far = np.concatenate(([0], np.cumsum(kept)))
    return data[kept], so_far[ends]


BYTES = Units(_read_bytes, _keep_bytes, np.uint8, T.BinaryType(), hot=16)


def _words(inside: np.ndarray, in_place: bool) -> Units:
    def read(data, ends):
        start, end, unit_ends = word_spans(data, ends, inside)
        hashes = word_hashes(data, start, end)
        return (lambda at: hashes[at]), unit_ends, (hashes, start, end)

    def keep(data, ends, unit_ends, state, kept):
        """The kept words of each document, joined by one space."""
        _, start, end = state
        start, size = start[kept], (end - state[1])[kept]
        doc = np.searchsorted(unit_ends, np.flatnonzero(kept), "right")
        last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.empty(0, bool)
        step = size + ~last  # a space after each word but a document's last
        to = np.cumsum(step)
        out = np.full(int(to[-1]) if len(to) else 0, 0x20, np.uint8)
        at = np.repeat(start - (to - step), size)
        place = np.arange(len(out))
        word = np.ones(len(out), bool)
        word[(to - 1)[~last]] = False
        out[word] = data[at + place[word]]
        sizes = np.bincount(doc, weights=step, minlength=len(ends)).astype(np.int64)
        return out, np.cumsum(sizes)

    def keep_in_place(data, ends, unit_ends, state, kept):
        """Each document without its removed words and the white space after each of them."""
        _, start, _ = state
        last = np.zeros(len(start) + 1, bool)
        last[unit_ends] = True  # the word before is a document's last
        stop = np.append(start[1:], len(data))
        of_last = np.flatnonzero(last[1:])
        doc = np.searchsorted(unit_ends, of_last, "right")
        stop[of_last] = ends[doc]
        edge = np.zeros(len(data) + 1, np.int64)
        edge[start[~kept]] += 1
        np.add.at(edge, stop[~kept], -1)
        stays = np.cumsum(edge[:-1]) == 0
        return data[stays], np.concatenate(([0], np.cumsum(stays)))[ends]

    return Units(read, keep_in_place if in_place else keep, U64, T.StringType())


SPACES = np.ones(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = False
WORDS = _words(SPACES, in_place=False)
WORDS_IN_PLACE = _words(SPACES, in_place=True)


class Block:
    """The documents of one block in a fixed order: by doc_id and hash, equal rows once."""

    def __init__(self, docs: pa.Table, units: Units):
        doc = docs["doc"].to_numpy()
        text_hash = docs["hash"].to_numpy()
        self.order = np.lexsort((text_hash, doc))
        doc, text_hash = doc[self.order], text_hash[self.order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1])
        self.row = np.cumsum(new) - 1  # of each document in self.order
        self.doc, self.hash = doc[new], text_hash[new]
        self.taken = self.order[new]
        self.docs = docs
        self.units = units

    def ranks(self, doc: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
        """Places of (doc, hash) among the block's documents."""
        at = {key: i for i, key in enumerate(zip(self.doc.tolist(), self.hash.tolist(), strict=True))}
        return np.array([at[k] for k in zip(doc.tolist(), text_hash.tolist(), strict=True)], np.int64)

    def read(self, rows: np.ndarray):
        """(data, ends, values, unit ends, state) of the texts with these ranks."""
        data, ends = text_buffer(self.docs["text"].take(pa.array(self.taken[rows])))
        return data, ends, *self.units.read(data, ends)

    def first_copies(self, side: pa.Table) -> np.ndarray:
        """Ranks of the documents that aren't copies of an earlier one."""
        first = np.ones(len(self.doc), bool)
        first[self.copies(side)] = False
        return np.flatnonzero(first)

    def copies(self, side: pa.Table) -> np.ndarray:
        copy = side.filter(pc.equal(side["kind"], 0))
        return np.unique(self.ranks(copy["doc"].to_numpy(), copy["hash"].to_numpy()))


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of equal values."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cut], [*cut, len(values)], strict=True)) if len(values) else []


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array `known`. The lower bits of the values are random."""
    found = np.zeros(len(values), bool)
    if len(known):
        low = U64((1 << min(22, 4 + len(known).bit_length())) - 1)
        seen = np.zeros(int(low) + 1, bool)
        seen[known & low] = True
        some = np.flatnonzero(seen[values & low])
        at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
        found[some] = known[at] == values[some]
    return found


def _repeated(values: np.ndarray) -> np.ndarray:
    """Places of the values that are there more than once."""
    ordered = np.sort(values)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.flatnonzero(_within(values, again))


SIDE = "block long, kind int, doc long, hash long, shard long, keys binary, hot binary"
COVER = "block long, row binary, start binary, n binary, echoes binary"
FOUND = (
    "shard long, block long, doc binary, row binary, start binary, size binary, units binary, echoes binary"
)
MOST_COUNTED = 1 << 15
"""Segments of a block under one anchor are counted up to here: as many are hot anyhow."""
MOST_LISTED = 1 << 30


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.ChunkedArray:
    """Binary values of the bytes between each two cuts, which are places in `values`."""
    raw = np.ascontiguousarray(values).view(np.uint8)
    ends = np.asarray(cuts, np.int64) * values.itemsize
    chunks, at = [], 0
    while at < len(ends) - 1 or not chunks:
        to = max(int(np.searchsorted(ends, ends[at] + MOST_LISTED, "right")) - 1, min(at + 1, len(ends) - 1))
        buffers = [None, pa.py_buffer((ends[at : to + 1] - ends[at]).astype(np.int32)), pa.py_buffer(raw[ends[at] : ends[to]])]
        chunks.append(pa.Array.from_buffers(pa.binary(), to - at, buffers))
        at = to
    return pa.chunked_array(chunks, pa.binary())


def _cuts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


def _anchors_of(units: Units, width: int, gram: int, n_shards: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        block = Block(docs, units)
        _, _, values, unit_ends, _ = block.read(block.first_copies(side))
        found = [anchor for *_, anchor in segments(values, unit_ends, width, gram)]
        anchors = np.sort(_dealt(np.concatenate(found) if found else np.empty(0, U64), n_shards))
        cuts = _cuts(anchors)
        count = np.minimum(np.diff(cuts), MOST_COUNTED).astype(np.uint16)
        anchors = anchors[cuts[:-1]]
        shard = anchors >> U64(32)
        cuts = _cuts(shard)
        number = docs["block"][0].as_py() if docs.num_rows else 0
        return pa.table(
            {
                "shard": pa.array(shard[cuts[:-1]].astype(np.int64), pa.int64()),
                "block": pa.array(np.full(len(cuts) - 1, number), pa.int64()),
                "keys": _lists((anchors & LOW).astype(np.uint32), cuts),
                "counts": _lists(count, cuts),
            }
        )

    return run


def _dealt(anchor: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each anchor, and 32 bits of the anchor below."""
    return ((anchor >> U64(32)) % U64(n_shards) << U64(32)) | (anchor & LOW)


def _shared_anchors(hot: int):
    """What each block of a shard hears: its anchors that other blocks have too, and those with
    more than `hot` segments."""

    def run(table: pa.Table) -> pa.Table:
        data, ends = text_buffer(table["keys"])
        keys = np.frombuffer(data.tobytes(), np.uint32)
        counts = np.frombuffer(text_buffer(table["counts"])[0].tobytes(), np.uint16)
        ends = np.concatenate(([0], ends // 4))
        order = np.argsort(keys)
        cuts = _cuts(keys[order])
        size = np.diff(cuts)
        total = np.add.reduceat(counts[order], cuts[:-1], dtype=np.int64) if len(keys) else np.empty(0, np.int64)
        is_shared, is_hot = np.empty(len(keys), bool), np.empty(len(keys), bool)
        is_shared[order] = np.repeat(size >= 2, size)
        is_hot[order] = np.repeat(total > hot, size)

        def told(mask):
            return _lists(keys[mask], np.concatenate(([0], np.cumsum(mask)))[ends])

        return pa.table(
            {
                "block": table["block"],
                "kind": pa.array(np.ones(table.num_rows, np.int32), pa.int32()),
                "doc": pa.nulls(table.num_rows, pa.int64()),
                "hash": pa.nulls(table.num_rows, pa.int64()),
                "shard": table["shard"],
                "keys": told(is_shared),
                "hot": told(is_hot),
            }
        )

    return run


def _told(side: pa.Table, column: str) -> np.ndarray:
    """Sorted (shard, key) numbers that a block has heard."""
    rows = side.filter(pc.equal(side["kind"], 1))
    data, ends = text_buffer(rows[column])
    shard = np.repeat(rows["shard"].to_numpy().astype(U64), np.diff(ends // 4, prepend=0))
    return np.sort((shard << U64(32)) | np.frombuffer(data.tobytes(), np.uint32).astype(U64))


def _packed(number: int, dest, doc, row, place, size, source, start) -> pa.Table:
    """A row per shard with the segments that go there; `start` are their places in `source`."""
    order = np.argsort(dest, kind="stable")
    cuts = _cuts(dest[order])
    size = size[order]
    ends = np.concatenate(([0], np.cumsum(size)))[cuts]
    n = len(cuts) - 1
    return pa.table(
        {
            "shard": pa.array(dest[order][cuts[:-1]].astype(np.int64), pa.int64()),
            "block": pa.array(np.full(n, number), pa.int64()),
            "doc": _lists(doc[order].astype(np.int64), cuts),
            "row": _lists(row[order].astype(np.int32), cuts),
            "start": _lists(place[order].astype(np.int32), cuts),
            "size": _lists(size.astype(np.int32), cuts),
            "units": _lists(_gathered(source, start[order], size), ends),
            "echoes": pa.nulls(n, pa.binary()),
        },
        schema=FOUND_ARROW,
    )


def _repeats(start, count, row, h1, h2, anchor):
    """(a segment of each content and document, echoes): the others' places as progressions
    (which of the first, its place, its windows, first place, step, number). Starts ascend."""
    # Equal segments have equal anchors: most have their own, and are only passed on.
    some = _repeated(anchor)
    alone = np.ones(len(anchor), bool)
    alone[some] = False
    start, count, row, h1, h2 = (x[some] for x in (start, count, row, h1, h2))
    # One sort; of equal keys by chance, the segments would merely be sent more than once.
    order = np.argsort(mix(h1 + row.astype(U64) * U64(BASES[0])), kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in (row, h1, h2, count):
        new[1:] |= key[order][1:] != key[order][:-1]
    once = order[new]
    which = np.cumsum(new) - 1
    again = np.flatnonzero(~new)
    place = start[order]
    step = place[again] - place[again - 1]
    begins = np.ones(len(again), bool)
    begins[1:] = (which[again][1:] != which[again][:-1]) | (step[1:] != step[:-1])
    at = np.flatnonzero(begins)
    which = which[again][at]
    echoes = (which, start[once][which], count[once][which], place[again][at], step[at])
    echoes = np.stack((*echoes, np.diff(np.append(at, len(again)))), 1).astype(np.int64)
    return np.concatenate((some[once], np.flatnonzero(alone))), echoes


def _echoed(row, start, n, echoes, width: int):
    """Yields covered spans (row, start, size in units): those of the windows given, and of the
    same windows at the other places of their segments."""
    yield row, start, n + width - 1
    if not len(echoes) or not len(row):
        return
    key = (echoes[:, 0] << 32) | echoes[:, 1]
    order = np.argsort(key, kind="stable")
    echoes, key = echoes[order], key[order]
    asked = (row << 32) | start
    low = np.searchsorted(key, key[np.maximum(np.searchsorted(key, asked, "right") - 1, 0)], "left")
    high = np.searchsorted(key, asked, "right")
    inside = (high > low) & (echoes[low, 0] == row) & (start < echoes[low, 1] + echoes[low, 2])
    low, high = low[inside], high[inside]
    each = np.repeat(np.flatnonzero(inside), high - low)
    echo = echoes[_places(low, high - low)]
    at = echo[:, 3] + start[each] - echo[:, 1]
    step, times, size = echo[:, 4], echo[:, 5], n[each] + width - 1
    # Where copies overlap or touch, the progression is one span.
    close = (step <= size) | (times == 1)
    yield row[each[close]], at[close], (size + (times - 1) * step)[close]
    each, at, step, times, size = (x[~close] for x in (each, at, step, times, size))
    to = np.cumsum(times)
    for a in range(0, int(to[-1]) if len(to) else 0, 1 << 20):
        nth = np.arange(a, min(a + (1 << 20), int(to[-1])))
        k = np.searchsorted(to, nth, "right")
        yield row[each[k]], at[k] + (nth - to[k] + times[k]) * step[k], size[k]


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    to = np.cumsum(size)
    return np.arange(int(to[-1]) if len(to) else 0) + np.repeat(start - (to - size), size)


def _gathered(source: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The spans of `source`, one after the other."""
    to = np.cumsum(size)
    out = np.empty(int(to[-1]) if len(to) else 0, source.dtype)
    at = 0
    while at < len(to):
        begin = int(to[at] - size[at])
        end = max(int(np.searchsorted(to, begin + (1 << 20), "right")), at + 1)
        out[begin : int(to[end - 1])] = source[_places(start[at:end], size[at:end])]
        at = end
    return out


def _segments_of(units: Units, width: int, gram: int, n_anchor_shards: int, n_shards: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        block = Block(docs, units)
        number = docs["block"][0].as_py() if docs.num_rows else 0
        firsts = block.first_copies(side)
        _, _, values, unit_ends, state = block.read(firsts)
        begins = np.concatenate(([0], unit_ends[:-1])) if len(unit_ends) else np.empty(0, np.int64)
        told, hot = _told(side, "keys"), _told(side, "hot")
        got, echoes, n_got = [], [np.empty((0, 6), np.int64)], 0
        for a, hasher, start, count, anchor in segments(values, unit_ends, width, gram):
            other = Hasher(values(slice(a, a + len(hasher.sums) - 1)), 1)
            end = start + count + width - 1
            row = np.searchsorted(unit_ends, start + a, "right")
            h1, h2 = hasher.spans(start, end), other.spans(start, end)
            once, again = _repeats(start + a, count, row, h1, h2, anchor)
            again[:, 0] += n_got
            echoes.append(again)
            got.append(tuple(x[once] for x in (start + a, count, row, anchor, h1, h2)))
            n_got += len(once)
        if got:
            start, count, row, anchor, h1, h2 = (np.concatenate(x) for x in zip(*got, strict=True))
        else:
            start = count = row = np.empty(0, np.int64)
            anchor = h1 = h2 = np.empty(0, U64)
        echoes = np.concatenate(echoes)

        # Shared: another block has the anchor, or another document of this one.
        full = _dealt(anchor, n_anchor_shards)
        shared = _within(full, told)
        some = _repeated(full)
        if len(some):
            order = some[np.argsort(full[some])]
            cuts = _cuts(full[order])
            at = cuts[:-1]
            mixed = np.minimum.reduceat(row[order], at) != np.maximum.reduceat(row[order], at)
            shared[order] |= np.repeat(mixed, np.diff(cuts))
        echoes = echoes[shared[echoes[:, 0]]]
        if len(echoes):
            echoes[:, [1, 3]] -= begins[row[echoes[:, 0]], None]
            echoes[:, 0] = firsts[row[echoes[:, 0]]]
        start, count, row, h1, h2 = (x[shared] for x in (start, count, row, h1, h2))
        full, anchor = full[shared], anchor[shared]
        dest = (full ^ (anchor >> U64(17))) % U64(n_shards)
        doc = block.doc[firsts[row]] if len(row) else np.empty(0, np.int64)

        # Equal segments: the first document's are sent, the later ones are covered.
        sent, later = _first_holders(h1, h2, count, doc)
        covered = [(row[later], start[later], count[later])]
        start, count, row, h1, h2, dest, doc = (x[sent] for x in (start, count, row, h1, h2, dest, doc))

        # Windows of hot anchors go one by one, by their own content; equal ones likewise.
        is_hot = _within(full[sent], hot)
        if is_hot.any():
            some = np.flatnonzero(is_hot)
            each = np.repeat(some, count[some])
            to = np.cumsum(count[some])
            one = start[each] + np.arange(len(each)) - np.repeat(to - count[some], count[some])
            single1, single2 = np.empty(len(each), U64), np.empty(len(each), U64)
            for low in range(0, len(each), 1 << 15):
                grid = values(one[low : low + (1 << 15), None] + np.arange(width))
                for seed, target in ((0, single1), (1, single2)):
                    up, _ = Hasher.powers(seed, width)
                    target[low : low + (1 << 15)] = mix((grid * up[:width]).sum(1, dtype=U64))
            single_dest = (single1 ^ (single2 >> U64(7))) % U64(n_shards)
            windows = np.ones(len(each), np.int64)
            first, later = _first_holders(single1, single2, windows, doc[each])
            covered.append((row[each[later]], one[later], windows[later]))
            each, one, rest = each[first], one[first], np.flatnonzero(~is_hot)
            start, count, row, dest, doc = (
                np.concatenate((x[rest], y))
                for x, y in (
                    (start, one), (count, windows[first]), (row, row[each]),
                    (dest, single_dest[first]), (doc, doc[each]),
                )
            )

        rows = _packed(
            number, dest, doc, firsts[row], start - begins[row], count + width - 1, state[0], start
        )
        row, start, count = (np.concatenate(x) for x in zip(*covered, strict=True))
        known = {
            "shard": number % n_shards,  # passes through that shard as it is
            "block": number,
            "row": firsts[row].astype(np.int32).tobytes(),
            "start": (start - begins[row]).astype(np.int32).tobytes(),
            "size": count.astype(np.int32).tobytes(),
            "echoes": echoes.astype(np.int32).tobytes(),
        }
        return pa.concat_tables([rows, pa.Table.from_pylist([known], FOUND_ARROW)])

    return run


def _by_content(h1: np.ndarray, h2: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, cuts of it) of segments grouped by their content."""

    def cut(order):
        new = np.ones(len(order) + 1, bool)
        new[1:-1] = False
        for key in (h1, h2, size):
            new[1:-1] |= key[order][1:] != key[order][:-1]
        return order, np.flatnonzero(new) if len(order) else np.zeros(1, np.int64)

    order, cuts = cut(np.argsort(h1, kind="stable"))
    if (h1[order[cuts[1:-1]]] == h1[order[cuts[1:-1] - 1]]).any():  # by chance, of different contents
        order, cuts = cut(np.lexsort((size, h2, h1)))
    return order, cuts


def _first_holders(h1, h2, size, doc) -> tuple[np.ndarray, np.ndarray]:
    """Places of the segments of the smallest document that has each content, and of the others."""
    order, cuts = _by_content(h1, h2, size)
    least = np.minimum.reduceat(doc[order], cuts[:-1]) if len(order) else doc
    later = doc[order] > np.repeat(least, np.diff(cuts))
    return order[~later], order[later]


FOUND_ARROW = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64())]
    + [(c, pa.binary()) for c in ("doc", "row", "start", "size", "units", "echoes")]
)
COVER_ARROW = pa.schema(
    [("block", pa.int64())] + [(c, pa.binary()) for c in ("row", "start", "n", "echoes")]
)


@dataclass
class Found:
    """The distinct segments of a shard, and who holds them."""

    units: np.ndarray  # of all distinct segments, one after the other
    start: np.ndarray
    size: np.ndarray
    doc: np.ndarray  # the first holder of each


def _anchor_bits(found: Found, width: int, gram: int) -> np.ndarray:
    """The upper bits of each segment's anchor: the least of its first window's grams, and as well
    of any other of its windows (see `windows.segments`)."""
    table = byte_values(0)
    end = found.start + found.size
    out = np.empty(len(end), U64)
    at = 0
    while at < len(end):
        to = max(int(np.searchsorted(end, found.start[at] + (1 << 18), "right")), at + 1)
        a, b = int(found.start[at]), int(end[to - 1])
        values = found.units[a:b]
        grams = Hasher(table[values] if values.dtype == np.uint8 else values).grams(gram) >> PLACE_BITS
        window = (found.start[at:to] - a)[:, None] + np.arange(width - gram + 1)
        out[at:to] = grams[window].min(1)
        at = to
    return out


def _searched(found: Found, method: Callable, width: int, gram: int):
    """`method` of the segments that may share a window with one of another document."""
    key = _anchor_bits(found, width, gram)
    order = np.argsort(key, kind="stable")
    cuts = _cuts(key[order])
    out = [(np.empty(0, np.int64),) * 3]
    if len(order):
        # Equal windows have equal anchors; different segments of one window are different windows.
        at, doc = cuts[:-1], found.doc[order]
        asked = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
        asked &= np.maximum.reduceat(found.size[order], at) > width
        n = np.diff(cuts)
        order, n = order[np.repeat(asked, n)], n[asked]
        to = np.cumsum(found.size[order])
        begin = to - found.size[order]
        total = int(to[-1]) if len(to) else 0
        n_pieces = parts(total, SEARCH_UNITS)
        pieces = np.repeat(begin[np.cumsum(n) - n] * n_pieces // max(total, 1), n)
        for a, b in runs(pieces):
            taken, size = order[a:b], found.size[order[a:b]]
            part = Found(_gathered(found.units, found.start[taken], size), begin[a:b] - begin[a], size, found.doc[taken])
            segment, window, count = method(part, width)
            out.append((taken[segment], window, count))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _search(method: Callable, units: Units, width: int, gram: int):
    """`method(Found, width)` gives (segment, first window, n windows) that start in a document
    before the segment's first holder."""

    def run(table: pa.Table) -> pa.Table:
        is_cover = pc.is_null(table["units"])
        known = table.filter(is_cover).select(["block", "row", "start", "size", "echoes"])
        table = table.filter(pc.invert(is_cover))

        def column(name, dtype):
            data, ends = text_buffer(table[name])
            return np.frombuffer(data.tobytes(), dtype), ends // np.dtype(dtype).itemsize

        doc, ends = column("doc", np.int64)
        row, _ = column("row", np.int32)
        place, _ = column("start", np.int32)
        size = column("size", np.int32)[0].astype(np.int64)
        data, _ = column("units", units.dtype)
        block = np.repeat(table["block"].to_numpy(), np.diff(np.concatenate(([0], ends))))
        to = np.cumsum(size)
        begin = to - size
        h1, h2 = _content(data, begin, to)
        order, cuts = _by_content(h1, h2, size)
        segment = np.empty(len(order), np.int64)
        segment[order] = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        taken = order[cuts[:-1]]
        sizes = size[taken]
        first = np.minimum.reduceat(doc[order], cuts[:-1]) if len(order) else doc
        found = Found(_gathered(data, begin[taken], sizes), np.cumsum(sizes) - sizes, sizes, first)
        hit, at, n = _searched(found, method, width, gram)

        later = np.flatnonzero(doc > found.doc[segment])
        early = np.flatnonzero(doc == found.doc[segment])
        early = early[np.argsort(segment[early], kind="stable")]
        low = np.searchsorted(segment[early], hit, "left")
        times = np.searchsorted(segment[early], hit, "right") - low
        each = np.repeat(np.arange(len(hit)), times)
        holder = early[_places(low, times)]
        who = np.concatenate((later, holder))
        window = np.concatenate((np.zeros(len(later), np.int64), at[each]))
        count = np.concatenate((size[later] - width + 1, n[each]))
        order = np.argsort(block[who], kind="stable")
        who, window, count = who[order], window[order], count[order]
        cuts = _cuts(block[who])
        out = pa.table(
            {
                "block": pa.array(block[who[cuts[:-1]]], pa.int64()),
                "row": _lists(row[who].astype(np.int32), cuts),
                "start": _lists((place[who] + window).astype(np.int32), cuts),
                "n": _lists(count.astype(np.int32), cuts),
                "echoes": pa.nulls(len(cuts) - 1, pa.binary()),
            },
            schema=COVER_ARROW,
        )
        return pa.concat_tables([known.rename_columns(COVER_ARROW.names).cast(COVER_ARROW), out])

    return run


def _content(data: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """128-bit hashes of spans that follow one another."""
    table = byte_values(0)
    h1, h2 = np.empty(len(begin), U64), np.empty(len(begin), U64)
    at = 0
    while at < len(begin):
        to = max(int(np.searchsorted(end, begin[at] + (1 << 20), "right")), at + 1)
        a, b = int(begin[at]), int(end[to - 1])
        values = table[data[a:b]] if data.dtype == np.uint8 else data[a:b]
        for seed, out in ((0, h1), (1, h2)):
            out[at:to] = Hasher(values, seed).spans(begin[at:to] - a, end[at:to] - a)
        at = to
    return h1, h2


def _cut(units: Units, width: int):
    """Documents without their covered units, a row for each of the block's rows."""

    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        block = Block(docs, units)
        everything = np.arange(len(block.doc))
        data, ends, _, unit_ends, state = block.read(everything)
        begins = np.concatenate(([0], unit_ends[:-1])) if len(unit_ends) else np.empty(0, np.int64)
        sizes = unit_ends - begins
        total = int(unit_ends[-1]) if len(unit_ends) else 0
        delta = np.zeros(total + 1, np.int32)
        covers = side.filter(pc.equal(side["kind"], 2))

        def column(name):
            return np.frombuffer(text_buffer(covers[name])[0].tobytes(), np.int32).astype(np.int64)

        echoes = column("echoes").reshape(-1, 6)
        for row, start, size in _echoed(column("row"), column("start"), column("n"), echoes, width):
            np.add.at(delta, begins[row] + start, 1)
            np.add.at(delta, begins[row] + start + size, -1)
        copies = block.copies(side)
        copies = copies[sizes[copies] >= width]
        np.add.at(delta, begins[copies], 1)
        np.add.at(delta, unit_ends[copies], -1)
        gone = np.cumsum(delta[:-1]) > 0
        kept, kept_ends = units.keep(data, ends, unit_ends, state, ~gone)
        edge = np.zeros(total + 1, bool)
        edge[begins[sizes > 0]] = True
        first = gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1])))[:total]
        last = gone & (edge[1:] | ~np.concatenate((gone[1:], [False])))[:total] if total else gone
        if total:
            last[-1] = gone[-1]
        at, to = np.flatnonzero(first), np.flatnonzero(last) + 1
        owner = np.searchsorted(unit_ends, at, "right")
        span_ends = np.searchsorted(owner, everything, "right")
        removed = np.concatenate(([0], np.cumsum(gone)))
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], span_ends)).astype(np.int32)),
            pa.StructArray.from_arrays(
                [pa.array(at - begins[owner], pa.int64()), pa.array(to - at, pa.int64())],
                ["start", "length"],
            ),
        )
        n_removed = removed[unit_ends] - removed[begins]
        is_text = isinstance(units.kept_type, T.StringType)
        kept_column = pa.Array.from_buffers(
            pa.large_string() if is_text else pa.large_binary(),
            len(ends),
            [
                None,
                pa.py_buffer(np.concatenate(([0], kept_ends)).astype(np.int64).tobytes()),
                pa.py_buffer(np.ascontiguousarray(kept).tobytes()),
            ],
        ).cast(pa.string() if is_text else pa.binary())
        result = pa.table(
            {
                "n_units": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(span_ends - np.concatenate(([0], span_ends[:-1])), pa.int64())
                if len(ends)
                else pa.array([], pa.int64()),
                "spans": lists,
                "kept": kept_column,
            }
        ).take(pa.array(block.row))
        return result.add_column(0, "other", docs["other"].take(pa.array(block.order)).combine_chunks())

    return run


def cut_shared(
    docs: DataFrame, units: Units, method: Callable, width: int, gram: int,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(other, n_units, n_removed, n_spans, spans, kept) for each row of `docs`.

    `other` is a struct of all columns but the text, `spans` the removed units as (start,
    length), `kept` the text without them. `method` searches the segments of a shard.
    """
    n_rows, n_bytes = rows_and_bytes(docs, text)
    n_blocks = parts(n_bytes, BLOCK_BYTES)
    n_anchor_shards = parts(n_bytes, ANCHOR_SHARD_BYTES)
    n_shards = parts(n_bytes, SHARD_BYTES)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = F.coalesce(F.col(text), F.lit(""))
    number = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(2**63 - 1))
    keyed = docs.select(
        number.alias("doc"), F.xxhash64(body).alias("hash"), body.alias("text"),
        F.struct(*others).alias("other"),
    ).withColumn("block", F.pmod(F.xxhash64("doc", "hash"), F.lit(n_blocks)))

    slim = written(
        keyed.select("block", "doc", "hash", F.xxhash64(F.lit(1), "text").alias("hash2")), "text-hashes"
    )
    firsts = slim.groupBy("hash", "hash2").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    copies = (
        join_counted(slim, firsts.where("n > 1"), ["hash", "hash2"], "n", n_rows)
        .where("doc > first")
        # New columns, as Spark can't tell those of both sides of a cogroup apart.
        .select(
            F.col("block").alias("block"), F.lit(0).alias("kind"),
            F.col("doc").alias("doc"), F.col("hash").alias("hash"),
        )
    )
    copy_side = copies.select(
        "*", F.lit(None).cast("long").alias("shard"), F.lit(None).cast("binary").alias("keys"),
        F.lit(None).cast("binary").alias("hot"),
    )
    blocks = keyed.groupBy("block")
    anchors = blocks.cogroup(copy_side.groupBy("block")).applyInArrow(
        released(_anchors_of(units, width, gram, n_anchor_shards)),
        "shard long, block long, keys binary, counts binary",
    )
    told = anchors.groupBy("shard").applyInArrow(released(_shared_anchors(HOT * units.hot)), SIDE)
    found = blocks.cogroup(copy_side.unionByName(told).groupBy("block")).applyInArrow(
        released(_segments_of(units, width, gram, n_anchor_shards, n_shards)), FOUND
    )
    covers = found.groupBy("shard").applyInArrow(released(_search(method, units, width, gram)), COVER)
    cut_side = covers.select(
        "block", F.lit(2).alias("kind"), F.lit(None).cast("long").alias("doc"),
        F.lit(None).cast("long").alias("hash"), "row", "start", "n", "echoes",
    ).unionByName(
        copies.select("*", *[F.lit(None).cast("binary").alias(c) for c in ("row", "start", "n", "echoes")])
    )
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType(
        [keyed.schema["other"]]
        + [T.StructField(c, T.LongType()) for c in ("n_units", "n_removed", "n_spans")]
        + [T.StructField("spans", T.ArrayType(span)), T.StructField("kept", units.kept_type)]
    )
    return blocks.cogroup(cut_side.groupBy("block")).applyInArrow(released(_cut(units, width)), schema)
