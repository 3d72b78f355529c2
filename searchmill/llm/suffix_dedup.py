"""Substring dedup by suffix arrays, sorted by induction.

Each shard (see `shared_spans`) concatenates its distinct segments, separated by a byte that
no UTF-8 text has, and builds the suffix array: suffixes are classified as smaller or larger
than their successor; the substrings between leftmost smaller suffixes are sorted by one
induction and named; the string of names is sorted recursively; a second induction gives the
order of all suffixes. Inductions go bucket by bucket, each bucket's entries at once, so numpy
does the linear work. Strings of names with too many different names for that are sorted by
doubling the length of compared prefixes. Common prefixes are computed in text order, for each
suffix and the one before it in the array (permuted); runs of the array with a common prefix
of at least `width` bytes are equal strings, and their first document is the least in the run.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchmill.llm.shared_spans import BYTES, Found, cut_shared

WIDTH = 50
GRAM = 24
SEPARATOR = 0xFF
FEW_NAMES = 1024
"""A string with more different symbols than this is sorted by doubling."""


def smaller_than_next(s: np.ndarray) -> np.ndarray:
    """Type of each suffix: True if it is smaller than the one after it. The last is larger."""
    change = np.flatnonzero(s[1:] != s[:-1])
    ends = np.append(change, len(s) - 1)  # ends of runs of one symbol
    kind = np.zeros(len(ends), bool)
    kind[:-1] = s[change] < s[change + 1]
    return np.repeat(kind, np.diff(np.concatenate(([-1], ends))))


def _place(sa, symbol, entries, border, step):
    """Put `entries` at the borders of their symbols' buckets, in order; moves the borders."""
    order = np.argsort(symbol, kind="stable")
    count = np.bincount(symbol, minlength=len(border))
    first = border - step * (np.cumsum(count) - count)  # as if the symbol's entries began at 0
    sa[first[symbol[order]] + np.arange(0, step * len(order), step)] = entries[order]
    border += step * count


def induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, n_symbols: int) -> np.ndarray:
    """The suffix array, if `lms` are the leftmost smaller suffixes in order."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    sizes = np.bincount(s, minlength=n_symbols)
    tail = np.cumsum(sizes)
    head = tail - sizes
    used = np.flatnonzero(sizes)
    order = np.argsort(s[lms], kind="stable")
    lms = lms[order].astype(np.int32)
    first = np.searchsorted(s[lms], np.arange(n_symbols + 1))

    # Larger suffixes from the left: before the last one stands the empty suffix.
    front = head.copy()
    _place(sa, s[n - 1 : n], np.array([n - 1]), front, 1)
    for c in used:
        done = head[c]
        while done < front[c]:
            at = sa[done : front[c]] - 1
            done = front[c]
            at = at[at >= 0]
            at = at[~smaller[at]]
            if len(at):
                _place(sa, s[at], at, front, 1)
        at = lms[first[c] : first[c + 1]] - 1
        if len(at):
            _place(sa, s[at], at, front, 1)
    # Smaller suffixes from the right.
    back = tail - 1
    for c in used[::-1]:
        done = tail[c] - 1
        while done > back[c]:
            at = sa[back[c] + 1 : done + 1][::-1] - 1
            done = back[c]
            at = at[at >= 0]
            at = at[smaller[at]]
            if len(at):
                _place(sa, s[at], at, back, -1)
        at = sa[head[c] : front[c]][::-1] - 1
        at = at[at >= 0]
        at = at[smaller[at]]
        if len(at):
            _place(sa, s[at], at, back, -1)
    return sa


def name_substrings(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, order: np.ndarray):
    """Names of the substrings between leftmost smaller suffixes, in text order, and their number.

    `order` are the places in `lms` as induction has sorted the substrings.
    """
    size = np.diff(np.append(lms, len(s) - 1)) + 1
    a, b = lms[order[:-1]], lms[order[1:]]
    equal = size[order[:-1]] == size[order[1:]]
    equal &= (order[:-1] != len(lms) - 1) & (order[1:] != len(lms) - 1)
    live = np.flatnonzero(equal)
    step = 0
    while len(live):
        live = live[size[order[live]] > step]
        differ = s[a[live] + step] != s[b[live] + step]
        equal[live[differ]] = False
        live = live[~differ]
        step += 1
    names = np.empty(len(lms), np.int64)
    names[order] = np.concatenate(([0], np.cumsum(~equal)))
    return names, int(len(order) - equal.sum())


def by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of many different names."""
    n, rank, step = len(names), names.astype(np.int64) + 1, 1
    few = rank.max() < 1 << 16  # sorted by their digits
    order = np.argsort(rank.astype(np.uint16) if few else rank, kind="stable")
    while True:
        ordered = rank[order]
        tied = np.zeros(n, bool)
        same = ordered[1:] == ordered[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        live = order[at]
        after = np.zeros(len(live), np.int64)
        ok = live + step < n
        after[ok] = rank[live[ok] + step]
        again = np.argsort(rank[live] * (n + 1) + after)
        order[at] = live[again]
        # New ranks are places of the first of equals, so they stay below the next group's.
        key, nxt = rank[live[again]], after[again]
        new = np.ones(len(again), bool)
        new[1:] = (key[1:] != key[:-1]) | (nxt[1:] != nxt[:-1])
        place = at[np.flatnonzero(new)][np.cumsum(new) - 1]
        fresh = rank.copy() if step == 1 else rank
        if step == 1:  # from names to places
            starts = np.ones(n, bool)
            starts[1:] = ~same
            fresh[order] = np.flatnonzero(starts)[np.cumsum(starts) - 1] + 1
        fresh[order[at]] = place + 1
        rank = fresh
        step *= 2


def suffix_array(s: np.ndarray, n_symbols: int) -> np.ndarray:
    """Places of all suffixes in order; a suffix that is the start of another comes first."""
    if len(s) < 2:
        return np.arange(len(s))
    if n_symbols > FEW_NAMES:
        return by_doubling(s)
    smaller = smaller_than_next(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        sa = induce(s, smaller, lms, n_symbols)
        is_lms = np.zeros(len(s), bool)
        is_lms[lms] = True
        sorted_lms = sa[is_lms[sa]]
        place = np.empty(len(s), np.int32)
        place[lms] = np.arange(len(lms))
        order = place[sorted_lms]
        names, n_names = name_substrings(s, smaller, lms, order)
        if n_names < len(lms):
            lms = lms[suffix_array(names, n_names)]
        else:
            lms = sorted_lms
    return induce(s, smaller, lms, n_symbols)


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in text order: common prefix with the one before it in `sa`, up to `most`.

    `sa` may be some of the suffixes in order; others get 0."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate((data, np.zeros(most + 8, np.uint8)))
    eight = np.ndarray((n + most,), "<u8", padded.tobytes(), 0, (1,))
    length = np.zeros(n, np.int64)
    live = np.flatnonzero(before >= 0)
    for step in range(0, most, 8):
        other = before[live]
        differ = eight[live + step] ^ eight[other + step]
        equal = differ == 0
        ends = live[~equal]
        bits = differ[~equal]
        low = bits & (~bits + np.uint64(1))
        length[ends] = step + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        live = live[equal]
    length[live] = most
    return np.minimum(length, np.minimum(most, np.where(before < 0, 0, n - np.maximum(before, np.arange(n)))))


def equal_strings(found: Found, width: int):
    """(segment, first window, n windows) of windows that start in an earlier document."""
    none = np.empty(0, np.int64)
    if not len(found.start):
        return none, none, none
    # One separator after each segment.
    start = found.start + np.arange(len(found.start))
    text = np.full(len(found.units) + len(start), SEPARATOR, np.uint8)
    segment = np.repeat(np.arange(len(start)), found.size)
    text[np.arange(len(found.units)) + segment] = found.units
    sa = suffix_array(text, 256)
    windows = np.zeros(len(text) + 1, np.int64)  # places where a window starts
    np.add.at(windows, start, 1)
    np.add.at(windows, start + found.size - width + 1, -1)
    begins = np.cumsum(windows[:-1]) > 0
    owner = np.repeat(np.arange(len(start)), found.size + 1)

    at = sa[begins[sa]]
    new = common_prefixes(text, at, width)[at] < width
    new[0] = True
    doc = found.doc[owner[at]]
    least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
    hit = np.zeros(len(text) + 1, bool)
    hit[at] = least < doc
    edge = np.flatnonzero(hit[1:] != hit[:-1]) + 1
    if hit[0]:
        edge = np.concatenate(([0], edge))
    a, b = edge[0::2], edge[1::2]
    return owner[a], a - start[owner[a]], b - a


def remove_repeated_strings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each document without the bytes that lie in a string of `width` bytes which also starts in
    a document of smaller doc_id.

    Returns (other, n_units, n_removed, n_spans, spans, kept): `other` all columns but the text,
    spans in bytes of the UTF-8 text, `kept` the remaining bytes (which may cut a character).
    See `shared_spans` for nulls, ties and repeats.
    """
    return cut_shared(docs, BYTES, equal_strings, width, min(GRAM, width))


def digest(docs: DataFrame) -> DataFrame:
    done = remove_repeated_strings(docs.select("doc_id", "text"))
    return done.select(
        F.col("other.doc_id").alias("doc_id"),
        F.col("n_units").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
