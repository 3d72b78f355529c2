"""Substring dedup by relative Lempel-Ziv parsing.

The reference blocks are the distinct segments of earlier text that meet in a shard (see
`shared_spans`; equal blocks are kept once, for their first document). Each shard indexes every
window of its blocks: window content -> the first document that has it, and where. A document's
segment is then factored greedily against all of the shard's blocks: at a place, take the
block of the first document that has the window here, and extend the factor as far as both
texts agree. Factors of at least `width` words are duplicate spans. The parse goes on
`width - 1` words before a factor's end, so windows that cross a factor boundary are checked as
well: every word that lies in a window of earlier text is found, not only the greedy factors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchmill.llm.shared_spans import WORDS, WORDS_IN_PLACE, Found, cut_shared
from searchmill.llm.windows import U64, Hasher

WIDTH = 50
GRAM = 10
NEVER = np.iinfo(np.int64).max


def window_index(found: Found, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each unit: place and document of the first block with the window that starts here
    (-1 and NEVER where no window starts)."""
    n = len(found.units)
    source, doc = np.full(n, -1), np.full(n, NEVER)
    windows = found.size - width + 1
    to = np.cumsum(windows)
    segment = np.repeat(np.arange(len(windows)), windows)
    place = np.arange(len(segment)) + np.repeat(found.start - (to - windows), windows)
    if not len(place):
        return source, doc
    h1, h2 = np.empty(len(place), U64), np.empty(len(place), U64)
    step = 1 << 20
    for a in range(0, n, step):
        low, high = np.searchsorted(place, [a, a + step])
        for seed, out in ((0, h1), (1, h2)):
            hasher = Hasher(found.units[a : a + step + width], seed)
            out[low:high] = hasher.spans(place[low:high] - a, place[low:high] - a + width)
    holder = found.doc[segment]
    order = np.lexsort((place, holder, h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    source[place[order]] = place[first]
    doc[place[order]] = holder[first]
    return source, doc


def agree(units: np.ndarray, at: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many units from `at` and from `other` on are equal, up to `most`."""
    n = np.zeros(len(at), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        live = live[units[at[live] + n[live]] == units[other[live] + n[live]]]
        n[live] += 1
        live = live[n[live] < most[live]]
    return n


def factor(found: Found, width: int):
    """(segment, first window, n windows) of the factors, parsed for all segments at once."""
    source, doc = window_index(found, width)
    end = found.start + found.size
    segment_of = np.repeat(np.arange(len(found.size)), found.size)
    block_end = end[segment_of] if len(segment_of) else end
    hit = np.flatnonzero(doc < found.doc[segment_of])
    live = np.arange(len(found.start))
    place = found.start.copy()
    out = []
    while len(live):
        k = np.searchsorted(hit, place[live])  # the next place where earlier text starts
        live, k = live[k < len(hit)], k[k < len(hit)]
        inside = hit[k] + width <= end[live]
        live, at = live[inside], hit[k[inside]]
        if not len(live):
            break
        other = source[at]
        length = agree(found.units, at, other, np.minimum(end[live] - at, block_end[other] - other))
        out.append((live, at - found.start[live], length - width + 1))
        place[live] = at + length - width + 1
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none
    segment, window, n = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(segment, kind="stable")
    return segment[order], window[order], n[order]


def remove_repeated_passages(docs: DataFrame, width: int = WIDTH, in_place: bool = False) -> DataFrame:
    """Each document without the words that lie in a window of `width` words which also starts in
    a document of smaller doc_id.

    Words are what white space (0x20, 0x09 to 0x0D) separates. Returns (other, n_units,
    n_removed, n_spans, spans, kept): `other` all columns but the text, spans in words, `kept`
    the remaining words joined by one space, or `in_place` the text without the removed words
    and the white space after them. See `shared_spans` for nulls, ties and repeats.
    """
    units = WORDS_IN_PLACE if in_place else WORDS
    return cut_shared(docs, units, factor, width, min(GRAM, width))


def cut_passages(docs: DataFrame) -> DataFrame:
    """`docs` with repeated passages cut out of `text`, all columns kept (`n_chars`, if there,
    is that of the new text). Documents of which nothing is left go; others stay as they are."""
    done = remove_repeated_passages(docs, in_place=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    columns = [
        new[c].alias(c) if c in new else F.col("other").getField(c).alias(c) for c in docs.columns
    ]
    return done.where("n_removed = 0 OR n_removed < n_units").select(*columns)


def digest(docs: DataFrame) -> DataFrame:
    done = remove_repeated_passages(docs.select("doc_id", "text"))
    return done.select(
        F.col("other.doc_id").alias("doc_id"),
        F.col("n_units").alias("n_words"),
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
        "n_spans",
    )
