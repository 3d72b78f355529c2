"""Token ids of whole texts with the tokenizers library, each frequent word encoded once.

A byte-level BPE tokenizer splits a text before merging, and never between a visible character
and white space that follows it. So a text may be cut there (only before space, tab and line
breaks after ASCII or two-byte letters, which no white space is among) and its chunks encoded on
their own. Prose repeats its chunks: a worker keeps the ids of chunks of up to `MOST_BYTES` bytes
in a table of `SLOTS` places, 18 MB whatever the texts are. A chunk has one place in it; another one
takes that over only if the first hasn't been met again since the last attempt. Chunks are compared
by their bytes, which two numbers hold as they are, and never by a hash.

Chunks that aren't in the table are strung together, as they may be cut between any of them, and
encoded some 64 KB at a time; the number of bytes that each token stands for says which are
whose. Where this can't be done (a chunk that doesn't begin with white space or end in a
visible character, or a tokenizer whose tokens don't add up to the bytes) a chunk is encoded by
itself.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np

from searchmill.llm.windows import BLOCK_MASKS, U64, blocks_at, mix, text_buffer

SLOTS = 1 << 19
MOST_BYTES = 15
MOST_IDS = 8
AT_ONCE = 1 << 16
END_ID = 2
KEPT = "searchmill_encoders"
WHITE = np.zeros(256, bool)
WHITE[[0x09, 0x0A, 0x0D, 0x20]] = True


class Encoder:
    """A tokenizer file's encoder, with chunks that this worker has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are Spark's matter
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # Byte-level tokens are written with one character for each byte.
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        for token, number in vocabulary.items():
            self.n_bytes[number] = len(token)
        self.low, self.high = np.zeros(SLOTS, U64), np.zeros(SLOTS, U64)
        self.size, self.met = np.zeros(SLOTS, np.uint8), np.zeros(SLOTS, bool)
        narrow = len(self.n_bytes) <= 1 << 16
        self.ids = np.zeros((SLOTS, MOST_IDS), np.uint16 if narrow else np.uint32)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder. Each task sets up anew the classes that travel with it, so it is
        kept in a module of its own."""
        kept = vars(sys.modules.setdefault(KEPT, types.ModuleType(KEPT)))
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids, up to each text's end) of an Arrow string column; null: empty."""
        data, ends = text_buffer(column)
        start = chunk_starts(data, ends)
        stop = np.append(start[1:], len(data))
        low, high, slot = self._keys(data, start, stop)
        known = (self.low[slot] == low) & (self.high[slot] == high)
        self.met[slot[known]] = True
        new = np.flatnonzero(~known)
        first, which = distinct(low[new], high[new])
        ids, size = self._encode(data, start[new[first]], stop[new[first]])
        # Places of all chunks' ids: in the table, then in `ids`.
        begin = slot * MOST_IDS
        begin[new] = self.ids.size + (np.cumsum(size) - size)[which]
        sizes = self.size[slot].astype(np.int64)
        sizes[new] = size[which]
        place = _places(begin, sizes)
        out = self.ids.ravel().take(place, mode="clip").astype(np.uint32)
        fresh = np.flatnonzero(place >= self.ids.size)
        out[fresh] = ids[place[fresh] - self.ids.size]
        self._keep(low, high, slot, new[first], ids, size)
        so_far = np.concatenate(([0], np.cumsum(sizes)))
        return out, so_far[np.searchsorted(start, ends, "left")]

    def _keys(self, data, start, stop):
        """(low, high, slot): a chunk's first 8 bytes; its others, with its length above them.

        Longer chunks get a high number of their own, which no chunk in the table has.
        """
        blocks = blocks_at(data)
        size = stop - start
        low = blocks[start] & BLOCK_MASKS[np.minimum(size, 8)]
        rest = np.clip(size - 8, 0, MOST_BYTES - 8)
        high = blocks[np.minimum(start + 8, len(data))] & BLOCK_MASKS[rest]
        high |= np.minimum(size, 255).astype(U64) << U64(56)
        long = np.flatnonzero(size > MOST_BYTES)
        high[long] = (U64(255) << U64(56)) | long.astype(U64)
        slot = (mix(low ^ mix(high)) % U64(SLOTS)).astype(np.int64)
        return low, high, slot

    def _keep(self, low, high, slot, chunk, ids, size) -> None:
        fits = np.flatnonzero((size <= MOST_IDS) & (high[chunk] >> U64(56) <= U64(MOST_BYTES)))
        _, once = np.unique(slot[chunk[fits]], return_index=True)
        fits = fits[once]
        stays = self.met[slot[chunk[fits]]]
        self.met[slot[chunk[fits]]] = False
        fits = fits[~stays]
        at = slot[chunk[fits]]
        self.low[at], self.high[at], self.size[at] = low[chunk[fits]], high[chunk[fits]], size[fits]
        begin = (np.cumsum(size) - size)[fits]
        for k in range(MOST_IDS):
            some = size[fits] > k
            self.ids[at[some], k] = ids[begin[some] + k]

    def _encode(self, data, start, stop) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of chunks, encoded anew."""
        size = stop - start
        fits = WHITE[data[start]] & _visible(data)[stop - 1] if len(start) else np.empty(0, bool)
        found, counts = [], np.zeros(len(start), np.int64)
        strung, others = np.flatnonzero(fits), np.flatnonzero(~fits)
        to = np.cumsum(size[strung])
        at = 0
        while at < len(strung):
            done = int(to[at - 1]) if at else 0
            b = max(int(np.searchsorted(to, done + AT_ONCE, "right")), at + 1)
            some = strung[at:b]
            ids, n = self._strung(data[_places(start[some], size[some])].tobytes(), to[at:b] - done)
            if ids is None:
                ids, n = self._one_by_one(data, start[some], stop[some])
            found.append(ids)
            counts[some] = n
            at = b
        for at in range(0, len(others), 1 << 12):
            some = others[at : at + (1 << 12)]
            ids, counts[some] = self._one_by_one(data, start[some], stop[some])
            found.append(ids)
        ids = np.concatenate(found) if found else np.empty(0, np.uint32)
        if len(others):  # back to the order of the chunks
            order = np.concatenate((strung, others))
            begin = np.empty(len(start), np.int64)
            begin[order] = np.cumsum(counts[order]) - counts[order]
            ids = ids[_places(begin, counts)]
        return ids, counts

    def _strung(self, text: bytes, ends: np.ndarray):
        """Ids of a text of chunks up to `ends`, or None where its tokens aren't the chunks' own."""
        (encoded,) = self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint32)
        to = np.cumsum(self.n_bytes[ids])
        if not len(ids) or to[-1] != len(text):
            return None, None
        last = np.searchsorted(to, ends)  # each chunk's last token
        if (to[last] != ends).any():
            return None, None
        return ids, np.diff(last, prepend=-1)

    def _one_by_one(self, data, start, stop):
        texts = [data[a:b].tobytes().decode() for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.array([len(x) for x in encoded], np.int64)
        return np.fromiter((i for x in encoded for i in x), np.uint32, int(n.sum())), n


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    to = np.cumsum(size)
    return np.arange(int(to[-1]) if len(to) else 0) + np.repeat(start - (to - size), size)


def distinct(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each different pair, which of these every place has)."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _visible(data: np.ndarray) -> np.ndarray:
    """Bytes that end a visible character: ASCII, or the second of U+00C0 to U+07FF."""
    visible = (data > 0x20) & (data < 0x7F)
    visible[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return visible


def chunk_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where chunks start: at the texts' starts, and at white space after a visible character."""
    if not len(data):
        return np.empty(0, np.int64)
    cut = np.zeros(len(data), bool)
    cut[1:] = WHITE[data[1:]] & _visible(data)[:-1]
    begin = np.concatenate(([0], ends[:-1]))
    cut[begin[begin < len(data)]] = True
    return np.flatnonzero(cut)
