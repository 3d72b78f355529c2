"""Both substring dedups against brute force, in one block and in many."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from searchmill.llm import shared_spans, substring_dedup, suffix_dedup
from searchmill.llm.shared_spans import Found
from searchmill.llm.windows import in_pieces, word_hashes
from tests.llm.odd import SCHEMA, odd_documents, prose, thue_morse

LAST = 2**63 - 1


def brute(rows, split, width):
    """(doc_id, number of units, spans, kept units) of each row."""
    units = [split(r[1] or "") for r in rows]
    ids = [LAST if r[0] is None else r[0] for r in rows]
    first = {}
    for us, i in zip(units, ids, strict=True):
        for a in range(len(us) - width + 1):
            key = tuple(us[a : a + width])
            first[key] = min(first.get(key, LAST), i)
    out = []
    for row, us, i in zip(rows, units, ids, strict=True):
        gone = [False] * len(us)
        for a in range(len(us) - width + 1):
            if first[tuple(us[a : a + width])] < i:
                gone[a : a + width] = [True] * width
        spans, a = [], 0
        while a < len(us):
            b = a
            while b < len(us) and gone[b]:
                b += 1
            if b > a:
                spans.append((a, b - a))
            a = b + 1
        out.append((row[0], len(us), tuple(spans), [u for u, g in zip(us, gone, strict=True) if not g]))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def octets(text):
    return list(text.encode())


CASES = [
    (substring_dedup.remove_repeated_passages, words, lambda us: " ".join(us)),
    (suffix_dedup.remove_repeated_strings, octets, lambda us: bytes(us)),
]


@pytest.mark.parametrize("operator, split, joined", CASES)
@pytest.mark.parametrize("size, hot", [(None, None), (700, 4)])
def test_against_brute_force(spark, monkeypatch, operator, split, joined, size, hot):
    if size:  # many blocks and shards, and anchors that count as hot
        for name in ("BLOCK_BYTES", "ANCHOR_SHARD_BYTES", "SHARD_BYTES"):
            monkeypatch.setattr(shared_spans, name, size)
        monkeypatch.setattr(shared_spans, "HOT", hot)
    rows = odd_documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter()
    for r in operator(docs).collect():
        spans = tuple((s.start, s.length) for s in r.spans)
        assert (r.n_spans, r.n_removed) == (len(spans), sum(n for _, n in spans))
        kept = r.kept if isinstance(r.kept, str) else bytes(r.kept)
        got[r.other.doc_id, r.n_units, spans, kept, r.other.block] += 1
    blocks = [r[5] for r in rows]
    want = Counter(
        (i, n, spans, joined(kept), b)
        for (i, n, spans, kept), b in zip(brute(rows, split, 50), blocks, strict=True)
    )
    assert got == want


@pytest.mark.parametrize("operator, split, joined", CASES)
def test_empty_table(spark, operator, split, joined):
    assert operator(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("operator, split, joined", CASES)
def test_only_empty_texts(spark, operator, split, joined):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "")], "doc_id long, text string")
    assert [r.n_units for r in operator(docs).collect()] == [0, 0, 0]


def test_suffix_array():
    rng = np.random.default_rng(3)
    for _ in range(300):
        data = rng.integers(0, rng.choice([1, 2, 4, 250]), rng.integers(0, 60)).astype(np.uint8)
        data = np.tile(data, rng.integers(1, 4))
        plain = bytes(data)
        order = suffix_dedup.suffix_array(data, 256)
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        if len(plain) > 1:
            prefix = suffix_dedup.common_prefixes(data, order, 9)
            for a, b in zip(order, order[1:], strict=False):
                same = 0
                while same < min(9, len(plain) - max(a, b)) and plain[a + same] == plain[b + same]:
                    same += 1
                assert prefix[b] == same


@pytest.mark.parametrize("method, dtype", [(substring_dedup.factor, np.uint64), (suffix_dedup.equal_strings, np.uint8)])
def test_methods_agree_with_brute_force(method, dtype):
    rng = np.random.default_rng(5)
    for _ in range(200):
        width = int(rng.integers(1, 6))
        size = rng.integers(width, width + 12, rng.integers(0, 6)).astype(np.int64)
        units = rng.integers(0, rng.integers(1, 4), size.sum()).astype(dtype)
        found = Found(units, np.cumsum(size) - size, size, rng.integers(0, 5, len(size)))
        first = defaultdict(lambda: LAST)
        keys = {}
        for k, (a, n, doc) in enumerate(zip(found.start, size, found.doc, strict=True)):
            for i in range(n - width + 1):
                keys[k, i] = tuple(units[a + i : a + i + width].tolist())
                first[keys[k, i]] = min(first[keys[k, i]], doc)
        want = {at for at, key in keys.items() if first[key] < found.doc[at[0]]}
        got = {(k, a + i) for k, a, n in zip(*method(found, width), strict=True) for i in range(n)}
        assert got == want


def check(spark, operator, split, joined, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {}
    for r in operator(docs).collect():
        kept = r.kept if isinstance(r.kept, str) else bytes(r.kept)
        got[r.other.doc_id] = (r.n_units, tuple((s.start, s.length) for s in r.spans), kept)
    assert got == {i: (n, spans, joined(kept)) for i, n, spans, kept in brute(rows, split, 50)}


@pytest.mark.parametrize("operator, split, joined", CASES)
@pytest.mark.parametrize("block", [1 << 22, 900])
def test_repeats_inside_documents(spark, monkeypatch, operator, split, joined, block):
    """Runs of one and of several units, and passages that a document repeats at odd distances."""
    for name in ("BLOCK_BYTES", "ANCHOR_SHARD_BYTES", "SHARD_BYTES"):
        monkeypatch.setattr(shared_spans, name, block)
    rng = random.Random(7)
    passage, line = prose(rng, 60), prose(rng, 12)
    units = ["w", "w x", "ab cd ef gh ij", prose(rng, 30), prose(rng, 70)]
    texts = [f"{' '.join([u] * rng.randrange(2, 130))} {prose(rng, rng.randrange(9))}" for u in units * 3]
    texts += [" ".join(rng.choice([passage, line, prose(rng, 9), "w " * 70]) for _ in range(8)) for _ in range(14)]
    texts += [" " * 700, "x" + " " * 300 + "y", "-" * 400, "-=" * 200, "-" * 49]
    rng.shuffle(texts)
    check(spark, operator, split, joined, list(enumerate(texts)))


@pytest.mark.parametrize("operator, split, joined", CASES)
def test_hot_repeats(spark, monkeypatch, operator, split, joined):
    monkeypatch.setattr(shared_spans, "HOT", 3)
    rng = random.Random(3)
    passage = prose(rng, 75)
    texts = [f"{passage} {prose(rng, 5)} " * rng.randrange(1, 4) + "q " * rng.randrange(120) for _ in range(30)]
    check(spark, operator, split, joined, list(enumerate(texts)))


def one_block(texts):
    n = len(texts)
    docs = pa.table(
        {"block": pa.array([0] * n), "doc": pa.array(range(n)), "hash": pa.array(range(n)), "text": pa.array(texts)}
    )
    names = ["block", "doc", "hash", "shard"]
    side = pa.table(
        {"kind": pa.array([], pa.int32())}
        | {c: pa.array([], pa.int64()) for c in names}
        | {c: pa.array([], pa.binary()) for c in ("keys", "hot")}
    )
    return docs, side


@pytest.mark.parametrize(
    "units, gram, texts",
    [
        (shared_spans.BYTES, 20, [" " * 1_000_000, "a" + " " * 900_000]),
        (shared_spans.WORDS, 10, ["w " * 200_000, "v " + "w " * 150_000]),
        (shared_spans.WORDS, 10, ["w x y " * 60_000, "z " + "w x y " * 60_000]),
    ],
)
def test_runs_send_little(units, gram, texts):
    docs, side = one_block(texts)
    sent = shared_spans._segments_of(units, 50, gram, 1, 1)(docs, side)
    assert 0 < sent.nbytes < sum(map(len, texts)) / 10


def told(anchors, hot):
    """What a block hears if others have all its anchors, and all are hot."""
    n = anchors.num_rows
    nulls = pa.nulls(n, pa.int64())
    return pa.table(
        {
            "kind": pa.array([1] * n, pa.int32()), "block": anchors["block"], "doc": nulls, "hash": nulls,
            "shard": anchors["shard"], "keys": anchors["keys"],
            "hot": anchors["keys"] if hot else pa.array([b""] * n),
        }
    )


@pytest.mark.parametrize("units, gram", [(shared_spans.BYTES, 24), (shared_spans.WORDS, 10)])
def test_common_segments_are_covered_whole(units, gram):
    """A passage under hot anchors is dealt by windows for its first document only."""
    rng = random.Random(11)
    passage, n = prose(rng, 600), 300
    docs, side = one_block([f"{prose(rng, 3)} {passage} {prose(rng, 3)}" for _ in range(n)])
    anchors = shared_spans._anchors_of(units, 50, gram, 1)(docs, side)
    sent = shared_spans._segments_of(units, 50, gram, 1, 1)(docs, told(anchors, hot=True))
    covered = [x for x in sent.to_pylist() if x["units"] is None]
    n_windows = len(octets(passage) if units is shared_spans.BYTES else words(passage)) - 49
    assert 0 < sum(len(x["row"]) // 4 for x in covered) < n * n_windows / 4


def test_hot_anchors_are_counted_by_the_bytes_under_them():
    """Ten thousand segments of some 60 bytes fit a shard; as many of 70 words of eight bytes don't."""
    key, count = np.uint32([5]).tobytes(), np.uint16([1000]).tobytes()
    table = pa.table({"shard": [0] * 10, "block": list(range(10)), "keys": [key] * 10, "counts": [count] * 10})
    for units, hot in ((shared_spans.BYTES, b""), (shared_spans.WORDS, key)):
        heard = shared_spans._shared_anchors(shared_spans.HOT * units.hot)(table)
        assert heard["keys"].to_pylist() == [key] * 10
        assert heard["hot"].to_pylist() == [hot] * 10


@pytest.mark.parametrize(
    "units, gram, method",
    [(shared_spans.BYTES, 24, suffix_dedup.equal_strings), (shared_spans.WORDS, 10, substring_dedup.factor)],
)
def test_search_of_what_may_be_shared(monkeypatch, units, gram, method):
    """Segments that all their documents have alike aren't searched; those that differ are, in pieces."""
    rng = random.Random(13)
    common, lines = prose(rng, 300), [prose(rng, 70) for _ in range(30)]
    texts = [f"{common} {' '.join(rng.sample(lines, 3))} {prose(rng, 9)}" for _ in range(60)]
    docs, side = one_block(texts)
    data = np.frombuffer(common.encode(), np.uint8)
    inside = units.read(data, np.array([len(data)]))[2][0]
    middle = inside[len(inside) // 2 :][:50].tobytes()
    anchors = shared_spans._anchors_of(units, 50, gram, 1)(docs, side)
    found = []
    for b in range(3):  # three blocks, which all hear of all anchors
        part = docs.filter(pa.array([i % 3 == b for i in range(len(texts))]))
        part = part.set_column(0, "block", pa.array([b] * part.num_rows))
        found.append(shared_spans._segments_of(units, 50, gram, 1, 1)(part, told(anchors, hot=False)))
    found = pa.concat_tables(found)
    sent = sum(len(x or b"") for x in found["units"].to_pylist())
    assert middle in b"".join(x or b"" for x in found["units"].to_pylist())
    results = []
    for most in (1 << 20, 1000):
        monkeypatch.setattr(shared_spans, "SEARCH_UNITS", most)
        seen = []

        def spy(some, width, seen=seen):
            seen.append(some)
            return method(some, width)

        covers = shared_spans._search(spy, units, 50, gram)(found)
        of = [[np.frombuffer(x[c] or b"", np.int32).tolist() for c in ("row", "start", "n")] for x in covers.to_pylist()]
        results.append(sorted(zip(covers["block"].to_pylist(), (sorted(zip(*x, strict=True)) for x in of), strict=True)))
        whole = np.concatenate([x.units for x in seen]).tobytes()
        assert 0 < len(whole) < sent * 0.7
        assert middle not in whole
        assert len(seen) == 1 if most > 1000 else len(seen) > 3
    assert results[0] == results[1]


@pytest.mark.parametrize("operator, split, joined", CASES)
def test_all_anchors_hot(spark, monkeypatch, operator, split, joined):
    monkeypatch.setattr(shared_spans, "HOT", 0)
    for name in ("BLOCK_BYTES", "ANCHOR_SHARD_BYTES", "SHARD_BYTES"):
        monkeypatch.setattr(shared_spans, name, 2000)
    rng = random.Random(17)
    lines = [prose(rng, n) for n in (12, 60, 75)]
    texts = [" ".join(rng.choice([*lines, prose(rng, 8), "w " * 60]) for _ in range(5)) for _ in range(40)]
    check(spark, operator, split, joined, list(enumerate(texts)))


@pytest.mark.parametrize("operator, split, joined", CASES)
def test_long_runs(spark, operator, split, joined):
    """Ten million bytes of one unit, beyond slices and blocks; what is left follows from the rule."""
    n = 10_000_000 if split is octets else 5_000_000
    unit = " " if split is octets else "w "
    rows = [(1, f"a {unit * 60}"), (2, f"b {unit * n}c"), (3, f"{unit * (n // 2)}")]
    got = {r.other.doc_id: r for r in operator(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = {k: r.kept if isinstance(r.kept, str) else bytes(r.kept).decode() for k, r in got.items()}
    if split is octets:
        assert kept == {1: rows[0][1], 2: "bc", 3: ""}
        assert [(s.start, s.length) for s in got[2].spans] == [(1, n + 1)]
    else:
        assert kept == {1: rows[0][1].strip(), 2: "b c", 3: ""}
        assert [(s.start, s.length) for s in got[2].spans] == [(1, n)]


def test_words_of_equal_polynomial_hash(spark):
    rng = random.Random(2)
    before, after = prose(rng, 40), prose(rng, 40)
    rows = []
    for n in (10, 11, 12):
        a, b = thue_morse(n)
        rows += [(10 * n, f"{before} {a} {after}"), (10 * n + 1, f"{before} {b} {after}"), (10 * n + 2, f"{a} {a}")]
    check(spark, *CASES[0], rows)
    data = np.frombuffer("".join(w for n in (10, 11, 12) for w in thue_morse(n)).encode(), np.uint8)
    ends = np.cumsum([1 << 10, 1 << 10, 1 << 11, 1 << 11, 1 << 12, 1 << 12])
    assert len(set(word_hashes(data, ends - np.diff(ends, prepend=0), ends).tolist())) == 6


def test_word_hashes():
    rng = random.Random(4)
    words = {"".join(rng.choices("ab\x00é", k=rng.randrange(1, 90))) for _ in range(3000)} | {"a", "a\x00", "\x00"}
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    start = ends - np.diff(ends, prepend=0)
    found = word_hashes(data, start, ends)
    assert len(set(found.tolist())) == len(words)
    for k in range(0, len(raw), 50):  # of the bytes alone
        one = np.frombuffer(raw[k], np.uint8)
        assert word_hashes(one, np.array([0]), np.array([len(one)]))[0] == found[k]


def test_pieces_are_cut_at_rows():
    texts = ["a" * n for n in (5, 0, 3_000_000, 1, 700_000, 600_000, 2)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    pieces = [p.column(0).to_pylist() for p in in_pieces([batch], 0)]
    assert [t for p in pieces for t in p] == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 1 << 20 for p in pieces)
