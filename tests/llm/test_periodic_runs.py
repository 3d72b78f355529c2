"""Periodic runs against all periods of small texts, whole and in tiles."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from searchmill.llm import periodic_runs, words
from tests.llm.odd import SCHEMA, odd_documents, prose


def plain_runs(ws):
    """(start, period, length) of all runs, by start and period."""
    n, found = len(ws), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and ws[j] == ws[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, q, length) for (s, length), q in found.items())


def plain_kept(ws, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def periodic(rng, n):
    """Some words, with stretches of all sorts of periods, some nested, some one word off."""
    ws = prose(rng, rng.randrange(n), rng.choice([2, 3, 50])).split()
    while len(ws) < n:
        q = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100, 150])
        unit = prose(rng, q, rng.choice([2, 4, 1000])).split()
        stretch = (unit * rng.randrange(2, 9))[: rng.randrange(q, 8 * q + 1)]
        if rng.random() < 0.3:
            stretch = stretch * 4
        ws += stretch
        if rng.random() < 0.6:
            ws += prose(rng, rng.randrange(1, 40)).split()
        if rng.random() < 0.3:
            ws[rng.randrange(len(ws))] = "odd"
    return ws


def texts():
    rng = random.Random(12)
    out = [" ".join(periodic(rng, n)) for n in (10, 30, 60, 100, 200, 300, 400, 700, 900, 1300)]
    out += ["a " * k for k in (23, 24, 25, 130, 900)]
    out += [("x y " * 100).strip(), ("p q r " * 8).strip(), ("p q r " * 7).strip(), "z z " * 24, "A a " * 30]
    return out


def test_solve_finds_all_runs():
    rng = random.Random(5)
    for _ in range(40):
        docs = sorted((periodic(rng, rng.choice([20, 50, 120, 400])) for _ in range(6)), key=len, reverse=True)
        numbers, base = [], 0
        for ws in docs:
            ids, different = periodic_runs._numbered(" ".join(ws).encode())
            numbers.append(ids.astype(np.int64) + base)
            base += different
        ends = np.cumsum([len(x) for x in numbers])
        found = np.concatenate(periodic_runs.solve(np.concatenate(numbers), ends, periodic_runs.octaves(len(docs[0]))))
        found = found[periodic_runs._long_enough(found)]
        got = sorted((a, q, b + q - a) for q, a, b in found.tolist())
        want = sorted((end - len(ws) + s, q, n) for ws, end in zip(docs, ends.tolist(), strict=True) for s, q, n in plain_runs(ws))
        assert got == want


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(1, 30))]
        for i, same in enumerate(periodic_runs.z_function(s)):
            if i:
                assert s[i : i + same] == s[:same]
                assert i + same == len(s) or s[same] != s[i + same]


def test_tiles_overlap():
    for n in (1, 100, 129, 1000, 5000):
        spans = {}
        for octave, a, b in periodic_runs.tiles(n, 128):
            spans.setdefault(octave, []).append((a, b))
        assert set(spans) == {0, *(s for s in periodic_runs.octaves(n) if 16 * s > 128)}
        for octave, parts in spans.items():
            assert parts[0][0] == 0 and parts[-1][1] == n
            for (_, b), (c, _) in zip(parts, parts[1:]):
                assert b - c >= 4 * (octave or 8)


@pytest.mark.parametrize("tile", [periodic_runs.TILE, 128, 256])
def test_against_all_periods(spark, tile):
    rows = odd_documents(11) + [(50_000 + k, t, *[None] * 10) for k, t in enumerate(texts())]
    rows += [rows[-1], (None, rows[-2][1], *[None] * 10)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter()
    for r in periodic_runs.periodic_runs(docs, tile=tile).collect():
        assert r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()
        got[r.other.doc_id, r.other.block, r.n_words, tuple(map(tuple, r.runs)), r.kept] += 1
    want = Counter()
    for row in rows:
        ws = [w.decode() for w in (row[1] or "").encode().split()]
        runs = plain_runs(ws)
        want[row[0], row[5], len(ws), tuple(runs), plain_kept(ws, runs)] += 1
    assert got == want
    assert sum(len(k[3]) for k in want) > 30


def test_a_long_run_of_one_word(spark):
    n = 60_000
    docs = spark.createDataFrame([(1, "one " * n), (2, "one two " * n)], "doc_id long, text string")
    for tile in (periodic_runs.TILE, 4096):
        got = {r.other.doc_id: r for r in periodic_runs.periodic_runs(docs, tile=tile).collect()}
        assert [tuple(x) for x in got[1].runs] == [(0, 1, n)] and got[1].kept == "one"
        assert [tuple(x) for x in got[2].runs] == [(0, 2, 2 * n)] and got[2].kept == "one two"


def test_a_long_period_across_tiles(spark):
    rng = random.Random(8)
    unit = prose(rng, 9_000, 1 << 40)
    text = f"{prose(rng, 777)} {unit} {unit} {unit} {prose(rng, 50)}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for tile in (periodic_runs.TILE, 1024):
        (row,) = periodic_runs.periodic_runs(docs, tile=tile).collect()
        assert [tuple(x) for x in row.runs] == [(777, 9_000, 27_000)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic_runs.periodic_runs(empty).collect() == []
    assert periodic_runs.digest(empty).collect() == []


def test_word_slices():
    rng = random.Random(2)
    for _ in range(100):
        text = "".join(rng.choices("ab \n\t\x0b\x0c\r\x1c ", k=rng.randrange(200))).encode()
        for most in (1, 5, 50, 1 << 20):
            slices = list(words.word_slices(text, most))
            assert [w for s in slices for w in s] == text.split()


def test_digest_without_words(spark):
    docs = spark.createDataFrame([(3, None), (4, " \n"), (None, "a " * 30)], "doc_id long, text string")
    none = hashlib.sha256(b"").hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.digest(docs).collect()}
    assert got[3] == got[4] == (0, None, None, None, None, none, none)
    assert got[None][:5] == (1, 0, 30, 1, 30_000)
    assert got[None][5:] == (hashlib.sha256(b"0,30,1\n").hexdigest(), hashlib.sha256(b"a").hexdigest())
