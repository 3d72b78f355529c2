"""Covering buckets against all pairs: fingerprints, links that none may miss, and components."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from searchmill.llm import simhash
from tests.llm.odd import SCHEMA, odd_documents, prose


def plain_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[a : a + 3]) for a in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """A representative for each fingerprint, over links of at most two bits."""
    prints = sorted(set(prints))
    group = {p: p for p in prints}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((top(a), top(b)))
            group[y] = x
    return {p: top(p) for p in prints}


def brute(rows):
    prints = [plain_print(r[1]) for r in rows]
    group = plain_groups(prints)
    least = {}
    for row, p in zip(rows, prints, strict=True):
        if row[0] is not None:
            least[group[p]] = min(least.get(group[p], row[0]), row[0])
    return sorted(
        ((row[0], f"{p:016x}", least.get(group[p])) for row, p in zip(rows, prints, strict=True)), key=str
    )


def near_copies(n=60):
    rng = random.Random(2)
    base = prose(rng, 400).split()
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(k % 3):
            text[rng.randrange(len(text))] = f"Y{rng.randrange(9)}"
        rows.append((20_000 + k, " ".join(text), *[None] * 10))
    return rows


@pytest.mark.parametrize("hot", [simhash.HOT, 2])
def test_against_all_pairs(spark, hot):
    rows = odd_documents(9) + near_copies() + [(7, " A b\tC d ", *[None] * 10), (8, "a B c D", *[None] * 10)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = simhash.similar_prints(docs, hot=hot).collect()
    found = sorted(((r.doc_id, f"{r.print % (1 << 64):016x}", r.component_id) for r in got), key=str)
    want = brute(rows)
    assert found == want
    assert len({w[2] for w in want}) < len(want) - 60  # near copies are linked


@pytest.mark.parametrize("hot", [simhash.HOT, 8])
def test_no_pair_in_the_radius_is_missed(spark, hot):
    """Clouds around a few fingerprints, so that buckets are crowded, at distances 1 to 5."""
    rng = random.Random(4)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(250):
            near = centre
            for b in rng.sample(range(64), rng.randrange(6)):
                near ^= 1 << b
            prints.add(near)
    group = plain_groups(prints)
    nodes = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long").repartition(3)
    edges = [(r.first % (1 << 64), r.other % (1 << 64)) for r in simhash.links(nodes, hot).collect()]
    reach = {p: p for p in prints}

    def top(p):
        while reach[p] != p:
            p = reach[p]
        return p

    degree = {}
    for a, b in edges:
        assert group[a] == group[b]
        x, y = sorted((top(a), top(b)))
        reach[y] = x
        for p in (a, b):
            degree[p] = degree.get(p, 0) + 1
    assert {p: top(p) for p in prints} == group
    assert len(edges) <= 56 * len(prints) and max(degree.values()) <= 3 * 56


def test_masks_cover_every_pair_of_bits():
    for a, b in itertools.combinations(range(64), 2):
        pair = 1 << a | 1 << b
        apart = [k for k, mask in enumerate(simhash.MASKS) if not mask & pair]
        assert apart
        for k in apart:
            assert any(not finer & pair for finer in simhash.FINER[k])
    for mask, finer in zip(simhash.MASKS, simhash.FINER, strict=True):
        assert mask.bit_count() in (36, 37)
        assert all(f & mask == mask and 64 - f.bit_count() <= 12 for f in finer)


@pytest.mark.parametrize("most", [1, 40, 300])
def test_slices_of_a_long_text(most):
    text = prose(random.Random(3), 900) + "\n x\x0b" + "y" * 500 + " z"
    whole = simhash.fingerprint(text.encode())
    assert simhash.fingerprint(text.encode(), slice_bytes=most) == whole == plain_print(text) - (
        (1 << 64) if plain_print(text) >> 63 else 0
    )


def test_hash_of_the_engine_agrees(spark):
    texts = ["", "a", "one two three", "é" * 40, "x" * 1000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) AS h").collect()
    assert {r.h % (1 << 64) for r in rows} == {xxhash.xxh64_intdigest(t.encode(), 42) for t in texts}


def test_hot_copies_and_empty_tables(spark):
    assert simhash.similar_prints(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(k, "the same text in all of them" if k % 3 else None) for k in range(2500)] + [(None, "alone")]
    got = simhash.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == list(range(2500))
    assert {r.component_id for r in got if r.doc_id and r.doc_id % 3} == {1}
    assert {(r.fingerprint, r.component_id) for r in got if r.doc_id is not None and not r.doc_id % 3} == {("0" * 16, 0)}
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_bits_of_the_majority():
    hashes = np.array([0b101, 0b001, 0b111], np.uint64)
    assert simhash.bit_counts(hashes)[:4].tolist() == [3, 1, 2, 0]
