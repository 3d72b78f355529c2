"""Fingerprints against plain versions of the hashes, the neighbours and the likeness."""

import random

import numpy as np
import pytest

from searchmill.llm import text_prints
from searchmill.llm.text_prints import Prefixes, code_points, common_extension
from tests.llm.odd import SCHEMA, odd_documents

P = 2**31 - 1


def plain_hash(text):
    out = 0
    for base in text_prints.BASES:
        out = out << 31 | sum((ord(c) + 1) * pow(base, i, P) for i, c in enumerate(text)) % P
    return out


def plain_sketch(text):
    spans = {text[i : i + 16] for i in range(len(text) - 15)} or ({text} if text else set())
    hashes = sorted(int(text_prints.spread(np.uint64(plain_hash(s)))) for s in spans)
    return len(text), plain_hash(text), hashes[:64]


def plain_likeness(a, b):
    if a[:2] == b[:2]:
        return 1.0
    both = sorted({*a[2], *b[2]})[:64]
    return len({*a[2]} & {*b[2]} & {*both}) / len(both) if both else 0.0


def plain_text(s):
    return f"{s[0]:016x}{s[1]:016x}" + "".join(f"{h:016x}" for h in s[2])


def common_start(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(60):
        a = "".join(rng.choices("ab🙂é", k=rng.randrange(40)))
        b = "".join(rng.choices("ab🙂é", k=rng.randrange(5))) + a[rng.randrange(len(a) + 1) :]
        x, y = Prefixes(code_points(a)), Prefixes(code_points(b))
        for _ in range(10):
            i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
            assert common_extension(x, i, y, j) == common_start(a[i:], b[j:])
            n = rng.randrange(len(a) - i + 1)
            assert int(x.spans(i, n)) == plain_hash(a[i : i + n])


@pytest.mark.parametrize("size", [1, 5, 16, 17, 100])
def test_slices_change_nothing(monkeypatch, size):
    rng = random.Random(size)
    texts = ["".join(rng.choices("abc🙂", k=k)) for k in (0, 1, 15, 16, 17, 40, 100, 101, 333)] + ["aaaa" * 60]
    whole = [text_prints.Text(0, 0, None, t) for t in texts]
    want = [x.before(y) for x in whole for y in whole]
    monkeypatch.setattr(text_prints, "SLICE", size)
    monkeypatch.setattr(text_prints.Powers, "_made", {})
    sliced = [text_prints.Text(0, 0, None, t) for t in texts]
    assert [x.before(y) for x in sliced for y in sliced] == want
    for t, x in zip(texts, sliced, strict=True):
        found = x.prefixes.spans(np.arange(max(len(t) - 2, 0)), 3)
        assert [int(h) for h in found] == [plain_hash(t[i : i + 3]) for i in range(max(len(t) - 2, 0))]


def test_memory_of_a_long_text():
    import tracemalloc

    text_prints.text_sketch("warm " * 10)
    text = "abcdefghij klmnop " * 300_000  # 5.4 million
    tracemalloc.start()
    one = text_prints.Text(0, 0, 1, text)
    one.before(text_prints.Text(0, 0, 2, text[5:]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 35 * len(text) + (150 << 20)


def brute(rows):
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.getActiveSession()
    hashed = spark.createDataFrame([(k, r[1] or "") for k, r in enumerate(rows)], "k long, text string")
    hashes = {r.k: r.h for r in hashed.select("k", F.xxhash64("text").alias("h")).collect()}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, -(rows[k][0] or 0), hashes[k]))
    texts = [rows[k][1] or "" for k in order]
    out = []
    for at, k in enumerate(order):
        text, following = texts[at], texts[(at + 1) % len(texts)]
        m = len(text) // 3
        changed = text[: len(text) - m] + following[:m]
        a, b, c = plain_sketch(text), plain_sketch(changed), plain_sketch(following)
        out.append(
            (rows[k][0], len(text), changed, plain_text(a), plain_text(b), plain_likeness(a, b),
             plain_likeness(a, c), common_start(text, changed), common_start(text, following))
        )
    return out


@pytest.mark.parametrize("size", [None, 1500])
def test_against_brute_force(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(text_prints, "RANGE_BYTES", size)
    rows = odd_documents(9, 40)[-45:]
    rows = [(r[0], (r[1] or "")[:700] if r[1] else r[1], *r[2:]) for r in rows]
    rows += [(90_000, "🙂" * 40, *[None] * 10), (90_001, "🙂" * 15, *[None] * 10)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = text_prints.fingerprint_documents(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_one_document_and_none(spark):
    docs = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    (one,) = text_prints.digest(docs).collect()
    assert one.near_next == 1.0 and one.n_chars == 6 and one.common_prefix_edited == 4
    assert text_prints.digest(docs.limit(0)).collect() == []


def test_likeness_separates():
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(20)]
    sketches = [text_prints.text_sketch(t) for t in texts]
    for t, s, other in zip(texts, sketches, sketches[1:] + sketches[:1], strict=True):
        changed = text_prints.text_sketch(t[:1900] + "x" * 100)
        assert text_prints.likeness(s, changed) > 0.7 > 0.1 > text_prints.likeness(s, other)
        assert text_prints.from_text(text_prints.as_text(s))[:2] == s[:2]
