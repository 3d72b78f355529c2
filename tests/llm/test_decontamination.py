"""Decontamination against brute force on odd texts and items."""

import hashlib
import re
from collections import Counter

import pytest

from searchmill.llm import decontamination
from tests.llm.odd import SCHEMA, odd_documents, prose, thue_morse

ITEMS = "item_id long, text string, doc_id string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(rows, items):
    windows = {}
    for item, text, *_ in items:
        ws = words(text)
        for a in range(max(1, len(ws) - 9) if ws else 0):
            windows.setdefault(tuple(ws[a : a + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = Counter()
    for row in rows:
        ws, hit, found = words(row[1]), set(), set()
        for n in sizes:
            for a in range(len(ws) - n + 1):
                at = windows.get(tuple(ws[a : a + n]))
                if at:
                    hit.update(range(a, a + n))
                    found |= at
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out[row[0], len(ws), len(hit), len(ids), digest, bool(hit)] += 1
    return out


def odd_items(rows):
    import random

    rng = random.Random(4)
    items = [(i, prose(rng, rng.randrange(0, 40)), None) for i in range(20)]
    items += [(100 + i, " ".join((rows[i][1] or "").split()[3:30]).upper() + "!", None) for i in range(0, 40, 3)]
    items += [(200, "w5", None), (201, "Edit4, w7", None), (201, "one", None), (None, "aaaa aaaa", None)]
    items += [(7, None, None), (8, "", None), (9, "...", None), (11, items[10][1], None), (10, items[10][1], None)]
    return items


@pytest.mark.parametrize("bits", [24, 6])
def test_against_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(decontamination, "MAP_BITS", bits)
    rows = odd_documents(2)
    items = odd_items(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = decontamination.digest(docs, spark.createDataFrame(items, ITEMS).repartition(2))
    assert Counter(tuple(r) for r in found.collect()) == brute(rows, items)


def test_removal_and_empty_tables(spark):
    rows = odd_documents(2)
    items = spark.createDataFrame(odd_items(rows), ITEMS)
    docs = spark.createDataFrame(rows, SCHEMA)
    clean = Counter(tuple(r) for r in decontamination.remove_contaminated(docs, items).collect())
    hits = brute(rows, odd_items(rows))
    dirty = {(k[0], k[1]) for k in hits if k[5]}
    assert clean == Counter(r for r in rows if (r[0], len(words(r[1]))) not in dirty)
    assert decontamination.digest(docs.limit(0), items).collect() == []
    none = decontamination.digest(docs, items.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)


def test_words_of_equal_polynomial_hash(spark):
    pairs = [thue_morse(n) for n in (10, 11, 12)]
    rows = [(k, f"see {w} there", *[None] * 10) for k, w in enumerate(w for pair in pairs for w in pair)]
    items = [(k, f"{a} there", None) for k, (a, _) in enumerate(pairs)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = decontamination.digest(docs, spark.createDataFrame(items, ITEMS))
    got = Counter(tuple(r) for r in found.collect())
    assert got == brute(rows, items) and sum(k[2] > 0 for k in got) == 3


def test_many_separate_hits_in_a_long_text(spark):
    """A text of several slices; its spans are united in linear time."""
    n = 150_000
    text = " ".join(f"other{k} alpha beta" if k % 3 else f"alpha beta gamma{k} delta" for k in range(n))
    docs = spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta"), (2, "delta")], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.find_contamination(docs, items).collect()}
    ws = words(text)
    hit = [w in ("alpha", "beta", "delta") for w in ws]
    assert (got[1].n_words, got[1].n_hit, got[1].n_items) == (len(ws), sum(hit), 2)
    starts = [k for k, h in enumerate(hit) if h and not (k and hit[k - 1])]
    assert [s.start for s in got[1].spans] == starts and got[2].n_hit == 0
