"""The n-gram join against all pairs on odd texts, with small chunks, and components."""

import random
from collections import defaultdict

import pytest

from searchmill.llm import ngram_join
from tests.llm.odd import SCHEMA, odd_documents, prose, thue_morse
from tests.llm.test_decontamination import words


def near_copies(n=70):
    """Copies of one text with up to a few words changed, at all distances around 0.8."""
    rng = random.Random(8)
    base = prose(rng, 100).split()
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(k % 5):
            text[rng.randrange(len(text))] = f"Y{rng.randrange(50)}"
        rows.append((10_000 + k, " ".join(text), *[None] * 10))
    return rows


def brute(rows):
    sets = defaultdict(set)  # doc_id -> its texts' n-gram sets
    for row in rows:
        ws = words(row[1])
        grams = frozenset(tuple(ws[a : a + 5]) for a in range(max(1, len(ws) - 4) if ws else 0))
        if row[0] is not None:
            sets[row[0]].add(grams)
    nodes = {g for gs in sets.values() for g in gs if g}
    holders = {g: {d for d, gs in sets.items() if g in gs} for g in nodes}
    near = {g: [h for h in nodes if h != g and 5 * len(g & h) >= 4 * len(g | h)] for g in nodes}
    group = {}
    for g in nodes:
        if g not in group:
            todo, seen = [g], {g}
            while todo:
                for h in near[todo.pop()]:
                    if h not in seen:
                        seen.add(h)
                        todo.append(h)
            least = min(min(holders[h]) for h in seen)
            group |= dict.fromkeys(seen, least)
    out = {}
    for d, gs in sets.items():
        gs = [g for g in gs if g]
        links = sum(sum(len(holders[h]) for h in near[g]) + len(holders[g]) - 1 for g in gs)
        out[d] = (min((group[g] for g in gs), default=d), links)
    return out


@pytest.mark.parametrize("chunk, most", [(256, 1 << 16), (7, 0)])
def test_against_all_pairs(spark, monkeypatch, chunk, most):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", most)
    rows = odd_documents(6) + near_copies()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = ngram_join.similar_documents(docs, chunk=chunk).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute(rows)
    assert len(got) == len({r[0] for r in rows} - {None})


def test_keep_first(spark):
    rows = odd_documents(6)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    first = brute(rows)
    want = [r for r in rows if r[0] is None or first[r[0]][0] == r[0]]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_empty_and_wordless(spark):
    assert ngram_join.similar_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")
    got = ngram_join.similar_documents(docs).collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in got} == {(1, 1, 0), (2, 2, 0), (3, 3, 0)}


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 101), (200, 103)]
    labels = ngram_join.components(spark.createDataFrame(edges, "first long, other long"))
    want = {k: 0 for k in range(41)} | dict.fromkeys((100, 101, 103, 200), 100)
    assert {r.node: r.label for r in labels.collect()} == want


def test_recall_plan():
    bands = ngram_join.plan_bands(0.8, 0.99999, 4)
    assert 1 - (1 - 0.8**4) ** bands >= 0.99999 > 1 - (1 - 0.8**4) ** (bands - 1)


def test_words_of_equal_polynomial_hash(spark):
    rows = [(k, f"one two {w} three four", *[None] * 10) for k, w in enumerate(thue_morse(11))]
    rows += [(9, rows[1][1], *[None] * 10)]
    got = ngram_join.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute(rows) == {0: (0, 0), 1: (1, 1), 9: (1, 1)}


def test_texts_longer_than_a_slice(spark):
    """Sets of texts of more than a million words, alike and not."""
    words_ = [f"{k * 7919 % 100_003}x{k % 977}" for k in range(1_100_000)]
    other = list(words_)
    other[5] = other[900_000] = "edited"
    rows = [(4, " ".join(words_)), (2, " ".join(other)), (3, " ".join(words_[:700_000])), (8, "short text")]
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {4: (2, 1), 2: (2, 1), 3: (3, 0), 8: (8, 0)}
