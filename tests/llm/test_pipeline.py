"""Every pipeline stage against a plain version on its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import test_decontamination, test_ngram_join, test_shared_spans
from tests.llm.odd import SCHEMA, odd_documents, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with junk among the documents, labels for some, and a benchmark."""
    import random

    rng = random.Random(12)
    rows = odd_documents(11, 80)
    for k in range(60):
        junk = " ".join(f"{w}%%%" for w in prose(rng, 60).split())
        rows.append((20_000 + k, junk, *[None] * 10))
    labels = [(r[0], int("%%%" not in (r[1] or "")), 0) for r in rows if r[0] is not None and r[0] % 2]
    base = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    items = [(i, " ".join((rows[i][1] or "").split()[:12])) for i in (0, 1, 10)] + [(99, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, items


def plain(row):
    return tuple(row)


def test_stages(spark, folder, tmp_path):
    base, items = folder
    docs = spark.read.parquet(f"{base}/documents.parquet")
    inputs, outputs = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = [plain(r) for r in docs.collect()]
        columns = docs.columns
        out = stage(spark, docs, base)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        outputs[name] = [plain(r) for r in docs.collect()]
        if name != "packing":
            assert docs.columns == columns

    kept = Counter(outputs["quality"])
    assert all("%%%" not in (r[1] or "") for r in kept)
    assert kept == Counter(r for r in inputs["quality"] if "%%%" not in (r[1] or ""))

    first = test_ngram_join.brute(inputs["near_duplicates"])
    assert Counter(outputs["near_duplicates"]) == Counter(
        r for r in inputs["near_duplicates"] if r[0] is None or first[r[0]][0] == r[0]
    )

    want = Counter()
    rows = inputs["repeated_passages"]
    for row, (_, n, spans, left) in zip(
        rows, test_shared_spans.brute(rows, test_shared_spans.words, 50), strict=True
    ):
        if not spans:
            text = row[1] or ""
        elif left:
            gone = {a + k for a, m in spans for k in range(m)}
            words = list(re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", row[1]))
            lead = row[1][: words[0].start()]
            text = lead + "".join(w[0] for k, w in enumerate(words) if k not in gone)
        else:
            continue
        want[(row[0], text, *row[2:4], len(text), *row[5:])] += 1
    assert Counter(outputs["repeated_passages"]) == want

    rows = inputs["decontamination"]
    dirty = {r: test_decontamination.brute([r], items) for r in rows}
    assert Counter(outputs["decontamination"]) == Counter(
        r for r in rows if not any(k[5] for k in dirty[r])
    )
    assert 0 < len(outputs["decontamination"]) < len(rows)

    packed = Counter(r[0] for r in outputs["packing"])
    assert set(packed) == {r[0] for r in inputs["packing"]}


def test_run_equals_its_stages(spark, folder):
    base, _ = folder
    got = corpus_pipeline.run(spark, base)
    assert got.columns[:4] == ["doc_id", "piece", "start", "length"] and got.count() > 0


def test_empty_documents(spark, folder):
    base, _ = folder
    docs = spark.read.parquet(f"{base}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, base)
        assert docs.collect() == []
        docs = spark.createDataFrame([], docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, base).collect() == []
