"""Quality classifier: plain versions of features and updates, and held-out accuracy."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from searchmill.llm import quality
from searchmill.llm.windows import text_buffer
from tests.llm.odd import SCHEMA, odd_documents

SF_DIR = "/root/testdata/sf0.01"


def test_features_depend_on_the_text_alone():
    texts = [r[1] for r in odd_documents(1)] + ["!!", "a!! a!!", "%%% | x"]
    data, ends = text_buffer(pa.array(texts))
    bins, to = quality.features(data, ends, 18)
    begin = np.concatenate(([0], to[:-1]))
    for text, a, b in zip(texts, begin, to, strict=True):
        alone, _ = quality.features(*text_buffer(pa.array([text], pa.string())), 18)
        assert sorted(bins[a:b]) == sorted(alone)
    sizes = dict(zip(texts[-3:], (to - begin)[-3:], strict=True))
    # tokens + pairs + tokens equal to the one two places before
    assert sizes == {"!!": 1, "a!! a!!": 4 + 3 + 2, "%%% | x": 5}


def test_ftrl_against_a_plain_version():
    rng = np.random.default_rng(2)
    rows, labels = [], rng.integers(0, 2, 40).astype(float)
    for _ in labels:
        at = np.sort(rng.choice(8, 3, replace=False))
        rows.append((np.append(at, 8), np.append(rng.random(3), 1.0)))
    z, n = [0.0] * 9, [0.0] * 9

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * quality.L1) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(2):
        for (at, value), y in zip(rows, labels, strict=True):
            w = {i: weight(i) for i in at}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(at, value, strict=True))))
            for i, v in zip(at, value, strict=True):
                g = (p - y) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    assert np.allclose(quality.ftrl(rows, labels, 3, 2), [weight(i) for i in range(9)])


def test_odd_texts_labels_and_empty_tables(spark):
    rows = odd_documents(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = [(r[0], k % 2, 0) for k, r in enumerate(rows)] + [(3, None, 1), (None, 1, 1), (6, 1, 0), (6, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.digest(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by_text = {}
    for r, row in zip(sorted(got, key=str), sorted(got, key=str), strict=True):
        assert r == row
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
            by_text.setdefault(r.doc_id, r)
    none = quality.digest(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.digest(docs.limit(0), labels).collect() == []
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_training_ignores_held_out_labels(spark):
    docs = spark.createDataFrame(odd_documents(1), SCHEMA)
    ids = [r.doc_id for r in docs.collect() if r.doc_id is not None]
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 3 == 1]
    labels = spark.createDataFrame([(i, 0) for i in held], "doc_id long, label int")
    assert not quality.fit(docs, labels).any()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = quality.digest(docs, labels).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in got)
    assert len(got) > 50 and right / len(got) > 0.95


def test_copies_and_repeated_ids_stay_within_the_bound(spark):
    """One doc_id with a third of the labels, and with most of the documents."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    hot = ids[0]
    docs = [(i, f"text {i}") for i in ids] + [(hot, "copy")] * 300 + [(hot, f"other {k}") for k in range(500)]
    labels = [(i, i % 2) for i in ids] + [(hot, 1)] * 200
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame(labels, "doc_id long, label int")
    joined = docs.join(labels, "doc_id")
    few, _ = quality.training_rows(docs, labels, 100, 8)
    assert 50 <= few.count() <= 150
    every, _ = quality.training_rows(docs, labels, 10_000, 8)
    got = every.collect()
    assert len(got) == joined.distinct().count() < 10_000
    assert sum(r.copies for r in got) == joined.count() > 100_000


def test_copies_train_like_repeated_rows():
    rng = np.random.default_rng(4)
    rows = [(np.append(np.sort(rng.choice(8, 3, replace=False)), 8), np.append(rng.random(3), 1.0)) for _ in range(20)]
    labels = rng.integers(0, 2, 20).astype(float)
    for top, tolerance in ((quality.ONE_BY_ONE, 0), (20_000, 0.02)):
        copies = rng.integers(1, top + 1, 20)
        each = np.repeat(np.arange(20), copies)
        want = quality.ftrl([rows[k] for k in each], labels[each], 3, 2)
        assert np.allclose(quality.ftrl(rows, labels, 3, 2, copies), want, rtol=0, atol=tolerance * abs(want).max())
    assert sum(quality.steps(10**9)) == 10**9 and len(quality.steps(10**9)) < 2_000
