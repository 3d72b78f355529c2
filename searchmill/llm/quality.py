"""Quality classifier: logistic regression on hashed word n-grams, fitted by FTRL-proximal.

Tokens are runs of letters, digits and non-ASCII bytes, and runs of other visible characters;
case counts. Features are the hashes of single tokens and of pairs of neighbours, in `2^BITS`
bins; a token that comes again after one or two places is the n-gram "same" as well, whatever
the token. A text's value for a bin is its count over the square root of the number of features.
Nothing but the text is an input.

Training: examples (doc_id, text, label) outside the held-out fold, at most about `MOST_ROWS`
different ones (chosen by a hash of all three; the only bound here). Copies of an example, by
repeated documents or labels, are one row with their number. They are dealt into `SHARDS` groups;
each group passes its rows `EPOCHS` times through follow-the-regularised-leader updates in a fixed
order, and the groups' weights are averaged. Copies are updates one after the other, beyond
`ONE_BY_ONE` in steps that weigh as many copies as 1/64 of those before. The weights are at most 2^BITS numbers, so they go to all tasks.
Scoring reads every whole text once: a sum of weights per text, without a shuffle.

Null and empty texts have no features: their score is that of the intercept. Without any labelled
rows every score is 1/2. A row with several labels is an example for each; null labels are
none. Repeated rows get equal scores. A very long text is read alone and whole (20 MB of text add
some 510 MB). Extra columns are passed on, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchmill.llm.decontamination import LETTERS
from searchmill.llm.tables import written
from searchmill.llm.windows import U64, in_pieces, mix, released, text_buffer, word_hashes

BITS = 18
MOST_ROWS = 16_000
SHARDS = 8
EPOCHS = 2
ONE_BY_ONE = 64
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.1, 0.1
FOLDS, HELD_OUT = 3, 1

KIND = np.ones(256, np.uint8) * 2
KIND[LETTERS] = 1
KIND[[0x20, *range(0x09, 0x0E)]] = 0


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def features(data: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins of all texts' features in order of texts, features up to each text's end)."""
    kind = KIND[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = kind[1:] != kind[:-1]
    new[ends[:-1]] = True  # a text ends a token
    edge = np.flatnonzero(new)
    start, end = edge[:-1], edge[1:]
    seen = kind[start] > 0 if len(start) else np.empty(0, bool)
    start, end = start[seen], end[seen]
    token = word_hashes(data, start, end)
    text = np.searchsorted(ends, start, "right")
    pair = mix(token[:-1] * U64(0x9E3779B97F4A7C15) + token[1:])[text[1:] == text[:-1]]
    of = [text, text[:-1][text[1:] == text[:-1]]]
    grams = [token, pair]
    for lag in (1, 2):
        same = (token[lag:] == token[:-lag]) & (text[lag:] == text[:-lag])
        of.append(text[lag:][same])
        grams.append(mix(np.full(int(same.sum()), lag, U64)))
    both = np.concatenate(of)
    order = np.argsort(both, kind="stable")
    bins = (np.concatenate(grams) >> U64(64 - bits)).astype(np.int32)[order]
    return bins, np.searchsorted(both[order], np.arange(len(ends)), "right")


def steps(copies: int) -> list[int]:
    """How many copies each update stands for: 1, then a growing share of those before."""
    out, done = [], 0
    while done < copies:
        out.append(min(max(done // ONE_BY_ONE, 1), copies - done))
        done += out[-1]
    return out


def ftrl(rows: list, labels: np.ndarray, bits: int, epochs: int, copies: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the intercept) after `epochs` passes over (bins, values) rows."""
    copies = np.ones(len(labels), np.int64) if copies is None else copies
    n_bins = (1 << bits) + 1
    z, n = np.zeros(n_bins), np.zeros(n_bins)

    def weights(at):
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for (at, value), label, same in zip(rows, labels, copies.tolist(), strict=True):
            for times in steps(same):
                w = weights(at)
                p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
                g = times * (p - label) * value
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * w
                n[at] += g * g
    return weights(np.arange(n_bins))


def _rows(column, bits: int) -> list:
    data, ends = text_buffer(column)
    bins, to = features(data, ends, bits)
    out = []
    for a, b in zip(np.concatenate(([0], to[:-1])), to, strict=True):
        at, count = np.unique(bins[a:b], return_counts=True)
        value = count / np.sqrt(max(b - a, 1))
        out.append((np.append(at, 1 << bits), np.append(value, 1.0)))
    return out


def _train(bits: int, epochs: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort([table[c].to_numpy() for c in ("hash", "label", "place")])
        table = table.take(pa.array(order)).combine_chunks()
        rows = [r for b in in_pieces(table.to_batches(), 2) for r in _rows(b.column(2), bits)]
        w = ftrl(rows, table["label"].to_numpy(), bits, epochs, table["copies"].to_numpy())
        at = np.flatnonzero(w)
        return pa.table({"bin": pa.array(at, pa.int32()), "weight": pa.array(w[at])})

    return run


def training_rows(docs: DataFrame, labels: DataFrame, most_rows: int, shards: int) -> tuple[DataFrame, int]:
    """(shard, place, text, label, hash, copies) of each different example, and the shards in use."""
    labelled = (
        labels.where(
            F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)
        )
        .groupBy(F.col("doc_id").alias("labelled_id"), F.col("label").cast("double").alias("label"))
        .agg(F.count("*").alias("n_labels"))
    )
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("hash"))
    # Counted before the texts meet the labels: copies are no more rows from here on.
    examples = (
        texts.groupBy("doc_id", "hash")
        .agg(F.count("*").alias("n_texts"))
        .join(labelled, F.col("doc_id") == F.col("labelled_id"))
        .select(
            "doc_id",
            "hash",
            "label",
            F.xxhash64("labelled_id").alias("place"),
            F.xxhash64("labelled_id", "hash", "label").alias("draw"),
            (F.col("n_texts") * F.col("n_labels")).alias("copies"),
        )
    )
    # At most `most_rows` examples, up to chance in the hash: small enough for every task.
    share = int(min(1.0, most_rows / max(examples.count(), 1)) * (1 << 32))
    sample = written(
        examples.where(F.pmod("draw", F.lit(1 << 32)) < share).select(
            F.pmod(F.hash("place"), F.lit(shards)).alias("shard"), "place", "doc_id", "hash", "label", "copies"
        ),
        "quality-sample",
    )
    drawn = sample.select("doc_id", "hash").distinct()
    once = (
        texts.join(F.broadcast(drawn), ["doc_id", "hash"], "left_semi")
        .groupBy("doc_id", "hash")
        .agg(F.first("text").alias("text"))
    )
    rows = once.join(F.broadcast(sample), ["doc_id", "hash"])
    n_shards = sample.select("shard").distinct().count()
    return rows.select("shard", "place", "text", "label", "hash", "copies"), n_shards


def fit(
    docs: DataFrame, labels: DataFrame, bits: int = BITS, most_rows: int = MOST_ROWS,
    shards: int = SHARDS, epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights from labelled rows (doc_id, label) outside the held-out fold."""
    weights = np.zeros((1 << bits) + 1)
    rows, n_shards = training_rows(docs, labels, most_rows, shards)
    if not n_shards:
        return weights
    trained = rows.groupBy("shard").applyInArrow(released(_train(bits, epochs)), "bin int, weight double")
    for row in trained.groupBy("bin").agg(F.sum("weight").alias("weight")).collect():
        weights[row["bin"]] = row["weight"] / n_shards
    return weights


def _score(weights: np.ndarray, bits: int, text):
    """`text` gives the texts of a batch, whose first column is passed on."""

    def run(batches):
        for batch in in_pieces(batches, text):
            data, ends = text_buffer(text(batch))
            bins, to = features(data, ends, bits)
            begin = np.concatenate(([0], to[:-1])).astype(np.int64)
            sums = np.concatenate(([0.0], np.cumsum(weights[bins], dtype=np.float64)))
            margin = (sums[to] - sums[begin]) / np.sqrt(np.maximum(to - begin, 1)) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score)], ["other", "score"]
            )

    return run


def score_quality(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """(other, score) of each row: `other` is a struct of all columns but the text."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("other"), F.col("text"))
    return rows.mapInArrow(_score(weights, bits, lambda batch: batch.column(1)), _scored(rows))


def _scored(rows: DataFrame) -> T.StructType:
    return T.StructType([rows.schema["other"], T.StructField("score", T.DoubleType())])


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    weights = fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    scored = score_quality(docs.select("doc_id", "text"), weights)
    return scored.select(
        F.col("other.doc_id").alias("doc_id"),
        F.coalesce(fold(F.col("other.doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that aren't rejected (score of 1/2 and more), all columns kept."""
    weights = fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    # The text goes along inside the struct, so rows needn't be joined again.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("other"))
    text = _score(weights, BITS, lambda batch: batch.column(0).field("text"))
    return rows.mapInArrow(text, _scored(rows)).where("score >= 0.5").select("other.*")
