"""The corpus pipeline: from documents to packed training sequences.

Each stage works on all rows that the one before kept, as a written table. All but the last
return the columns of `documents`:

- quality: documents that the classifier rejects go;
- near_duplicates: of each class of alike documents the first stays;
- repeated_passages: passages of 50 words that start in an earlier document are cut out;
- decontamination: documents with a benchmark passage go;
- packing: the rest as pieces of sequences of 1024 token ids.

Null and empty texts are documents without words: they are scored by the classifier's intercept,
are alike with nothing, hold no passage, and are packed as an end id. Rows with a null doc_id are
judged by their own text, are never removed as near duplicates, and come after all others where
the first document keeps a passage. Rows that are repeated are in one class, whose rows all have the
first doc_id and stay; of their passages, only those that an earlier document has are cut.
Ties: the smallest doc_id is the first. Extra columns are passed on up to packing, whatever
their names. Very long texts are read in slices or alone, never cut short (see each module). An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from searchmill.llm.decontamination import remove_contaminated
from searchmill.llm.ngram_join import keep_first
from searchmill.llm.packing import pack_documents
from searchmill.llm.quality import keep_good
from searchmill.llm.queries import TOKENIZER
from searchmill.llm.substring_dedup import cut_passages
from searchmill.llm.tables import read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_passages(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None
"""SQL can't express the classifier or the tokenizer; the tests hold the stages against plain
versions."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
